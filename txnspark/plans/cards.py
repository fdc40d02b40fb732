"""Card, user and merchant marts with the fraud and model views (DIM-05 .. DIM-07, FCT-02, FCT-04, VIEW-02, VIEW-04, PIPE-01)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnspark.functions.dates import months_between_whole
from txnspark.functions.geo import RADIUS_METRES, point_distance_m
from txnspark.functions.scalar import safe_divide
from txnspark.operators.windows import DAY, lag_by_slice, rolling_count
from txnspark.sources.feeds import indicator_name
from txnspark.sources.tables import materialise, publish, store_version

UNEMPLOYMENT = "UNRATE"


def dim_users(users: DataFrame) -> DataFrame:
    """DIM-05: users with age band (an unknown age is Senior) and the first day of the birth month."""
    age = F.col("current_age")
    band = F.when(age < 30, "Young").when(age.between(30, 50), "Middle Age").otherwise("Senior")
    return users.select(
        F.col("id").alias("user_id"),
        "current_age",
        "birth_year",
        "birth_month",
        "gender",
        "address",
        "latitude",
        "longitude",
        band.alias("age_group"),
        F.make_date("birth_year", "birth_month", F.lit(1)).cast("timestamp_ntz").alias("birth_date"),
    ).distinct()


def dim_cards(cards: DataFrame, mask: bool = True) -> DataFrame:
    """DIM-06: cards with limit band. Number and cvv are masked unless ``mask=False``."""
    limit = F.col("credit_limit")
    band = F.when(limit > 5000, "High").when(limit > 2000, "Medium").otherwise("Low")
    number = F.concat(F.lit("************"), F.right("card_number", F.lit(4))) if mask else F.col("card_number")
    cvv = F.when(F.col("cvv").isNotNull(), F.lit("***")) if mask else F.col("cvv")
    return cards.select(
        F.col("id").alias("card_id"),
        "client_id",
        "card_brand",
        "card_type",
        number.alias("card_number"),
        "expires",
        cvv.alias("cvv"),
        "has_chip",
        "num_cards_issued",
        "credit_limit",
        band.alias("credit_limit_category"),
    ).distinct()


def dim_merchants(transactions: DataFrame) -> DataFrame:
    """DIM-07: merchants with a known city and state."""
    return (
        transactions.where(F.col("merchant_city").isNotNull() & F.col("merchant_state").isNotNull())
        .select(
            "merchant_id",
            "merchant_city",
            "merchant_state",
            "zip",
            F.concat("merchant_city", F.lit(", "), "merchant_state").alias("merchant_location"),
        )
        .distinct()
    )


def fact_transactions(
    transactions: DataFrame,
    cards: DataFrame,
    users: DataFrame,
    merchants: DataFrame,
    as_of: Column | None = None,
) -> DataFrame:
    """FCT-02: transactions enriched with card, user and merchant.

    ``cards`` and ``users`` are keyed by ``id``, ``merchants`` by ``merchant_id`` (merchant_city, merchant_state, zip,
    merchant_latitude, merchant_longitude). Rows keep no order; use ``materialise(..., sort_by=[...])`` for a layout.
    """
    now = F.current_timestamp() if as_of is None else as_of
    t = transactions.where(F.col("date").isNotNull()).select(
        F.col("id").alias("transaction_id"), "client_id", "card_id", "merchant_id", "amount", "use_chip",
        F.col("date").alias("transaction_date"),
    )
    c = cards.select(F.col("id").alias("card_id"), "card_brand", "card_type", "credit_limit", "has_chip")
    u = users.select(
        F.col("id").alias("client_id"), "current_age", "gender",
        F.col("latitude").alias("user_latitude"), F.col("longitude").alias("user_longitude"),
    )
    m = merchants.select(
        "merchant_id", "merchant_city", "merchant_state", F.col("zip").alias("merchant_zip"),
        "merchant_latitude", "merchant_longitude",
    )
    amount, limit = F.col("amount"), F.col("credit_limit")
    risk = F.when(amount > limit * 0.9, "High").when(amount > limit * 0.7, "Medium").otherwise("Low")
    anomaly = F.when(F.col("use_chip") & ~F.col("has_chip"), "Anomaly").otherwise("Normal")
    return (
        t.join(c, "card_id", "left")
        .join(u, "client_id", "left")
        .join(m, "merchant_id", "left")
        .select(
            "transaction_id",
            "client_id",
            "card_id",
            "merchant_id",
            "amount",
            "use_chip",
            "has_chip",
            "transaction_date",
            "card_brand",
            "card_type",
            "credit_limit",
            "current_age",
            "gender",
            "user_latitude",
            "user_longitude",
            "merchant_city",
            "merchant_state",
            "merchant_zip",
            "merchant_latitude",
            "merchant_longitude",
            months_between_whole("transaction_date", now).alias("months_since_transaction"),
            risk.alias("risk_level"),
            anomaly.alias("card_usage_anomaly"),
        )
    )


def fact_economic_indicators(
    indicators: DataFrame, hot: DataFrame | None = None, slice_days: int = 365
) -> DataFrame:
    """FCT-04: indicator rows with name, previous value and relative change (NULL on a zero base).

    Series in ``hot`` (indicator) are cut into slices of ``slice_days``, so that their rows do not meet in one task.
    """
    lagged = lag_by_slice(indicators, ["indicator"], ["date"], "value", "previous_value", hot, slice_days * DAY)
    previous = F.col("previous_value")
    return lagged.select(
        "indicator",
        "date",
        "value",
        "frequency",
        "country",
        indicator_name("indicator").alias("indicator_name"),
        "previous_value",
        safe_divide(F.col("value") - previous, previous).alias("change_rate"),
    )


def fraud_analysis(
    facts: DataFrame,
    indicators: DataFrame,
    labels: DataFrame,
    unemployment: str = UNEMPLOYMENT,
    radius: float = RADIUS_METRES,
    transactions: DataFrame | None = None,
) -> DataFrame:
    """VIEW-02: one-day rolling count per client, distance to the merchant, time parts, unemployment, label.

    ``transactions`` are the raw rows behind facts that are not stored: the counts then read two of their columns
    instead of running the facts' joins again.
    """
    e = indicators.where(F.col("indicator") == unemployment).select(
        F.col("date").alias("_day"),
        F.col("value").alias("unemployment_rate"),
        F.col("change_rate").alias("unemployment_change_rate"),
    )
    fl = labels.select("transaction_id", "is_fraud")
    source = None
    if transactions is not None:
        source = transactions.where(F.col("date").isNotNull()).select("client_id", F.col("date").alias("transaction_date"))
    counted = rolling_count(facts, ["client_id"], "transaction_date", DAY, "daily_transaction_count", source=source)
    return (
        counted.withColumn("_day", F.to_date("transaction_date"))
        .join(e, "_day", "left")
        .join(fl, "transaction_id", "left")
        .select(
            "transaction_id",
            "client_id",
            "card_id",
            "amount",
            "transaction_date",
            "card_brand",
            "card_type",
            "use_chip",
            "has_chip",
            "credit_limit",
            "current_age",
            "gender",
            "user_latitude",
            "user_longitude",
            "merchant_city",
            "merchant_state",
            "merchant_zip",
            "risk_level",
            "card_usage_anomaly",
            "daily_transaction_count",
            point_distance_m(
                "user_latitude", "user_longitude", "merchant_latitude", "merchant_longitude", radius
            ).alias("distance_to_merchant"),
            F.hour("transaction_date").alias("transaction_hour"),
            F.dayofweek("transaction_date").alias("transaction_day_of_week"),
            "unemployment_rate",
            "unemployment_change_rate",
            "is_fraud",
        )
    )


FEATURE_COLUMNS = [
    "transaction_id",
    "client_id",
    "card_id",
    "amount",
    "use_chip",
    "has_chip",
    "credit_limit",
    "risk_level",
    "card_usage_anomaly",
    "current_age",
    "gender",
    "distance_to_merchant",
    "user_latitude",
    "user_longitude",
    "transaction_hour",
    "transaction_day_of_week",
    "unemployment_rate",
    "unemployment_change_rate",
    "is_fraud",
]


def ml_features(analysis: DataFrame) -> DataFrame:
    """VIEW-04: model columns, plus the transaction date the training query filters on."""
    return analysis.select(*FEATURE_COLUMNS, "transaction_date")


@dataclass
class Marts:
    dim_users: DataFrame
    dim_cards: DataFrame
    dim_merchants: DataFrame
    fact_transactions: DataFrame
    fact_economic_indicators: DataFrame
    fraud_analysis_view: DataFrame
    ml_features: DataFrame


def build_marts(
    transactions: DataFrame,
    cards: DataFrame,
    users: DataFrame,
    merchants: DataFrame,
    indicators: DataFrame,
    labels: DataFrame,
    as_of: Column | None = None,
) -> Marts:
    """PIPE-01: all marts and views as lazy frames, in dependency order."""
    facts = fact_transactions(transactions, cards, users, merchants, as_of)
    series = fact_economic_indicators(indicators)
    analysis = fraud_analysis(facts, series, labels, transactions=transactions)
    return Marts(
        dim_users=dim_users(users),
        dim_cards=dim_cards(cards),
        dim_merchants=dim_merchants(transactions),
        fact_transactions=facts,
        fact_economic_indicators=series,
        fraud_analysis_view=analysis,
        ml_features=ml_features(analysis),
    )


def write_marts(
    transactions: DataFrame,
    cards: DataFrame,
    users: DataFrame,
    merchants: DataFrame,
    indicators: DataFrame,
    labels: DataFrame,
    as_of: Column | None = None,
    database: str = "default",
    root: str | None = None,
) -> Marts:
    """PIPE-01: tables for the marts, then views that read the stored tables.

    With ``root`` every mart becomes a new version below it; the names change to the new versions together, after the
    last one is written, and views computed from facts read the versions of the same run. Without, tables are
    replaced one by one.
    """
    made = {
        "dim_users": (dim_users(users), ()),
        "dim_cards": (dim_cards(cards), ()),
        "dim_merchants": (dim_merchants(transactions), ()),
        "fact_transactions": (fact_transactions(transactions, cards, users, merchants, as_of), (F.col("transaction_date").desc(),)),
        "fact_economic_indicators": (fact_economic_indicators(indicators), ("indicator", "date")),
    }
    spark = transactions.sparkSession
    if not root:
        stored = {n: materialise(df, f"{database}.{n}", "table", sort_by) for n, (df, sort_by) in made.items()}
        analysis = materialise(fraud_analysis(stored["fact_transactions"], stored["fact_economic_indicators"], labels), "fraud_analysis_view")
        return Marts(**stored, fraud_analysis_view=analysis, ml_features=materialise(ml_features(analysis), "ml_features"))
    versions = {n: store_version(df, f"{root}/{n}", sort_by) for n, (df, sort_by) in made.items()}
    facts, series = (spark.read.parquet(versions[n]) for n in ("fact_transactions", "fact_economic_indicators"))
    versions["fraud_analysis_view"] = store_version(fraud_analysis(facts, series, labels), f"{root}/fraud_analysis_view")
    versions["ml_features"] = store_version(ml_features(spark.read.parquet(versions["fraud_analysis_view"])), f"{root}/ml_features")
    published = publish({f"{database}.{n}": v for n, v in versions.items()}, spark)
    return Marts(**{n.split(".")[-1]: df for n, df in published.items()})
