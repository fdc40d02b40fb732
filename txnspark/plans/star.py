"""Star schema of the message stream (DIM-01 .. DIM-04, FCT-01, FCT-03, VIEW-01, VIEW-03)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnspark.functions.scalar import surrogate_key
from txnspark.operators.generators import date_spine, date_spine_over
from txnspark.operators.windows import DAY, HOUR, rolling_count, rolling_rows

# Span of the date dimension, end excluded.
CALENDAR_START = "2020-01-01"
CALENDAR_END = "2026-01-01"


def calendar_columns(day: str) -> list[Column]:
    d = F.col(day)
    return [
        d.alias("date_id"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.dayofweek(d).alias("day_of_week"),
        F.dayofyear(d).alias("day_of_year"),
        F.quarter(d).alias("quarter"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "EEEE").alias("day_name"),
    ]


def dim_date(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """DIM-01: one row per day, Sunday = 1."""
    return date_spine(spark, "day", start, end).select(*calendar_columns("date_day"))


def dim_date_over(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """DIM-01 over the span a one-row frame names (end excluded)."""
    return date_spine_over(bounds, "day", start, end).select(*calendar_columns("date_day"))


def dim_location(staged: DataFrame, with_key: bool = False) -> DataFrame:
    """DIM-02: distinct places. ``with_key`` adds a surrogate key over the four natural columns."""
    places = staged.select(
        F.col("location_country").alias("country"), F.col("location_city").alias("city"), "latitude", "longitude"
    ).distinct()
    if with_key:
        places = places.withColumn("location_sk", surrogate_key("country", "city", "latitude", "longitude"))
    return places


def dim_merchants(staged: DataFrame) -> DataFrame:
    """DIM-03: distinct id, name, category; a renamed merchant has several rows."""
    return staged.select("merchant_id", "merchant_name", "merchant_category").distinct()


def dim_users(staged: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """DIM-04: distinct users with one load time for all."""
    stamp = F.current_timestamp() if loaded_at is None else loaded_at
    return staged.select("user_id").distinct().withColumn("created_at", stamp)


def fct_transactions(
    staged: DataFrame, dates: DataFrame, users: DataFrame, merchants: DataFrame, locations: DataFrame
) -> DataFrame:
    """FCT-01: transactions with the keys found in the dimensions.

    Each dimension is reduced to its join key first, so a merchant with several names does not multiply facts. No side is
    broadcast by hint: Spark broadcasts a dimension whose size it knows to be small and splits hot keys otherwise.
    """
    t = staged.select(
        "transaction_id", "user_id", "amount", "currency", "merchant_id", "timestamp",
        "location_country", "location_city", "latitude", "longitude",
    ).alias("t")
    d = dates.select("date_id", "full_date").alias("d")
    u = users.select(F.col("user_id").alias("user_key")).distinct().alias("u")
    m = merchants.select(F.col("merchant_id").alias("merchant_key")).distinct().alias("m")
    place = ["country", "city", "latitude", "longitude"]
    loc = locations.select(*place).distinct().alias("l")
    at = (
        (F.col("t.location_country") == F.col("l.country"))
        & (F.col("t.location_city") == F.col("l.city"))
        & (F.col("t.latitude") == F.col("l.latitude"))
        & (F.col("t.longitude") == F.col("l.longitude"))
    )
    return (
        t.join(d, F.to_date("t.timestamp") == F.col("d.full_date"), "left")
        .join(u, F.col("t.user_id") == F.col("u.user_key"), "left")
        .join(m, F.col("t.merchant_id") == F.col("m.merchant_key"), "left")
        .join(loc, at, "left")
        .select(
            "t.transaction_id",
            F.col("d.date_id").alias("date_key"),
            "u.user_key",
            "m.merchant_key",
            F.col("l.country").alias("location_key"),
            "t.amount",
            "t.currency",
        )
    )


def fct_economic_indicators(staged: DataFrame) -> DataFrame:
    """FCT-03: indicator rows as staged."""
    return staged.select("indicator_id", "indicator_name", "value", "date", "country")


def _optional(df: DataFrame, column: str, kind: str) -> Column:
    return F.col(column) if column in df.columns else F.lit(None).cast(kind)


def fraud_analysis_view(
    transactions: DataFrame,
    users: DataFrame,
    merchants: DataFrame,
    indicators: DataFrame,
    unemployment: str = "unemployment_rate",
) -> DataFrame:
    """VIEW-01: transactions with user, merchant and same-day unemployment attributes.

    ``transactions`` are staged rows, optionally with ``is_fraud``; ``users`` and ``merchants`` are keyed by id and may
    carry attributes; ``indicators`` have indicator_name, date, value and optionally change_rate. Attributes that an
    input lacks are NULL. The indicator matches on the exact day, so a monthly series serves one day per month.
    """
    t = transactions.withColumn("is_fraud", _optional(transactions, "is_fraud", "boolean"))
    u = users.select(
        "user_id",
        _optional(users, "current_age", "int").alias("current_age"),
        _optional(users, "credit_score", "int").alias("credit_score"),
        _optional(users, "risk_level", "string").alias("user_risk_level"),
        _optional(users, "risk_score", "double").alias("user_risk_score"),
    )
    m = merchants.select(
        "merchant_id",
        _optional(merchants, "risk_level", "string").alias("merchant_risk_level"),
        _optional(merchants, "risk_score", "double").alias("merchant_risk_score"),
    )
    e = indicators.where(F.col("indicator_name") == unemployment).select(
        F.col("date").alias("transaction_date_utc"),
        F.col("value").alias("unemployment_rate"),
        _optional(indicators, "change_rate", "double").alias("unemployment_change_rate"),
    )
    return (
        t.join(u, "user_id", "left")
        .join(m, "merchant_id", "left")
        .join(e, "transaction_date_utc", "left")
        .select(
            "transaction_id",
            "user_id",
            "merchant_id",
            "amount",
            F.col("currency").alias("currency_code"),
            F.col("timestamp").alias("transaction_timestamp_utc"),
            "transaction_date_utc",
            "is_fraud",
            "current_age",
            "credit_score",
            "user_risk_level",
            "user_risk_score",
            "merchant_risk_level",
            "merchant_risk_score",
            "unemployment_rate",
            "unemployment_change_rate",
            F.col("location_country").alias("location_country_code"),
            "location_city",
            "latitude",
            "longitude",
            "card_type",
            F.hour("timestamp").alias("transaction_hour"),
            F.dayofweek("timestamp").alias("transaction_day_of_week"),
        )
    )


def ml_features_view(
    analysis: DataFrame,
    with_ranges: bool = False,
    transactions: DataFrame | None = None,
    hot: DataFrame | None = None,
    slice_seconds: int = HOUR,
) -> DataFrame:
    """VIEW-03: model features. Users in ``hot`` (user_id) have their ROWS frames computed in time slices.

    ``transactions`` are the staged rows behind an analysis view that is not stored: the frames then read four of their
    columns instead of running the view's joins again. The columns named ``last_24h`` and ``last_7d`` hold the reference's ROWS frames (2 and 8 rows); ``with_ranges``
    adds ``transaction_count_24h_range`` over a true interval.
    """
    source = None
    if transactions is not None:
        source = transactions.select(
            "transaction_id", "user_id", "amount", F.col("timestamp").alias("transaction_timestamp_utc")
        )
    rolled = rolling_rows(
        analysis,
        ["user_id"],
        ["transaction_timestamp_utc", "transaction_id"],
        "amount",
        counts={"transaction_count_last_24h": 1},
        averages={"avg_amount_last_7d": 7},
        hot=hot,
        slice_seconds=slice_seconds,
        source=source,
    )
    extra = []
    if with_ranges:
        rolled = rolling_count(
            rolled,
            ["user_id"],
            "transaction_timestamp_utc",
            DAY,
            "transaction_count_24h_range",
            source=analysis if source is None else source,
        )
        extra = ["transaction_count_24h_range"]
    return rolled.select(
        "transaction_id",
        "amount",
        "transaction_hour",
        "transaction_day_of_week",
        "current_age",
        "credit_score",
        "user_risk_score",
        "user_risk_level",
        "merchant_risk_score",
        "merchant_risk_level",
        "unemployment_rate",
        "unemployment_change_rate",
        "latitude",
        "longitude",
        F.when(F.col("card_type") == "chip", 1).otherwise(0).alias("use_chip"),
        "transaction_count_last_24h",
        "avg_amount_last_7d",
        *extra,
        "is_fraud",
    )
