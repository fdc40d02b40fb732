"""Typed, validated staging frames from raw message envelopes (STG-01 .. STG-07)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnspark import schemas as S
from txnspark.functions.dates import local_wall_clock
from txnspark.functions.scalar import scalar_only

LOCAL_ZONE = "Africa/Cairo"
NUMERIC = "decimal(38,9)"


def _texts(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _scalar(name: str) -> Column:
    # A field that holds an object or array is malformed; from_json hands out its JSON text.
    return scalar_only(F.col(name), F.col("record_content"), f"$.{name}")


def _parse_body(raw: DataFrame, names: list[str], *others: Column) -> DataFrame:
    """One text column per field of the JSON body, and the body.

    The one-element ``inline`` is a barrier: filters on the fields stay above it. Pushed below, each of them would
    parse the document again.
    """
    return raw.select(F.inline(F.array(F.from_json("record_content", _texts(names)))), "record_content", *others)


def parse_transactions(raw: DataFrame) -> DataFrame:
    """STG-01: typed columns from the JSON envelope; a value that does not fit its type is NULL."""
    created = F.get_json_object("record_metadata", "$.CreateTime").alias("created")
    parsed = _parse_body(raw, S.TRANSACTION_MESSAGE.fieldNames(), created)

    def field(name: str, kind: str | None = None) -> Column:
        text = _scalar(name)
        return (text.try_cast(kind) if kind else text).alias(name)

    return parsed.select(
        field("transaction_id"),
        field("user_id", "bigint"),
        field("amount", NUMERIC),
        field("currency"),
        field("merchant_id"),
        field("merchant_name"),
        field("merchant_category"),
        field("card_type"),
        field("timestamp", "timestamp").alias("transaction_timestamp_utc"),
        field("location_country"),
        field("location_city"),
        field("latitude", "double"),
        field("longitude", "double"),
        F.col("created").try_cast("timestamp").alias("kafka_load_timestamp"),
    )


def derive(parsed: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """STG-02: rename, local wall clock, UTC date."""
    utc = F.col("transaction_timestamp_utc")
    kept = [c for c in parsed.columns if c not in ("transaction_timestamp_utc", "kafka_load_timestamp")]
    position = kept.index("card_type") + 1
    return parsed.select(
        *kept[:position],
        utc.alias("timestamp"),
        *kept[position:],
        local_wall_clock(utc, zone).alias("transaction_timestamp_local"),
        F.to_date(utc).alias("transaction_date_utc"),
    )


def staging_rules(max_user: int = S.MAX_STAGED_USER, max_amount: str = S.MAX_STAGED_AMOUNT) -> dict[str, Column]:
    """STG-03: conditions a staged transaction meets. The limits exceed the message contract and are parameters."""
    amount = F.col("amount")
    return {
        "transaction_id": F.col("transaction_id").isNotNull(),
        "user_id": F.col("user_id").between(1, max_user),
        "amount": (amount >= F.lit(S.MIN_AMOUNT).cast(NUMERIC)) & (amount <= F.lit(max_amount).cast(NUMERIC)),
        "currency": F.col("currency").rlike(S.CURRENCY_PATTERN),
        "card_type": F.col("card_type").isin(*S.CARD_TYPES),
        "location_country": F.col("location_country").rlike(S.COUNTRY_PATTERN),
        "latitude": F.col("latitude").between(-90, 90),
        "longitude": F.col("longitude").between(-180, 180),
    }


def all_hold(rules: dict[str, Column]) -> Column:
    condition = F.lit(True)
    for rule in rules.values():
        condition = condition & rule
    return condition


def stage_transactions(raw: DataFrame, zone: str = LOCAL_ZONE, **limits) -> DataFrame:
    """STG-01 .. STG-03: the staging view."""
    return derive(parse_transactions(raw), zone).where(all_hold(staging_rules(**limits)))


def rejected_transactions(raw: DataFrame, **limits) -> DataFrame:
    """Rows that staging drops, with the names of the failed rules."""
    rules = staging_rules(**limits)
    failed = F.array(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()])
    checked = parse_transactions(raw).withColumn("failed_rules", F.filter(failed, lambda v: v.isNotNull()))
    return checked.where(F.size("failed_rules") > 0)


def stage_indicators(raw: DataFrame) -> DataFrame:
    """STG-04: typed indicator rows from the JSON envelope."""
    names = ["indicator_id", "indicator_name", "value", "date", "country"]
    parsed = _parse_body(raw, names)

    return parsed.select(
        _scalar("indicator_id").alias("indicator_id"),
        _scalar("indicator_name").alias("indicator_name"),
        _scalar("value").try_cast("double").alias("value"),
        _scalar("date").try_cast("date").alias("date"),
        _scalar("country").alias("country"),
    )


def last_days(df: DataFrame, ts: str, days: int, as_of: Column | None = None) -> DataFrame:
    """STG-07: rows of the last ``days`` days before ``as_of`` (default: today).

    The bound is compared with the bare column, so it reaches the scan.
    """
    today = F.current_date() if as_of is None else as_of
    bound = F.date_sub(today.cast("date"), days)
    return df.where(F.col(ts) >= bound.cast(df.schema[ts].dataType))
