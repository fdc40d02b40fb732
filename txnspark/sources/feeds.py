"""Normalisation of the external feeds and keyed publishing (SRC-12 .. SRC-15)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnspark.functions.dates import iso_utc
from txnspark.schemas import INDICATOR_SERIES


def _iso_now(as_of: Column | None) -> Column:
    now = F.current_timestamp() if as_of is None else as_of
    return F.date_format(now.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def exchange_rates(snapshots: DataFrame, as_of: Column | None = None) -> DataFrame:
    """SRC-12: one keyed row per currency of a snapshot (base, timestamp, rates map).

    A snapshot without base, timestamp or rates is skipped.
    """
    whole = snapshots.where(F.col("base").isNotNull() & F.col("timestamp").isNotNull() & (F.size("rates") > 0))
    return whole.select(
        "base", "timestamp", F.explode("rates").alias("target_currency", "rate")
    ).select(
        F.concat_ws("_", "base", "target_currency").alias("key"),
        F.col("base").alias("base_currency"),
        "target_currency",
        F.col("rate").cast("double").alias("rate"),
        F.col("timestamp").cast("bigint").alias("api_timestamp_unix"),
        iso_utc("timestamp").alias("api_timestamp_iso_utc"),
        _iso_now(as_of).alias("fetch_timestamp_iso_utc"),
    )


def latest_observations(observations: DataFrame) -> DataFrame:
    """SRC-14: newest observation per series; a partial aggregate, so a long series costs one row per task. Equal dates
    go by a hash of the row; a missing date is the oldest."""
    rest = [c for c in observations.columns if c != "series_id"]
    top = F.max_by(F.struct(*rest), F.struct("date", F.xxhash64(*rest))).alias("_top")
    return observations.groupBy("series_id").agg(top).select("series_id", "_top.*")


def _lookup(position: int, code: Column) -> Column:
    pairs = [F.lit(v) for row in INDICATOR_SERIES for v in (row[0], row[position])]
    return F.try_element_at(F.create_map(*pairs), code)


def indicator_name(code: Column | str) -> Column:
    """FN-07: display name of a series code, NULL when unknown."""
    return _lookup(1, F.col(code) if isinstance(code, str) else code)


def indicators(observations: DataFrame, as_of: Column | None = None, missing_as_zero: bool = True) -> DataFrame:
    """SRC-13: observations (series_id, date, value text) of the tracked series as indicator messages.

    A missing value (``.``) becomes 0.0 as in the reference; pass ``missing_as_zero=False`` before computing change
    rates, which a false zero distorts.
    """
    code = F.col("series_id")
    value = F.when(F.col("value") == ".", F.lit(0.0) if missing_as_zero else F.lit(None).cast("double")).otherwise(
        F.col("value").try_cast("double")
    )
    return observations.where(_lookup(1, code).isNotNull()).select(
        _iso_now(as_of).alias("timestamp"),
        code.alias("indicator_id"),
        _lookup(1, code).alias("indicator_name"),
        value.alias("value"),
        F.col("date").cast("string").alias("date"),
        _lookup(3, code).alias("country"),
        _lookup(2, code).alias("frequency"),
        F.lit("FRED").alias("source"),
    )


# Delivery keys of the topics.
DELIVERY_KEYS = {
    "transactions": "transaction_id",
    "economic_indicators": "indicator_id",
    "exchange_rates": "base_currency",
}


def to_messages(df: DataFrame, key: str, avro_schema: str | None = None) -> DataFrame:
    """SRC-15, STR-10: (key, value) rows; JSON, or Avro when a schema is given and Spark's Avro module is present."""
    payload = F.struct(*[c for c in df.columns if c != "key"])
    if avro_schema is None:
        value = F.to_json(payload).cast("binary")
    else:
        from pyspark.sql.avro.functions import to_avro

        value = to_avro(payload, avro_schema)
    return df.select(F.col(key).cast("string").alias("key"), value.alias("value"))


def publish(messages: DataFrame, topic: str, options: dict[str, str]) -> None:
    """SRC-15: write to a Kafka topic. Needs Spark's Kafka connector on the classpath."""
    messages.write.format("kafka").options(**options).option("topic", topic).save()
