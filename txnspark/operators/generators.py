"""Row generators (GEN-01, GEN-02)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnspark.functions.dates import check_part


def generate_series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """GEN-01: integers 1..n, generated in parallel."""
    if upper_bound <= 0:
        raise ValueError("upper_bound must be positive")
    return spark.range(1, upper_bound + 1).toDF("generated_number")


def spine(part: str, start: Column, end: Column) -> Column:
    """Array of points from start to end, end excluded."""
    step = F.expr(f"INTERVAL 1 {check_part(part).upper()}")
    # `sequence` includes its end and rejects an end before the start.
    return F.when(start < end, F.filter(F.sequence(start, end, step), lambda d: d < end)).otherwise(
        F.filter(F.array(start), lambda d: F.lit(False))
    )


def date_spine(
    spark: SparkSession, part: str, start: dt.date | dt.datetime | str, end: dt.date | dt.datetime | str
) -> DataFrame:
    """GEN-02: one row per date part from start to end, end excluded, in column ``date_<part>``."""
    kind = "date" if check_part(part) in ("day", "week", "month", "quarter", "year") else "timestamp_ntz"
    points = spine(part, F.lit(start).cast(kind), F.lit(end).cast(kind))
    return spark.range(1).select(F.explode(points).alias(f"date_{part.lower()}"))


def date_spine_over(df: DataFrame, part: str, start: str, end: str) -> DataFrame:
    """GEN-02 with bounds that come from a (one-row) frame instead of literals."""
    return df.select(F.explode(spine(part, F.col(start), F.col(end))).alias(f"date_{part.lower()}"))
