"""Dashboard queries (DASH-01 .. DASH-03)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnspark.operators.windows import lag_by_slice, previous_day_change
from txnspark.plans.staging import last_days


def transaction_dashboard(
    facts: DataFrame,
    as_of: Column | None = None,
    days: int = 30,
    ts: str = "transaction_date",
    client: str = "client_id",
) -> DataFrame:
    """DASH-01: daily count, total, average, distinct clients and day-on-day change, newest first.

    Amounts are added as given: pass decimals for totals that do not depend on the order of addition.
    """
    amount = F.col("amount")
    daily = (
        last_days(facts, ts, days, as_of)
        .groupBy(F.to_date(ts).alias("date"))
        .agg(
            F.count(F.lit(1)).alias("transaction_count"),
            F.sum(amount).cast("double").alias("total_amount"),
            (F.sum(amount).cast("double") / F.count(amount)).alias("avg_amount"),
            F.count_distinct(client).alias("unique_users"),
        )
    )
    return previous_day_change(daily, "date", "transaction_count", "daily_change").orderBy(F.desc("date")).limit(days)


def fraud_dashboard(
    analysis: DataFrame, as_of: Column | None = None, days: int = 7, ts: str = "transaction_date"
) -> DataFrame:
    """DASH-02: daily fraud count, rate in percent, average fraud amount and change of the rate, newest first."""
    fraud = F.when(F.col("is_fraud"), F.lit(1))
    fraud_amount = F.when(F.col("is_fraud"), F.col("amount"))
    daily = (
        last_days(analysis, ts, days, as_of)
        .groupBy(F.to_date(ts).alias("date"))
        .agg(
            F.count(F.lit(1)).alias("total_transactions"),
            F.count(fraud).alias("fraud_count"),
            F.round(F.count(fraud) * F.lit(100.0) / F.count(F.lit(1)), 2).alias("fraud_rate"),
            F.try_divide(F.sum(fraud_amount).cast("double"), F.count(fraud_amount)).alias("avg_fraud_amount"),
        )
    )
    return previous_day_change(daily, "date", "fraud_rate", "daily_change").orderBy(F.desc("date")).limit(days)


def economic_dashboard(indicators: DataFrame, as_of: Column | None = None, days: int = 90) -> DataFrame:
    """DASH-03: indicator values with change in percent. The filter comes first, so the first row has no previous value."""
    recent = last_days(indicators, "date", days, as_of)
    lagged = lag_by_slice(recent, ["indicator_name"], ["date"], "value", "previous_value")
    return lagged.select(
        "date",
        "indicator_name",
        "value",
        (F.col("change_rate") * 100).alias("percentage_change"),
        "previous_value",
    ).orderBy("indicator_name", "date")
