"""Message contracts (QC-26, QC-27): row rules as boolean columns, violations as an array of rule names."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnspark import schemas as S
from txnspark.operators import quality as Q

# Text formats of the contracts.
UUID_PATTERN = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


@dataclass(frozen=True)
class Rule:
    """A named condition on a row. A NULL condition passes, as in JSON Schema an absent field passes all but required."""

    name: str
    holds: Column


def required(*columns: str) -> list[Rule]:
    return [Rule(f"{c}: required", F.col(c).isNotNull()) for c in columns]


def pattern(column: str, regex: str) -> Rule:
    return Rule(f"{column}: pattern", F.col(column).rlike(regex))


def enum(column: str, values: list[str]) -> Rule:
    return Rule(f"{column}: enum", F.col(column).isin(*values))


def minimum(column: str, value: float) -> Rule:
    return Rule(f"{column}: minimum", F.col(column) >= F.lit(value))


def maximum(column: str, value: float) -> Rule:
    return Rule(f"{column}: maximum", F.col(column) <= F.lit(value))


def uuid(column: str) -> Rule:
    return Rule(f"{column}: uuid", F.col(column).rlike(UUID_PATTERN))


def date_time(column: str) -> Rule:
    return Rule(f"{column}: date-time", F.when(F.col(column).isNotNull(), F.try_to_timestamp(F.col(column)).isNotNull()))


def not_older_than(column: str, hours: int, as_of: Column) -> Rule:
    age_limit = as_of - F.expr(f"INTERVAL {hours} HOUR")
    return Rule(f"{column}: age", F.try_to_timestamp(F.col(column)) >= age_limit)


def transaction_rules(uuid_keys: bool = True) -> list[Rule]:
    """Rules of a transaction message. ``uuid_keys=False`` serves sources with plain ids."""
    keys = [uuid("transaction_id"), uuid("merchant_id")] if uuid_keys else []
    return [
        *required(*S.TRANSACTION_MESSAGE.fieldNames()),
        *keys,
        minimum("user_id", 1),
        minimum("amount", 0.01),
        pattern("currency", S.CURRENCY_PATTERN),
        enum("merchant_category", S.MERCHANT_CATEGORIES),
        enum("card_type", S.CARD_TYPES),
        date_time("timestamp"),
        pattern("location_country", S.COUNTRY_PATTERN),
        minimum("latitude", -90),
        maximum("latitude", 90),
        minimum("longitude", -180),
        maximum("longitude", 180),
    ]


def indicator_rules() -> list[Rule]:
    return [
        *required(*S.INDICATOR_MESSAGE.fieldNames()),
        Rule("value: number", ~F.isnan("value")),
        pattern("country", S.COUNTRY_PATTERN),
        enum("frequency", S.FREQUENCIES),
    ]


def exchange_rate_rules(as_of: Column | None = None) -> list[Rule]:
    """Rules of a rate message; the 24 h rule counts back from ``as_of`` (default: now)."""
    now = F.current_timestamp() if as_of is None else as_of
    return [
        *required(*S.EXCHANGE_RATE_MESSAGE.fieldNames()),
        pattern("base_currency", S.CURRENCY_PATTERN),
        pattern("target_currency", S.CURRENCY_PATTERN),
        minimum("rate", 0),
        date_time("api_timestamp_iso_utc"),
        date_time("fetch_timestamp_iso_utc"),
        not_older_than("api_timestamp_iso_utc", 24, now),
        not_older_than("fetch_timestamp_iso_utc", 24, now),
    ]


def validate(df: DataFrame, rules: list[Rule], out: str = "violations") -> DataFrame:
    """QC-26: add the names of the violated rules; works on batch and streaming frames."""
    named = F.array(*[F.when(~r.holds, F.lit(r.name)) for r in rules])
    return df.withColumn(out, F.filter(named, lambda v: v.isNotNull()))


def split_valid(df: DataFrame, rules: list[Rule], out: str = "violations") -> tuple[DataFrame, DataFrame]:
    """Frames of the accepted rows and of the rejected rows with their violations."""
    checked = validate(df, rules, out)
    return checked.where(F.size(out) == 0).drop(out), checked.where(F.size(out) > 0)


def violation_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Number of violating rows per rule, in one pass over the data (rules without violations are left out)."""
    checked = validate(df, rules)
    return (
        checked.select(F.explode("violations").alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("failures"))
    )


def transaction_expectations(as_of: Column | None = None, ts: str = "timestamp") -> list[Q.Check]:
    """QC-27 for transactions: unique id, positive amount, 48 h, enumerations."""
    now = F.current_timestamp() if as_of is None else as_of
    return [
        Q.Check("transaction_id unique", Q.unique_rule("transaction_id")),
        Q.Check("amount > 0", Q.range_rule("amount", min_value=0, inclusive=False)),
        Q.Check("timestamp within 48 h", Q.RowRule(F.col(ts).cast("timestamp") < now - F.expr("INTERVAL 48 HOUR"))),
        Q.Check("merchant_category enum", Q.values_rule("merchant_category", S.MERCHANT_CATEGORIES)),
        Q.Check("card_type enum", Q.values_rule("card_type", S.CARD_TYPES)),
    ]


def indicator_expectations() -> list[Q.Check]:
    """QC-27 for indicators: numeric value, two-letter country, known frequency."""
    return [
        Q.Check("value is a number", Q.RowRule(F.col("value").isNull() | F.isnan(F.col("value").cast("double")))),
        Q.Check("country code", Q.true_rule(f"rlike '{S.COUNTRY_PATTERN}'", "country")),
        Q.Check("frequency enum", Q.values_rule("frequency", S.FREQUENCIES)),
    ]


def exchange_rate_expectations(as_of: Column | None = None) -> list[Q.Check]:
    """QC-27 for exchange rates: rate >= 0, three-letter codes, ISO timestamps not older than 24 h."""
    now = F.current_timestamp() if as_of is None else as_of
    at = F.try_to_timestamp(F.col("api_timestamp_iso_utc"))
    return [
        Q.Check("rate >= 0", Q.range_rule("rate", min_value=0)),
        Q.Check("base currency code", Q.true_rule(f"rlike '{S.CURRENCY_PATTERN}'", "base_currency")),
        Q.Check("target currency code", Q.true_rule(f"rlike '{S.CURRENCY_PATTERN}'", "target_currency")),
        Q.Check("timestamp not older than 24 h", Q.RowRule(at.isNull() | (at < now - F.expr("INTERVAL 24 HOUR")))),
    ]
