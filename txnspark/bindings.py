"""Model inputs from the test tables; the only place that knows them.

Each input exists twice: as a function (Spark) and as a named subquery (SQL) for the oracle. Columns a test table lacks
come from fixed formulas on its ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnspark import schemas as S
from txnspark.plans import staging

NUMERIC = staging.NUMERIC


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table. Its schema is read from the files once; a declared schema saves a job per read."""
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _cycle(key: Column, values: list[str]) -> Column:
    out = F.when(key == 0, values[0])
    for i, v in enumerate(values[1:], 1):
        out = out.when(key == i, v)
    return out


def _cycle_sql(key: str, values: list[str]) -> str:
    return f"CASE {key} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


CURRENCIES = ["USD", "EUR", "GBP", "usd"]  # the last one must be rejected
COUNTRIES = ["US", "GB", "FR"]


# --- message stream (events) ---------------------------------------------------------------------------------------


def messages(spark: SparkSession, sf: str) -> DataFrame:
    """Typed transaction messages, one per event, not yet validated."""
    e = table(spark, sf, "events")
    i, u = F.col("event_id"), F.col("user_id")
    return e.select(
        i.cast("string").alias("transaction_id"),
        "user_id",
        F.col("value").cast(NUMERIC).alias("amount"),
        _cycle(i % 4, CURRENCIES).alias("currency"),
        F.concat(F.lit("m"), (i % 40).cast("string")).alias("merchant_id"),
        F.concat(F.lit("Merchant "), (i % 40).cast("string")).alias("merchant_name"),
        F.col("event_type").alias("merchant_category"),
        _cycle(i % 5, S.CARD_TYPES).alias("card_type"),
        F.col("ts").cast("timestamp").alias("transaction_timestamp_utc"),
        _cycle(i % 3, COUNTRIES).alias("location_country"),
        F.concat(F.lit("City "), (u % 10).cast("string")).alias("location_city"),
        ((u * 7) % 180 - 90).cast("double").alias("latitude"),
        ((u * 29) % 360 - 180).cast("double").alias("longitude"),
        (F.col("event_type") == "error").alias("is_fraud"),
    )


MESSAGES = f"""messages AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id, user_id, CAST(value AS DECIMAL(38,9)) AS amount,
    {_cycle_sql("event_id % 4", CURRENCIES)} AS currency,
    'm' || (event_id % 40) AS merchant_id, 'Merchant ' || (event_id % 40) AS merchant_name,
    event_type AS merchant_category, {_cycle_sql("event_id % 5", S.CARD_TYPES)} AS card_type,
    ts AS transaction_timestamp_utc, {_cycle_sql("event_id % 3", COUNTRIES)} AS location_country,
    'City ' || (user_id % 10) AS location_city, CAST((user_id * 7) % 180 - 90 AS DOUBLE) AS latitude,
    CAST((user_id * 29) % 360 - 180 AS DOUBLE) AS longitude, event_type = 'error' AS is_fraud
  FROM events)"""


def envelopes(spark: SparkSession, sf: str) -> DataFrame:
    """The same messages as JSON envelopes, the way the raw table holds them."""
    m = messages(spark, sf)
    iso = F.date_format("transaction_timestamp_utc", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return m.select(
        F.to_json(
            F.struct(
                "transaction_id", "user_id", F.col("amount").cast("double").alias("amount"), "currency",
                "merchant_id", "merchant_name", "merchant_category", "card_type", iso.alias("timestamp"),
                "location_country", "location_city", "latitude", "longitude",
            )
        ).alias("record_content"),
        F.to_json(F.struct(iso.alias("CreateTime"))).alias("record_metadata"),
    )


def staged(spark: SparkSession, sf: str) -> DataFrame:
    """Validated transactions from typed messages: the marts read typed columns, so filters reach the scan."""
    return staging.derive(messages(spark, sf)).where(staging.all_hold(staging.staging_rules()))


STAGED = (
    MESSAGES
    + """, staged AS (
  SELECT *, transaction_timestamp_utc AS timestamp, CAST(transaction_timestamp_utc AS DATE) AS transaction_date_utc
  FROM messages
  WHERE transaction_id IS NOT NULL AND user_id BETWEEN 1 AND 10000 AND amount >= 0.01 AND amount <= 10000
    AND regexp_matches(currency, '^[A-Z]{3}$') AND card_type IN ('Visa','MasterCard','Amex','Discover','Other')
    AND regexp_matches(location_country, '^[A-Z]{2}$') AND latitude BETWEEN -90 AND 90
    AND longitude BETWEEN -180 AND 180)"""
)


def user_profiles(spark: SparkSession, sf: str) -> DataFrame:
    """Users with the risk attributes the fraud view asks for."""
    k, balance = F.col("c_custkey"), F.col("c_acctbal")
    return table(spark, sf, "customer").select(
        k.alias("user_id"),
        (18 + k % 60).cast("int").alias("current_age"),
        (300 + (k * 37) % 550).cast("int").alias("credit_score"),
        F.when(balance < 0, "High").when(balance < 3000, "Medium").otherwise("Low").alias("risk_level"),
        ((k % 100) / F.lit(100.0)).alias("risk_score"),
    )


USER_PROFILES = """user_profiles AS (
  SELECT c_custkey AS user_id, CAST(18 + c_custkey % 60 AS INTEGER) AS current_age,
    CAST(300 + (c_custkey * 37) % 550 AS INTEGER) AS credit_score,
    CASE WHEN c_acctbal < 0 THEN 'High' WHEN c_acctbal < 3000 THEN 'Medium' ELSE 'Low' END AS risk_level,
    CAST(c_custkey % 100 AS DOUBLE) / CAST(100 AS DOUBLE) AS risk_score
  FROM customer)"""


def merchant_profiles(spark: SparkSession, sf: str) -> DataFrame:
    k, balance = F.col("s_suppkey"), F.col("s_acctbal")
    return table(spark, sf, "supplier").select(
        F.concat(F.lit("m"), k.cast("string")).alias("merchant_id"),
        F.when(balance < 0, "High").when(balance < 3000, "Medium").otherwise("Low").alias("risk_level"),
        ((k % 100) / F.lit(100.0)).alias("risk_score"),
    )


MERCHANT_PROFILES = """merchant_profiles AS (
  SELECT 'm' || s_suppkey AS merchant_id,
    CASE WHEN s_acctbal < 0 THEN 'High' WHEN s_acctbal < 3000 THEN 'Medium' ELSE 'Low' END AS risk_level,
    CAST(s_suppkey % 100 AS DOUBLE) / CAST(100 AS DOUBLE) AS risk_score
  FROM supplier)"""


def stream_indicators(spark: SparkSession, sf: str) -> DataFrame:
    """Daily indicators of the message stream: average event value per type."""
    e = table(spark, sf, "events")
    mean = F.sum(F.col("value").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))
    return e.groupBy("event_type", F.to_date("ts").alias("date")).agg(mean.alias("value")).select(
        F.col("event_type").alias("indicator_id"),
        F.when(F.col("event_type") == "error", "unemployment_rate").otherwise(F.col("event_type")).alias("indicator_name"),
        "value",
        "date",
        F.lit("US").alias("country"),
    )


STREAM_INDICATORS = """stream_indicators AS (
  SELECT event_type AS indicator_id, CASE WHEN event_type = 'error' THEN 'unemployment_rate' ELSE event_type END AS indicator_name,
    CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS value, CAST(ts AS DATE) AS date, 'US' AS country
  FROM events GROUP BY event_type, CAST(ts AS DATE))"""


def indicator_envelopes(spark: SparkSession, sf: str) -> DataFrame:
    body = F.struct("indicator_id", "indicator_name", "value", F.col("date").cast("string").alias("date"), "country")
    return stream_indicators(spark, sf).select(F.to_json(body).alias("record_content"), F.lit("{}").alias("record_metadata"))


def with_change(indicators: DataFrame) -> DataFrame:
    """Stream indicators in the shape of the warehouse indicators."""
    return indicators.select(
        F.col("indicator_id").alias("indicator"), "date", "value", F.lit("daily").alias("frequency"), "country", "indicator_name"
    )


# --- card warehouse (orders, customer, lineitem, supplier) ----------------------------------------------------------


def merchants(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_nationkey").cast("bigint")
    supplier = table(spark, sf, "supplier")
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("s_suppkey").alias("merchant_id"),
        F.col("s_name").alias("merchant_city"),
        F.col("n_name").alias("merchant_state"),
        F.lpad((F.col("s_suppkey") % 100000).cast("string"), 5, "0").alias("zip"),
        ((k * 7) % 180 - 90).cast("double").alias("merchant_latitude"),
        ((k * 29) % 360 - 180).cast("double").alias("merchant_longitude"),
    )


MERCHANTS = """merchants AS (
  SELECT s_suppkey AS merchant_id, s_name AS merchant_city, n_name AS merchant_state,
    lpad(CAST(s_suppkey % 100000 AS VARCHAR), 5, '0') AS zip,
    CAST((s_nationkey * 7) % 180 - 90 AS DOUBLE) AS merchant_latitude,
    CAST((s_nationkey * 29) % 360 - 180 AS DOUBLE) AS merchant_longitude
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey)"""


def raw_transactions(spark: SparkSession, sf: str) -> DataFrame:
    """Card transactions: one per order, at the order's first supplier (257 orders of sf0.01 have none)."""
    first = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("id"))
        .agg(F.min("l_suppkey").alias("merchant_id"))
    )
    return bare_transactions(spark, sf).join(first, "id", "left").select(
        "id", "client_id", "card_id", "merchant_id", "amount", "use_chip", "date"
    )


def bare_transactions(spark: SparkSession, sf: str) -> DataFrame:
    """Card transactions without their merchant."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("client_id"),
        F.col("o_custkey").alias("card_id"),
        F.col("o_totalprice").alias("amount"),
        (F.col("o_orderstatus") == "F").alias("use_chip"),
        F.col("o_orderdate").alias("date"),
    )


RAW_TRANSACTIONS = """raw_transactions AS (
  SELECT o_orderkey AS id, o_custkey AS client_id, o_custkey AS card_id, merchant_id, o_totalprice AS amount,
    o_orderstatus = 'F' AS use_chip, o_orderdate AS date
  FROM orders LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS merchant_id FROM lineitem GROUP BY l_orderkey) f
    ON o_orderkey = l_orderkey)"""


def raw_cards(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        k.alias("id"),
        k.alias("client_id"),
        F.col("c_mktsegment").alias("card_brand"),
        F.when(k % 2 == 0, "Credit").otherwise("Debit").alias("card_type"),
        F.concat(F.lit("4000"), F.lpad(k.cast("string"), 12, "0")).alias("card_number"),
        F.lit("12/2030").alias("expires"),
        F.lpad((k % 1000).cast("string"), 3, "0").alias("cvv"),
        (F.col("c_nationkey") % 2 == 0).alias("has_chip"),
        (1 + k % 3).cast("int").alias("num_cards_issued"),
        (F.col("c_acctbal") * 50).alias("credit_limit"),
    )


RAW_CARDS = """raw_cards AS (
  SELECT c_custkey AS id, c_custkey AS client_id, c_mktsegment AS card_brand,
    CASE WHEN c_custkey % 2 = 0 THEN 'Credit' ELSE 'Debit' END AS card_type,
    '4000' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS card_number, '12/2030' AS expires,
    lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') AS cvv, c_nationkey % 2 = 0 AS has_chip,
    CAST(1 + c_custkey % 3 AS INTEGER) AS num_cards_issued, c_acctbal * 50 AS credit_limit
  FROM customer)"""


def raw_users(spark: SparkSession, sf: str) -> DataFrame:
    k, n = F.col("c_custkey"), F.col("c_nationkey").cast("bigint")
    return table(spark, sf, "customer").select(
        k.alias("id"),
        (18 + k % 60).cast("int").alias("current_age"),
        (1983 - k % 60).cast("int").alias("birth_year"),
        (1 + k % 12).cast("int").alias("birth_month"),
        F.when(k % 2 == 0, "Female").otherwise("Male").alias("gender"),
        F.col("c_name").alias("address"),
        ((n * 7) % 180 - 90).cast("double").alias("latitude"),
        ((n * 29) % 360 - 180).cast("double").alias("longitude"),
    )


RAW_USERS = """raw_users AS (
  SELECT c_custkey AS id, CAST(18 + c_custkey % 60 AS INTEGER) AS current_age,
    CAST(1983 - c_custkey % 60 AS INTEGER) AS birth_year, CAST(1 + c_custkey % 12 AS INTEGER) AS birth_month,
    CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender, c_name AS address,
    CAST((c_nationkey * 7) % 180 - 90 AS DOUBLE) AS latitude, CAST((c_nationkey * 29) % 360 - 180 AS DOUBLE) AS longitude
  FROM customer)"""


def fraud_labels(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("transaction_id"), (F.col("o_orderpriority") == "1-URGENT").alias("is_fraud")
    )


FRAUD_LABELS = "fraud_labels AS (SELECT o_orderkey AS transaction_id, o_orderpriority = '1-URGENT' AS is_fraud FROM orders)"

SERIES = {
    "1-URGENT": "UNRATE",
    "2-HIGH": "CPIAUCSL",
    "3-MEDIUM": "GDP",
    "4-NOT SPECIFIED": "FEDFUNDS",
    "5-LOW": "UMCSENT",
}


def raw_indicators(spark: SparkSession, sf: str) -> DataFrame:
    """Daily series on the time span of the orders: average price per priority."""
    mean = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))
    code = F.lit(None).cast("string")
    for priority, series in SERIES.items():
        code = F.when(F.col("o_orderpriority") == priority, series).otherwise(code)
    return (
        table(spark, sf, "orders")
        .groupBy(code.alias("indicator"), F.to_date("o_orderdate").alias("date"))
        .agg(mean.alias("value"))
        .select("indicator", "date", "value", F.lit("monthly").alias("frequency"), F.lit("US").alias("country"))
    )


RAW_INDICATORS = (
    "raw_indicators AS (SELECT CASE o_orderpriority "
    + " ".join(f"WHEN '{p}' THEN '{s}'" for p, s in SERIES.items())
    + """ END AS indicator, CAST(o_orderdate AS DATE) AS date,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS value, 'monthly' AS frequency, 'US' AS country
  FROM orders GROUP BY 1, 2)"""
)

NAMES_SQL = "CASE indicator " + " ".join(f"WHEN '{r[0]}' THEN '{r[1]}'" for r in S.INDICATOR_SERIES) + " END"


def newest(df: DataFrame, column: str) -> Column:
    """Newest value of a column as a scalar subquery: the ``as_of`` of a data set that ends in the past."""
    return df.agg(F.max(column)).scalar()
