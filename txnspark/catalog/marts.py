"""Staging, marts, views and dashboards over the test tables."""

from __future__ import annotations

import uuid
from dataclasses import fields
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnspark import bindings as B
from txnspark.catalog.registry import ctes, query
from txnspark.plans import cards, dashboards, staging, star
from txnspark.session import scratch_path
from txnspark.sources.tables import stored

# --- oracle fragments ----------------------------------------------------------------------------------------------

FACTS = ctes(B.RAW_TRANSACTIONS, B.RAW_CARDS, B.RAW_USERS, B.MERCHANTS, B.FRAUD_LABELS, B.RAW_INDICATORS) + """,
facts AS (
  SELECT t.id AS transaction_id, t.client_id, t.card_id, t.merchant_id, t.amount, t.use_chip, c.has_chip,
    t.date AS transaction_date, c.card_brand, c.card_type, c.credit_limit, u.current_age, u.gender,
    u.latitude AS user_latitude, u.longitude AS user_longitude, m.merchant_city, m.merchant_state, m.zip AS merchant_zip,
    m.merchant_latitude, m.merchant_longitude,
    date_sub('month', t.date, (SELECT max(o_orderdate) FROM orders)) AS months_since_transaction,
    CASE WHEN t.amount > c.credit_limit * CAST(0.9 AS DOUBLE) THEN 'High'
         WHEN t.amount > c.credit_limit * CAST(0.7 AS DOUBLE) THEN 'Medium' ELSE 'Low' END AS risk_level,
    CASE WHEN t.use_chip AND NOT c.has_chip THEN 'Anomaly' ELSE 'Normal' END AS card_usage_anomaly
  FROM raw_transactions t LEFT JOIN raw_cards c ON t.card_id = c.id LEFT JOIN raw_users u ON t.client_id = u.id
    LEFT JOIN merchants m ON t.merchant_id = m.merchant_id
  WHERE t.date IS NOT NULL),
series AS (
  SELECT *, (value - previous_value) / nullif(previous_value, 0) AS change_rate FROM (
    SELECT *, """ + B.NAMES_SQL + """ AS indicator_name,
      lag(value) OVER (PARTITION BY indicator ORDER BY date) AS previous_value FROM raw_indicators)),
analysis AS (
  SELECT f.* EXCLUDE (merchant_id, months_since_transaction, merchant_latitude, merchant_longitude),
    count(*) OVER (PARTITION BY f.client_id ORDER BY f.transaction_date
      RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS daily_transaction_count,
    CASE WHEN merchant_latitude IS NULL OR user_latitude IS NULL THEN NULL ELSE 2 * 6371010.0::DOUBLE * asin(sqrt(least(1.0::DOUBLE,
      pow(sin(radians(merchant_latitude - user_latitude) / 2), 2) + cos(radians(user_latitude))
      * cos(radians(merchant_latitude)) * pow(sin(radians(merchant_longitude - user_longitude) / 2), 2)))) END AS distance_to_merchant,
    CAST(hour(f.transaction_date) AS INTEGER) AS transaction_hour,
    CAST(dayofweek(f.transaction_date) + 1 AS INTEGER) AS transaction_day_of_week,
    e.value AS unemployment_rate, e.change_rate AS unemployment_change_rate, l.is_fraud
  FROM facts f LEFT JOIN series e ON CAST(f.transaction_date AS DATE) = e.date AND e.indicator = 'UNRATE'
    LEFT JOIN fraud_labels l ON f.transaction_id = l.transaction_id)
"""

STREAM = ctes(B.STAGED, B.USER_PROFILES, B.MERCHANT_PROFILES, B.STREAM_INDICATORS) + """,
stream_series AS (
  SELECT *, (value - previous_value) / nullif(previous_value, 0) AS change_rate FROM (
    SELECT *, lag(value) OVER (PARTITION BY indicator_id ORDER BY date) AS previous_value FROM stream_indicators)),
stream_analysis AS (
  SELECT t.transaction_id, t.user_id, t.merchant_id, CAST(t.amount AS DOUBLE) AS amount, t.currency AS currency_code,
    t.timestamp AS transaction_timestamp_utc, t.transaction_date_utc, t.is_fraud, u.current_age, u.credit_score,
    u.risk_level AS user_risk_level, u.risk_score AS user_risk_score, m.risk_level AS merchant_risk_level,
    m.risk_score AS merchant_risk_score, e.value AS unemployment_rate, e.change_rate AS unemployment_change_rate,
    t.location_country AS location_country_code, t.location_city, t.latitude, t.longitude, t.card_type,
    CAST(hour(t.timestamp) AS INTEGER) AS transaction_hour,
    CAST(dayofweek(t.timestamp) + 1 AS INTEGER) AS transaction_day_of_week
  FROM staged t LEFT JOIN user_profiles u ON t.user_id = u.user_id
    LEFT JOIN merchant_profiles m ON t.merchant_id = m.merchant_id
    LEFT JOIN stream_series e ON t.transaction_date_utc = e.date AND e.indicator_name = 'unemployment_rate')
"""

STAGED_COLUMNS = """transaction_id, user_id, CAST(amount AS DOUBLE) AS amount, currency, merchant_id, merchant_name,
  merchant_category, card_type, timestamp, location_country, location_city, latitude, longitude,
  CAST((timestamp AT TIME ZONE 'UTC') AT TIME ZONE 'Africa/Cairo' AS TIMESTAMP) AS transaction_timestamp_local,
  transaction_date_utc"""


# --- frames shared by queries --------------------------------------------------------------------------------------


def facts(spark, sf):
    orders = B.table(spark, sf, "orders")
    return cards.fact_transactions(
        B.raw_transactions(spark, sf),
        B.raw_cards(spark, sf),
        B.raw_users(spark, sf),
        B.merchants(spark, sf),
        as_of=B.newest(orders, "o_orderdate"),
    )


def series(spark, sf):
    return cards.fact_economic_indicators(B.raw_indicators(spark, sf))


def analysis(spark, sf):
    return cards.fraud_analysis(
        facts(spark, sf), series(spark, sf), B.fraud_labels(spark, sf), transactions=B.bare_transactions(spark, sf)
    )


def stream_analysis(spark, sf):
    indicators = cards.fact_economic_indicators(B.with_change(B.stream_indicators(spark, sf)))
    named = indicators.withColumn(
        "indicator_name", F.when(F.col("indicator") == "error", "unemployment_rate").otherwise(F.col("indicator"))
    )
    return star.fraud_analysis_view(
        B.staged(spark, sf), B.user_profiles(spark, sf), B.merchant_profiles(spark, sf), named
    )


# --- staging -------------------------------------------------------------------------------------------------------


@query(
    "stg_01_parse_envelope",
    ctes(B.MESSAGES)
    + "SELECT * EXCLUDE (is_fraud) REPLACE (CAST(amount AS DOUBLE) AS amount), "
    "transaction_timestamp_utc AS kafka_load_timestamp FROM messages",
)
def _(spark, sf):
    return staging.parse_transactions(B.envelopes(spark, sf))


@query("stg_02_03_staged_transactions", ctes(B.STAGED) + f"SELECT {STAGED_COLUMNS} FROM staged")
def _(spark, sf):
    return staging.stage_transactions(B.envelopes(spark, sf))


@query(
    "stg_03_rejected_transactions",
    ctes(B.MESSAGES)
    + """SELECT transaction_id, array_to_string(list_filter([
      CASE WHEN user_id BETWEEN 1 AND 10000 THEN NULL ELSE 'user_id' END,
      CASE WHEN amount BETWEEN 0.01 AND 10000 THEN NULL ELSE 'amount' END,
      CASE WHEN regexp_matches(currency, '^[A-Z]{3}$') THEN NULL ELSE 'currency' END], lambda v: v IS NOT NULL), ',') AS failed_rules
    FROM messages WHERE NOT (user_id BETWEEN 1 AND 10000 AND amount BETWEEN 0.01 AND 10000
      AND regexp_matches(currency, '^[A-Z]{3}$'))""",
)
def _(spark, sf):
    rejected = staging.rejected_transactions(B.envelopes(spark, sf))
    return rejected.select("transaction_id", F.concat_ws(",", "failed_rules").alias("failed_rules"))


@query("stg_04_indicators", ctes(B.STREAM_INDICATORS) + "SELECT * FROM stream_indicators")
def _(spark, sf):
    return staging.stage_indicators(B.indicator_envelopes(spark, sf))


@query(
    "stg_07_last_30_days",
    "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders "
    "WHERE o_orderdate >= (SELECT CAST(max(o_orderdate) AS DATE) - 30 FROM orders)",
)
def _(spark, sf):
    orders = B.table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return staging.last_days(orders, "o_orderdate", 30, B.newest(orders, "o_orderdate"))


# --- dimensions and facts ------------------------------------------------------------------------------------------

CALENDAR_SQL = """SELECT CAST(d AS DATE) AS date_id, CAST(d AS DATE) AS full_date, CAST(year(d) AS INTEGER) AS "year",
  CAST(month(d) AS INTEGER) AS "month", CAST(day(d) AS INTEGER) AS "day", CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
  CAST(dayofyear(d) AS INTEGER) AS day_of_year, CAST(quarter(d) AS INTEGER) AS quarter, monthname(d) AS month_name,
  dayname(d) AS day_name"""


@query(
    "dim_01_date",
    "WITH bounds AS (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders), "
    "days AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM bounds), "
    "per_day AS (SELECT CAST(o_orderdate AS DATE) AS full_date, count(*) AS n_orders FROM orders GROUP BY 1) "
    f"SELECT c.*, coalesce(n_orders, 0) AS n_orders FROM ({CALENDAR_SQL} FROM days) c LEFT JOIN per_day USING (full_date)",
)
def _(spark, sf):
    """The calendar of the orders' span with the number of orders per day."""
    orders = B.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("full_date"))
    bounds = orders.agg(F.min("full_date").alias("lo"), F.date_add(F.max("full_date"), 1).alias("hi"))
    per_day = orders.groupBy("full_date").agg(F.count(F.lit(1)).alias("n_orders"))
    return (
        star.dim_date_over(bounds, "lo", "hi").join(per_day, "full_date", "left").fillna(0, ["n_orders"])
    )


@query(
    "dim_02_location",
    ctes(B.STAGED)
    + "SELECT DISTINCT location_country AS country, location_city AS city, latitude, longitude FROM staged",
)
def _(spark, sf):
    return star.dim_location(B.staged(spark, sf))


@query("dim_03_merchants", ctes(B.STAGED) + "SELECT DISTINCT merchant_id, merchant_name, merchant_category FROM staged")
def _(spark, sf):
    return star.dim_merchants(B.staged(spark, sf))


@query(
    "dim_04_users",
    ctes(B.STAGED) + "SELECT DISTINCT user_id, (SELECT max(ts) FROM events) AS created_at FROM staged",
)
def _(spark, sf):
    return star.dim_users(B.staged(spark, sf), B.newest(B.table(spark, sf, "events"), "ts"))


@query(
    "dim_05_users",
    ctes(B.RAW_USERS)
    + """SELECT DISTINCT id AS user_id, current_age, birth_year, birth_month, gender, address, latitude, longitude,
      CASE WHEN current_age < 30 THEN 'Young' WHEN current_age BETWEEN 30 AND 50 THEN 'Middle Age' ELSE 'Senior' END AS age_group,
      CAST(make_date(birth_year, birth_month, 1) AS TIMESTAMP) AS birth_date FROM raw_users""",
)
def _(spark, sf):
    return cards.dim_users(B.raw_users(spark, sf))


@query(
    "dim_06_cards",
    ctes(B.RAW_CARDS)
    + """SELECT DISTINCT id AS card_id, client_id, card_brand, card_type, '************' || right(card_number, 4) AS card_number,
      expires, '***' AS cvv, has_chip, num_cards_issued, credit_limit,
      CASE WHEN credit_limit > 5000 THEN 'High' WHEN credit_limit > 2000 THEN 'Medium' ELSE 'Low' END AS credit_limit_category
    FROM raw_cards""",
)
def _(spark, sf):
    return cards.dim_cards(B.raw_cards(spark, sf))


@query(
    "dim_07_merchants",
    ctes(B.RAW_TRANSACTIONS, B.MERCHANTS)
    + """SELECT DISTINCT t.merchant_id, merchant_city, merchant_state, zip, merchant_city || ', ' || merchant_state AS merchant_location
    FROM raw_transactions t JOIN merchants m ON t.merchant_id = m.merchant_id
    WHERE merchant_city IS NOT NULL AND merchant_state IS NOT NULL""",
)
def _(spark, sf):
    transactions = B.raw_transactions(spark, sf).join(B.merchants(spark, sf), "merchant_id", "left")
    return cards.dim_merchants(transactions)


@query(
    "fct_01_transactions",
    ctes(B.STAGED)
    + """, d AS (SELECT DISTINCT transaction_date_utc FROM staged),
    u AS (SELECT DISTINCT user_id FROM staged),
    m AS (SELECT DISTINCT merchant_id FROM staged),
    l AS (SELECT DISTINCT location_country, location_city, latitude, longitude FROM staged)
    SELECT t.transaction_id, d.transaction_date_utc AS date_key, u.user_id AS user_key, m.merchant_id AS merchant_key,
      l.location_country AS location_key, CAST(t.amount AS DOUBLE) AS amount, t.currency
    FROM staged t LEFT JOIN d ON t.transaction_date_utc = d.transaction_date_utc LEFT JOIN u ON t.user_id = u.user_id
      LEFT JOIN m ON t.merchant_id = m.merchant_id
      LEFT JOIN l ON t.location_country = l.location_country AND t.location_city = l.location_city
        AND t.latitude = l.latitude AND t.longitude = l.longitude""",
)
def _(spark, sf):
    """Keys are those found in the dimensions, which are made of all the facts."""
    staged = B.staged(spark, sf)
    bounds = staged.agg(
        F.min("transaction_date_utc").alias("lo"), F.date_add(F.max("transaction_date_utc"), 1).alias("hi")
    )
    return star.fct_transactions(
        staged,
        star.dim_date_over(bounds, "lo", "hi"),
        star.dim_users(staged),
        star.dim_merchants(staged),
        star.dim_location(staged),
    )


@query(
    "fct_02_transactions",
    FACTS + "SELECT * FROM facts",
)
def _(spark, sf):
    return facts(spark, sf)


@query("fct_03_indicators", ctes(B.STREAM_INDICATORS) + "SELECT * FROM stream_indicators")
def _(spark, sf):
    return star.fct_economic_indicators(B.stream_indicators(spark, sf))


@query(
    "fct_04_indicators",
    FACTS + "SELECT indicator, date, value, frequency, country, indicator_name, previous_value, change_rate FROM series",
)
def _(spark, sf):
    return series(spark, sf)


@query(
    "pipe_01_published_marts",
    FACTS
    + """, m AS (SELECT DISTINCT t.merchant_id, merchant_city, merchant_state, zip FROM raw_transactions t JOIN merchants m ON t.merchant_id = m.merchant_id
      WHERE merchant_city IS NOT NULL AND merchant_state IS NOT NULL),
    early AS (SELECT count(*) AS n FROM facts WHERE transaction_id % 2 = 0)
    SELECT 'dim_cards' AS mart, (SELECT count(*) FROM raw_cards) AS n, CAST(NULL AS BIGINT) AS n_seen_before
    UNION ALL SELECT 'dim_merchants', (SELECT count(*) FROM m), NULL
    UNION ALL SELECT 'dim_users', (SELECT count(*) FROM raw_users), NULL
    UNION ALL SELECT 'fact_economic_indicators', (SELECT count(*) FROM series), NULL
    UNION ALL SELECT 'fact_transactions', (SELECT count(*) FROM facts), (SELECT n FROM early)
    UNION ALL SELECT 'fraud_analysis_view', (SELECT count(*) FROM analysis), (SELECT n FROM early)
    UNION ALL SELECT 'ml_features', (SELECT count(*) FROM analysis), (SELECT n FROM early)""",
)
def _(spark, sf):
    """All marts published twice, from half of the transactions and from all; readers opened before the second version
    go on with the first, whoever asks by name gets the second.

    Four marts read the raw transactions and six joins the merchants: both are stored once, which also tells Spark how
    small the merchants are, where the estimate of a join would have every transaction shuffled to them."""
    database, root = f"marts_{uuid.uuid4().hex}", scratch_path(spark, "marts")
    merchants = stored(B.merchants(spark, sf), "merchants")
    raw = stored(B.raw_transactions(spark, sf).join(merchants, "merchant_id", "left"), "raw-transactions")
    rest = [B.raw_cards(spark, sf), B.raw_users(spark, sf), merchants, B.raw_indicators(spark, sf), B.fraud_labels(spark, sf)]
    now = B.newest(B.table(spark, sf, "orders"), "o_orderdate")
    spark.sql(f"CREATE DATABASE {database}")
    try:
        before = cards.write_marts(raw.where("id % 2 = 0"), *rest, now, database, root)
        after = cards.write_marts(raw, *rest, now, database, root)
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")
    count, growing = F.count(F.lit(1)), ("fact_transactions", "fraud_analysis_view", "ml_features")
    out = []
    for f in fields(after):
        seen = getattr(before, f.name).agg(count) if f.name in growing else None
        known = seen.scalar() if seen is not None else F.lit(None).cast("bigint")
        out.append(getattr(after, f.name).agg(F.lit(f.name).alias("mart"), count.alias("n")).withColumn("n_seen_before", known))
    return reduce(DataFrame.unionByName, out)


# --- views ---------------------------------------------------------------------------------------------------------


@query("view_01_fraud_analysis", STREAM + "SELECT * FROM stream_analysis")
def _(spark, sf):
    return stream_analysis(spark, sf)


@query(
    "view_02_fraud_analysis",
    FACTS + "SELECT * REPLACE (round(distance_to_merchant) AS distance_to_merchant) FROM analysis",
)
def _(spark, sf):
    return analysis(spark, sf).withColumn("distance_to_merchant", F.round("distance_to_merchant"))


@query(
    "view_03_ml_features",
    STREAM
    + """SELECT a.transaction_id, a.amount, transaction_hour, transaction_day_of_week, current_age, credit_score,
      user_risk_score, user_risk_level, merchant_risk_score, merchant_risk_level, unemployment_rate,
      unemployment_change_rate, a.latitude, a.longitude, CASE WHEN a.card_type = 'chip' THEN 1 ELSE 0 END AS use_chip,
      count(*) OVER (w ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS transaction_count_last_24h,
      CAST(sum(s.amount) OVER (w ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS DOUBLE)
        / count(*) OVER (w ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS avg_amount_last_7d,
      count(*) OVER (PARTITION BY a.user_id ORDER BY a.transaction_timestamp_utc
        RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS transaction_count_24h_range,
      a.is_fraud
    FROM stream_analysis a JOIN staged s USING (transaction_id)
    WINDOW w AS (PARTITION BY a.user_id ORDER BY a.transaction_timestamp_utc, a.transaction_id)""",
)
def _(spark, sf):
    return star.ml_features_view(stream_analysis(spark, sf), with_ranges=True, transactions=B.staged(spark, sf))


@query(
    "view_04_ml_features",
    FACTS
    + "SELECT "
    + ", ".join(c for c in cards.FEATURE_COLUMNS if c != "distance_to_merchant")
    + ", round(distance_to_merchant) AS distance_to_merchant, transaction_date FROM analysis",
)
def _(spark, sf):
    return cards.ml_features(analysis(spark, sf)).withColumn("distance_to_merchant", F.round("distance_to_merchant"))


# --- dashboards ----------------------------------------------------------------------------------------------------


@query(
    "dash_01_daily_transactions",
    """WITH daily AS (
      SELECT CAST(ts AS DATE) AS date, count(*) AS transaction_count,
        CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
        CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) AS avg_amount,
        count(DISTINCT user_id) AS unique_users
      FROM events WHERE ts >= (SELECT CAST(max(ts) AS DATE) - 30 FROM events) GROUP BY 1)
    SELECT *, round((transaction_count - lag(transaction_count) OVER (ORDER BY date)) * CAST(100 AS DOUBLE)
      / lag(transaction_count) OVER (ORDER BY date), 2) AS daily_change
    FROM daily ORDER BY date DESC LIMIT 30""",
)
def daily_transactions(spark, sf):
    events = B.table(spark, sf, "events").select(
        F.col("ts").alias("transaction_date"),
        F.col("user_id").alias("client_id"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
    )
    return dashboards.transaction_dashboard(events, B.newest(events, "transaction_date"))


@query(
    "dash_02_fraud",
    """WITH daily AS (
      SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS total_transactions,
        count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) AS fraud_count,
        round(count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) * CAST(100 AS DOUBLE) / count(*), 2) AS fraud_rate,
        CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE)
          / nullif(count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END), 0) AS avg_fraud_amount
      FROM orders WHERE o_orderdate >= (SELECT CAST(max(o_orderdate) AS DATE) - 7 FROM orders) GROUP BY 1)
    SELECT *, round((fraud_rate - lag(fraud_rate) OVER (ORDER BY date)) * CAST(100 AS DOUBLE)
      / nullif(lag(fraud_rate) OVER (ORDER BY date), 0), 2) AS daily_change
    FROM daily ORDER BY date DESC LIMIT 7""",
)
def _(spark, sf):
    orders = B.bare_transactions(spark, sf)
    labelled = orders.join(B.fraud_labels(spark, sf), F.col("id") == F.col("transaction_id"), "left").select(
        F.col("date").alias("transaction_date"), F.col("amount").cast("decimal(18,2)").alias("amount"), "is_fraud"
    )
    return dashboards.fraud_dashboard(labelled, B.newest(orders, "date"))


@query(
    "dash_03_indicators",
    FACTS
    + """SELECT date, indicator_name, value, change_rate * 100 AS percentage_change,
      lag(value) OVER (PARTITION BY indicator_name ORDER BY date) AS previous_value
    FROM series WHERE date >= (SELECT max(date) - 90 FROM raw_indicators) ORDER BY indicator_name, date""",
)
def _(spark, sf):
    return dashboards.economic_dashboard(series(spark, sf), B.newest(B.raw_indicators(spark, sf), "date"))
