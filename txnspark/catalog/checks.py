"""Data-quality checks over the test tables. Thresholds are chosen so that the checks find something."""

from __future__ import annotations

from pyspark.sql import functions as F

from txnspark import bindings as B
from txnspark import schemas as S
from txnspark.catalog.registry import ctes, query
from txnspark.operators import contracts as C
from txnspark.operators import quality as Q

table = B.table


@query(
    "qc_01_accepted_range",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice < 2000 OR o_totalprice > 490000",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return Q.accepted_range(orders, "o_totalprice", 2000, 490000)


ERRORS_ONLY = "CASE WHEN event_type = 'error' THEN value END"


@query(
    "qc_02_at_least_one",
    f"SELECT event_type, count({ERRORS_ONLY}) AS filler_column FROM events GROUP BY 1 HAVING count({ERRORS_ONLY}) = 0",
)
def _(spark, sf):
    return Q.at_least_one(table(spark, sf, "events"), ERRORS_ONLY, ["event_type"])


@query(
    "qc_03_cardinality_equality",
    """WITH a AS (SELECT o_custkey, count(*) AS num_rows FROM orders GROUP BY 1), b AS (SELECT c_custkey, count(*) AS num_rows FROM customer GROUP BY 1)
    (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def _(spark, sf):
    return Q.cardinality_equality(table(spark, sf, "orders"), "o_custkey", table(spark, sf, "customer"), "c_custkey")


@query(
    "qc_04_equal_rowcount",
    """WITH a AS (SELECT user_id, count(*) AS count_a FROM events WHERE event_type = 'error' AND user_id % 5 <> 1 GROUP BY 1),
    b AS (SELECT user_id, count(*) AS count_b FROM events WHERE event_type = 'click' AND user_id % 5 <> 2 GROUP BY 1)
    SELECT a.user_id AS user_id_a, b.user_id AS user_id_b, count_a, count_b, abs(count_a - count_b) AS diff_count
    FROM a FULL JOIN b ON a.user_id = b.user_id""",
)
def _(spark, sf):
    e = table(spark, sf, "events")
    a = e.where("event_type = 'error' AND user_id % 5 <> 1")
    return Q.equal_rowcount(a, e.where("event_type = 'click' AND user_id % 5 <> 2"), ["user_id"])


@query(
    "qc_05_equality",
    """WITH a AS (SELECT o_custkey, o_orderstatus FROM orders WHERE o_totalprice < 250000),
    b AS (SELECT o_custkey, o_orderstatus FROM orders WHERE o_totalprice >= 250000)
    SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
    UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders")
    return Q.equality(
        orders.where("o_totalprice < 250000"), orders.where("o_totalprice >= 250000"), ["o_custkey", "o_orderstatus"]
    )


@query(
    "qc_06_expression_is_true",
    "SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem WHERE NOT (l_quantity * l_discount < 4)",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return Q.expression_is_true(lines, "* l_discount < 4", "l_quantity")


@query(
    "qc_07_fewer_rows_than",
    """WITH a AS (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1),
    b AS (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'click' GROUP BY 1)
    SELECT a.user_id AS user_id_a, b.user_id AS user_id_b, a.n AS count_our_model, b.n AS count_comparison_model,
      CASE WHEN a.n > b.n THEN a.n - b.n WHEN a.n = b.n THEN 1 ELSE 0 END AS row_count_delta
    FROM a FULL JOIN b ON a.user_id = b.user_id""",
)
def _(spark, sf):
    e = table(spark, sf, "events")
    return Q.fewer_rows_than(e.where("event_type = 'error'"), e.where("event_type = 'click'"), ["user_id"])


SESSIONS = """sessions AS (SELECT user_id, ts AS valid_from,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE ts + CAST(event_id % 240 AS INTEGER) * INTERVAL 1 MINUTE END AS valid_to FROM events)"""


def sessions(spark, sf):
    minutes = F.timestamp_add("MINUTE", (F.col("event_id") % 240).cast("int"), F.col("ts")).cast("timestamp_ntz")
    end = F.when(F.col("event_id") % 97 != 0, minutes)
    return table(spark, sf, "events").select("user_id", F.col("ts").alias("valid_from"), end.alias("valid_to"))


RANGES = ctes(SESSIONS) + """SELECT * FROM (
  SELECT {select}, next_lower_bound, is_last_record, coalesce(lower_bound {length} upper_bound, false) AS lower_bound_{length_words}_upper_bound,
    coalesce(upper_bound {gap} next_lower_bound, is_last_record, false) AS upper_bound_{gap_words}_next_lower_bound
  FROM (SELECT user_id AS partition_by_col, valid_from AS lower_bound, valid_to AS upper_bound,
      lead(valid_from) OVER ({part} ORDER BY valid_from, valid_to NULLS FIRST) AS next_lower_bound,
      row_number() OVER ({part} ORDER BY valid_from DESC, valid_to DESC NULLS LAST) = 1 AS is_last_record FROM sessions))
WHERE NOT (lower_bound_{length_words}_upper_bound AND upper_bound_{gap_words}_next_lower_bound)"""


@query(
    "qc_08_mutually_exclusive_ranges",
    RANGES.format(
        select="partition_by_col, lower_bound, upper_bound", part="PARTITION BY user_id", length="<", length_words="less_than",
        gap="<=", gap_words="less_than_or_equal_to",
    ),
)
def _(spark, sf):
    return Q.mutually_exclusive_ranges(sessions(spark, sf), "valid_from", "valid_to", "user_id")


@query(
    "qc_08_ranges_ungrouped",
    RANGES.format(
        select="lower_bound, upper_bound", part="", length="<=", length_words="less_than_or_equal_to",
        gap="<", gap_words="less_than",
    ),
)
def _(spark, sf):
    """One global sequence of ranges, without a window over the whole table."""
    return Q.mutually_exclusive_ranges(
        sessions(spark, sf), "valid_from", "valid_to", gaps="required", zero_length_range_allowed=True
    )


@query(
    "qc_09_not_accepted_values",
    "SELECT DISTINCT o_orderpriority AS value_field FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW', 'NONE')",
)
def _(spark, sf):
    return Q.not_accepted_values(table(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "5-LOW", "NONE"])


@query(
    "qc_10_not_constant",
    "SELECT l_orderkey, count(DISTINCT l_returnflag) AS filler_column FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) = 1",
)
def _(spark, sf):
    return Q.not_constant(table(spark, sf, "lineitem"), "l_returnflag", ["l_orderkey"])


PADDED = "CASE WHEN o_orderkey % 10 = 0 THEN '   ' WHEN o_orderkey % 10 = 1 THEN '' WHEN o_orderkey % 10 = 2 THEN NULL ELSE o_orderstatus || ' ' END"


@query("qc_11_not_empty_string", f"SELECT o_orderkey, '' AS note FROM orders WHERE trim({PADDED}) = ''")
def _(spark, sf):
    notes = table(spark, sf, "orders").select("o_orderkey", F.expr(PADDED).alias("note"))
    return Q.not_empty_string(notes, "note")


@query(
    "qc_12_not_null_proportion",
    f"""SELECT * FROM (SELECT user_id, CAST(count({ERRORS_ONLY}) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS not_null_proportion FROM events GROUP BY 1)
    WHERE not_null_proportion < CAST(0.18 AS DOUBLE) OR not_null_proportion > CAST(0.25 AS DOUBLE)""",
)
def _(spark, sf):
    return Q.not_null_proportion(table(spark, sf, "events"), ERRORS_ONLY, 0.18, 0.25, ["user_id"])


@query(
    "qc_13_recency",
    """WITH now AS (SELECT max(ts) AS t FROM events)
    SELECT user_id, CAST(max(ts) AS DATE) AS most_recent, CAST((SELECT t FROM now) - INTERVAL 1 DAY AS DATE) AS threshold
    FROM events GROUP BY user_id HAVING CAST(max(ts) AS DATE) < CAST((SELECT t FROM now) - INTERVAL 1 DAY AS DATE)""",
)
def _(spark, sf):
    e = table(spark, sf, "events")
    return Q.recency(e, "ts", "day", 1, True, ["user_id"], B.newest(e, "ts"))


@query(
    "qc_14_relationships_where",
    """SELECT l_suppkey AS id, CAST(NULL AS BIGINT) AS right_id FROM lineitem
    WHERE l_suppkey IS NOT NULL AND l_returnflag = 'R' AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 1000)""",
)
def _(spark, sf):
    return Q.relationships_where(
        table(spark, sf, "lineitem"), "l_suppkey", table(spark, sf, "supplier"), "s_suppkey", "l_returnflag = 'R'", "s_acctbal > 1000"
    )


@query(
    "qc_15_sequential_values",
    """SELECT * FROM (SELECT o_custkey, lag(o_custkey) OVER (ORDER BY o_custkey) AS previous_o_custkey FROM orders)
    WHERE NOT (o_custkey = previous_o_custkey + 1)""",
)
def _(spark, sf):
    return Q.sequential_values(table(spark, sf, "orders"), "o_custkey", 1)


@query(
    "qc_15_sequential_days",
    """SELECT * FROM (SELECT o_orderpriority, o_orderdate, lag(o_orderdate) OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate) AS previous_o_orderdate
      FROM orders) WHERE NOT (o_orderdate = previous_o_orderdate + INTERVAL 1 DAY)""",
)
def _(spark, sf):
    """Five groups share all rows; equal days are counted before the comparison."""
    return Q.sequential_values(table(spark, sf, "orders"), "o_orderdate", 1, "day", ["o_orderpriority"])


@query(
    "qc_16_unique_combination",
    "SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def _(spark, sf):
    return Q.unique_combination_of_columns(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "qc_17_unique",
    "SELECT o_custkey AS unique_field, count(*) AS n_records FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
)
def _(spark, sf):
    return Q.unique(table(spark, sf, "orders"), "o_custkey")


@query(
    "qc_18_not_null",
    ctes(B.RAW_TRANSACTIONS) + "SELECT id, client_id, merchant_id FROM raw_transactions WHERE merchant_id IS NULL",
)
def _(spark, sf):
    return Q.not_null(B.raw_transactions(spark, sf), "merchant_id").select("id", "client_id", "merchant_id")


@query(
    "qc_19_accepted_values",
    ctes(B.MESSAGES)
    + "SELECT currency AS value_field, count(*) AS n_records FROM messages WHERE currency NOT IN ('USD', 'EUR', 'GBP') GROUP BY 1",
)
def _(spark, sf):
    return Q.accepted_values(B.messages(spark, sf), "currency", ["USD", "EUR", "GBP"])


@query(
    "qc_20_relationships",
    ctes(B.MESSAGES, B.MERCHANT_PROFILES)
    + "SELECT merchant_id AS from_field FROM messages WHERE merchant_id NOT IN (SELECT merchant_id FROM merchant_profiles WHERE risk_level = 'Low')",
)
def _(spark, sf):
    low = B.merchant_profiles(spark, sf).where("risk_level = 'Low'")
    return Q.relationships(B.messages(spark, sf), "merchant_id", low, "merchant_id")


@query("qc_21_values_between", "SELECT c_custkey, c_acctbal FROM customer WHERE NOT c_acctbal > 0")
def _(spark, sf):
    return Q.values_between(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", 0, strictly=True)


@query("qc_22_value_lengths", "SELECT p_partkey, p_brand FROM part WHERE length(p_brand) <> 8")
def _(spark, sf):
    return Q.value_lengths_equal(table(spark, sf, "part").select("p_partkey", "p_brand"), "p_brand", 8)


@query(
    "qc_23_assert_equal",
    """WITH t AS (SELECT l_orderkey, l_linenumber, l_returnflag AS actual, nullif(l_linestatus, 'O') AS expected FROM lineitem)
    SELECT * FROM t WHERE actual IS DISTINCT FROM expected""",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_returnflag").alias("actual"), F.nullif("l_linestatus", F.lit("O")).alias("expected")
    )
    return Q.assert_equal(lines, "actual", "expected", null_safe=True)


@query(
    "qc_24_columns_match_set",
    "SELECT 'L_COMMENT' AS column_name, count(*) AS n_rows FROM lineitem UNION ALL SELECT 'L_TAX', count(*) FROM lineitem",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem")
    odd = Q.columns_match_set(lines, [c for c in lines.columns if c != "l_tax"] + ["l_comment"])
    n = lines.agg(F.count(F.lit(1)).alias("n_rows"))
    return n.select(F.explode(F.array(*[F.lit(c) for c in sorted(odd)])).alias("column_name"), "n_rows")


@query(
    "qc_25_run_checks",
    """SELECT 'price range' AS "check", count(*) AS failures, 'error' AS severity, 'error' AS status FROM orders WHERE o_totalprice > 400000
    UNION ALL SELECT 'unique key', count(*), 'error', 'pass' FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'statuses', count(*), 'warn', 'warn' FROM (SELECT DISTINCT o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O') AND o_custkey > 10)
    UNION ALL SELECT 'tolerated', count(*), 'error', 'warn' FROM orders WHERE o_totalprice < 20000""",
)
def _(spark, sf):
    return Q.run_checks(
        table(spark, sf, "orders"),
        [
            Q.Check("price range", Q.range_rule("o_totalprice", max_value=400000), "error"),
            Q.Check("unique key", Q.unique_rule("o_orderkey"), "error"),
            Q.Check("statuses", Q.values_rule("o_orderstatus", ["F", "O"]), where="o_custkey > 10"),
            Q.Check("tolerated", Q.range_rule("o_totalprice", min_value=20000), "error", error_if="> 1000000000"),
        ],
    )


@query(
    "qc_26_contract_violations",
    ctes(B.MESSAGES)
    + """SELECT * FROM (
      SELECT 'user_id: minimum' AS rule, count(*) AS failures FROM messages WHERE user_id < 1
      UNION ALL SELECT 'amount: minimum', count(*) FROM messages WHERE amount < 0.01
      UNION ALL SELECT 'currency: pattern', count(*) FROM messages WHERE currency = 'usd'
      UNION ALL SELECT 'merchant_category: enum', count(*) FROM messages) WHERE failures > 0""",
)
def _(spark, sf):
    """Event types are no merchant categories, so that rule fails for every row."""
    iso = F.date_format("transaction_timestamp_utc", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    m = B.messages(spark, sf).withColumn("timestamp", iso)
    return C.violation_counts(m, C.transaction_rules(uuid_keys=False))


@query(
    "qc_27_expectations",
    ctes(B.MESSAGES)
    + f"""SELECT 'transaction_id unique' AS "check", 0 AS failures, 'warn' AS severity, 'pass' AS status
    UNION ALL SELECT 'amount > 0', count(*), 'warn', CASE WHEN count(*) = 0 THEN 'pass' ELSE 'warn' END FROM messages WHERE amount <= 0
    UNION ALL SELECT 'timestamp within 48 h', count(*), 'warn', 'warn' FROM messages
      WHERE transaction_timestamp_utc < (SELECT max(ts) - INTERVAL 48 HOUR FROM events)
    UNION ALL SELECT 'merchant_category enum', count(DISTINCT merchant_category), 'warn', 'warn' FROM messages
    UNION ALL SELECT 'card_type enum', count(*), 'warn', 'pass' FROM messages WHERE card_type NOT IN ({", ".join(f"'{c}'" for c in S.CARD_TYPES)})""",
)
def _(spark, sf):
    m = B.messages(spark, sf)
    now = B.newest(m, "transaction_timestamp_utc")
    return Q.run_checks(m, C.transaction_expectations(now, "transaction_timestamp_utc"))


@query(
    "qc_27_indicator_expectations",
    ctes(B.RAW_INDICATORS)
    + """, feed AS (SELECT CASE WHEN day(date) % 6 = 0 THEN NULL WHEN day(date) % 7 = 0 THEN 0 ELSE 1 END AS value,
      CASE WHEN day(date) % 5 = 0 THEN 'usa' ELSE 'US' END AS country,
      CASE WHEN indicator = 'GDP' THEN 'quarterly' WHEN indicator = 'UNRATE' THEN 'weekly' ELSE 'monthly' END AS frequency FROM raw_indicators),
    counted AS (
      SELECT 'value is a number' AS "check", count(*) FILTER (value IS NULL) AS failures FROM feed
      UNION ALL SELECT 'country code', count(*) FILTER (country = 'usa') FROM feed
      UNION ALL SELECT 'frequency enum', count(DISTINCT frequency) FILTER (frequency = 'weekly') FROM feed)
    SELECT "check", failures, 'warn' AS severity, CASE WHEN failures = 0 THEN 'pass' ELSE 'warn' END AS status FROM counted""",
)
def _(spark, sf):
    """The indicator feed with planted faults: no value on every sixth day, a wrong country on every fifth, one frequency."""
    raw = B.raw_indicators(spark, sf)
    day = F.dayofmonth("date")
    feed = raw.select(
        F.when(day % 6 != 0, F.when(day % 7 == 0, 0.0).otherwise(1.0)).alias("value"),
        F.when(day % 5 == 0, "usa").otherwise("US").alias("country"),
        F.when(F.col("indicator") == "GDP", "quarterly").when(F.col("indicator") == "UNRATE", "weekly").otherwise("monthly").alias("frequency"),
    )
    return Q.run_checks(feed, C.indicator_expectations())


@query(
    "qc_27_exchange_rate_expectations",
    """WITH feed AS (
      SELECT count(*) / CAST(8 AS DOUBLE) - 1 AS rate, upper(left(event_type, 3)) AS code, CAST(ts AS DATE) AS day
      FROM events GROUP BY event_type, CAST(ts AS DATE)),
    counted AS (
      SELECT 'rate >= 0' AS "check", count(*) FILTER (rate < 0) AS failures FROM feed
      UNION ALL SELECT 'base currency code', 0
      UNION ALL SELECT 'target currency code', count(*) FILTER (day(day) % 4 = 0) FROM feed
      UNION ALL SELECT 'timestamp not older than 24 h', count(*) FILTER (day < (SELECT max(day) - 1 FROM feed)) FROM feed)
    SELECT "check", failures, 'warn' AS severity, CASE WHEN failures = 0 THEN 'pass' ELSE 'warn' END AS status FROM counted""",
)
def _(spark, sf):
    """Daily event counts as rates, with planted faults: lower-case codes on every fourth day, rates below zero, old days."""
    daily = table(spark, sf, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    code = F.upper(F.left("event_type", F.lit(3)))
    feed = daily.select(
        (F.col("n") / F.lit(8.0) - 1).alias("rate"),
        F.lit("USD").alias("base_currency"),
        F.when(F.dayofmonth("day") % 4 == 0, F.lower(code)).otherwise(code).alias("target_currency"),
        F.date_format("day", "yyyy-MM-dd'T'00:00:00'+00:00'").alias("api_timestamp_iso_utc"),
    )
    now = B.newest(feed, "api_timestamp_iso_utc").cast("timestamp")
    return Q.run_checks(feed, C.exchange_rate_expectations(now))


@query(
    "qc_28_grouped_checks",
    """SELECT 'recency' AS "check", count(*) AS failures FROM (SELECT user_id FROM events GROUP BY 1
        HAVING max(ts) < (SELECT max(ts) - INTERVAL 6 HOUR FROM events))
    UNION ALL SELECT 'not_constant', count(*) FROM (SELECT user_id FROM events WHERE ts > (SELECT max(ts) - INTERVAL 2 DAY FROM events)
        GROUP BY 1 HAVING count(DISTINCT event_type) = 1)
    UNION ALL SELECT 'sequential_values', count(*) FROM (SELECT event_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events)
        WHERE NOT (event_id = p + 1)""",
)
def _(spark, sf):
    e = table(spark, sf, "events")
    now = B.newest(e, "ts")
    recent = e.where(F.col("ts") > now - F.expr("INTERVAL 2 DAY"))
    checks = {
        "recency": Q.recency(e, "ts", "hour", 6, group_by=["user_id"], as_of=now),
        "not_constant": Q.not_constant(recent, "event_type", ["user_id"]),
        "sequential_values": Q.sequential_values(e, "event_id", 1, group_by=["user_id"]),
    }
    counted = [v.agg(F.lit(n).alias("check"), F.count(F.lit(1)).alias("failures")) for n, v in checks.items()]
    return counted[0].union(counted[1]).union(counted[2])
