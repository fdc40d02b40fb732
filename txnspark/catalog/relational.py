"""Joins, aggregates, windows, sorts, set operations, reshaping and generators over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from txnspark import bindings as B
from txnspark.catalog.registry import ctes, query
from txnspark.operators import columns, generators, reshape, values
from txnspark.operators import windows as W
from txnspark.plans import staging

table = B.table


# --- projections and filters ---------------------------------------------------------------------------------------


@query("stg_05_filter", "SELECT c_custkey, c_name FROM customer WHERE c_nationkey = 1")
def _(spark, sf):
    return table(spark, sf, "customer").where(F.col("c_nationkey") == 1).select("c_custkey", "c_name")


@query(
    "stg_06_not_null",
    ctes(B.RAW_TRANSACTIONS) + "SELECT id, merchant_id, amount FROM raw_transactions WHERE date IS NOT NULL AND merchant_id IS NOT NULL",
)
def _(spark, sf):
    t = B.raw_transactions(spark, sf).where(F.col("date").isNotNull() & F.col("merchant_id").isNotNull())
    return t.select("id", "merchant_id", "amount")


@query(
    "stg_08_star",
    "SELECT o_orderkey AS src_o_orderkey_v1, o_custkey AS src_o_custkey_v1, o_orderstatus AS src_o_orderstatus_v1, "
    "o_orderpriority AS src_o_orderpriority_v1 FROM orders",
)
def _(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.select(*columns.star(orders, ["O_TOTALPRICE", "o_orderdate"], "src_", "_v1"))


@query("stg_09_filtered_columns", "SELECT p_partkey, p_name, p_brand, p_size FROM part")
def _(spark, sf):
    part = table(spark, sf, "part")
    return part.select(*columns.filtered_columns(part, ["P_Type", "p_retailprice"]))


BLANKED = "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS status, o_orderpriority FROM orders"


@query(
    "stg_10_nullcheck",
    f"SELECT o_orderkey, nullif(status, '') AS status, nullif(o_orderpriority, '') AS o_orderpriority FROM ({BLANKED})",
)
def _(spark, sf):
    blanked = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus")).alias("status"),
        "o_orderpriority",
    )
    return columns.nullcheck_table(blanked)


@query(
    "stg_11_boolean_to_int",
    "SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS use_chip FROM orders",
)
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("use_chip"))


# --- joins ---------------------------------------------------------------------------------------------------------


@query(
    "join_01_left",
    "SELECT o_orderkey, c_name FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 = 0) c ON o_custkey = c_custkey",
)
def _(spark, sf):
    c = table(spark, sf, "customer").where(F.col("c_custkey") % 3 == 0)
    orders = table(spark, sf, "orders")
    return orders.join(c, orders.o_custkey == c.c_custkey, "left").select("o_orderkey", "c_name")


@query(
    "join_02_computed_key",
    ctes(B.STREAM_INDICATORS)
    + "SELECT event_id, i.value AS day_value FROM events e LEFT JOIN stream_indicators i "
    "ON CAST(e.ts AS DATE) = i.date AND i.indicator_id = 'purchase'",
)
def _(spark, sf):
    e = table(spark, sf, "events")
    i = B.stream_indicators(spark, sf).where(F.col("indicator_id") == "purchase")
    i = i.select(F.col("date").alias("day"), F.col("value").alias("day_value"))
    return e.join(i, F.to_date("ts") == i.day, "left").select("event_id", "day_value")


@query(
    "join_03_four_keys",
    ctes(B.MESSAGES)
    + """, places AS (SELECT DISTINCT location_country, nullif(location_city, 'City 3') AS location_city, latitude, longitude FROM messages)
    SELECT m.transaction_id, p.location_country AS place_country FROM messages m LEFT JOIN places p
      ON m.location_country = p.location_country AND m.location_city = p.location_city AND m.latitude = p.latitude
        AND m.longitude = p.longitude""",
)
def _(spark, sf):
    m = B.messages(spark, sf)
    keys = ["location_country", "location_city", "latitude", "longitude"]
    places = m.select(
        "location_country", F.nullif("location_city", F.lit("City 3")).alias("location_city"), "latitude", "longitude"
    ).distinct()
    found = places.withColumn("place_country", F.col("location_country"))
    return m.join(found, keys, "left").select("transaction_id", "place_country")


@query(
    "join_04_constant_in_on",
    "SELECT o_orderkey, n.n_name AS even_nation FROM orders JOIN customer ON o_custkey = c_custkey "
    "LEFT JOIN nation n ON c_nationkey = n_nationkey AND n.n_regionkey = 2",
)
def _(spark, sf):
    orders, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    n = table(spark, sf, "nation").where(F.col("n_regionkey") == 2)
    joined = orders.join(c, orders.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey, "left")
    return joined.select("o_orderkey", F.col("n_name").alias("even_nation"))


@query(
    "join_05_full_outer",
    """WITH a AS (SELECT user_id, count(*) AS n_errors FROM events WHERE event_type = 'error' AND user_id % 3 <> 0 GROUP BY 1),
    b AS (SELECT user_id, count(*) AS n_clicks FROM events WHERE event_type = 'click' AND user_id % 2 <> 0 GROUP BY 1)
    SELECT a.user_id AS user_a, b.user_id AS user_b, n_errors, n_clicks FROM a FULL JOIN b ON a.user_id = b.user_id""",
)
def _(spark, sf):
    """Both sides are counted per key first, so a hot user is one row when the join meets it."""
    e = table(spark, sf, "events")

    def counted(kind, modulus, key, out):
        part = e.where((F.col("event_type") == kind) & (F.col("user_id") % modulus != 0))
        return part.groupBy(F.col("user_id").alias(key)).agg(F.count(F.lit(1)).alias(out))

    a, b = counted("error", 3, "user_a", "n_errors"), counted("click", 2, "user_b", "n_clicks")
    return a.join(b, F.col("user_a") == F.col("user_b"), "full").select("user_a", "user_b", "n_errors", "n_clicks")


@query(
    "join_06_column_sets",
    """WITH r AS (SELECT unnest(['o_orderkey','o_custkey','o_orderstatus','o_totalprice','o_orderdate','o_orderpriority']) AS c),
    n AS (SELECT count(*) AS n_rows FROM orders)
    SELECT c AS column_name, n_rows FROM r, n WHERE c NOT IN ('o_orderkey', 'o_custkey', 'o_totalprice')
    UNION ALL SELECT 'o_comment', n_rows FROM n""",
)
def _(spark, sf):
    """Column names found on one side only, with the number of rows they concern."""
    from txnspark.operators.quality import columns_match_set

    orders = table(spark, sf, "orders")
    odd = columns_match_set(orders, ["o_orderkey", "O_CUSTKEY", "o_totalprice", "o_comment"], str.lower)
    counted = orders.agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select(F.explode(F.array(*[F.lit(c) for c in sorted(odd)])).alias("column_name"), "n_rows")


@query(
    "join_07_anti",
    "SELECT o_orderkey, o_totalprice FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey WHERE l_orderkey IS NULL",
)
def _(spark, sf):
    orders = table(spark, sf, "orders")
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return orders.join(lines, "o_orderkey", "left_anti").select("o_orderkey", "o_totalprice")


@query(
    "join_08_natural",
    """WITH first AS (SELECT user_id, min(ts) AS ts FROM events GROUP BY user_id)
    SELECT event_id, user_id, ts FROM events NATURAL JOIN first""",
)
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "ts")
    first = e.groupBy("user_id").agg(F.min("ts").alias("ts"))
    common = [c for c in e.columns if c in first.columns]
    return e.join(first, common).select("event_id", "user_id", "ts")


@query(
    "join_09_date_by_type",
    """WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events), t AS (SELECT DISTINCT event_type FROM events),
    n AS (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events WHERE value > 100 GROUP BY 1, 2)
    SELECT day, event_type, coalesce(n, 0) AS n FROM d CROSS JOIN t LEFT JOIN n USING (day, event_type)""",
)
def _(spark, sf):
    """Every day with every type: the types are a short list (an error above a thousand), written out per day."""
    e = table(spark, sf, "events").select(F.to_date("ts").alias("day"), "event_type", "value")
    counted = e.where("value > 100").groupBy("day", "event_type").agg(F.count(F.lit(1)).alias("n"))
    types = [F.lit(v).cast("string") for v in values.get_column_values(e, "event_type", bound=1000)]
    grid = e.select("day").distinct().select("day", F.explode(F.array(*types)).alias("event_type"))
    return grid.join(counted, ["day", "event_type"], "left").select("day", "event_type", F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "join_10_not_in",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)",
)
def _(spark, sf):
    """``NOT IN`` keeps its meaning with NULLs: a NULL on the right empties the result, an empty right side keeps all.

    The right side has no NULL here, which turns the null-aware join (one broadcast) into a plain anti join.
    """
    rich = table(spark, sf, "orders").where(F.col("o_totalprice") > 400000)
    rich = rich.select(F.col("o_custkey").alias("c_custkey"))
    has_null = F.coalesce(F.bool_or(F.col("c_custkey").isNull()), F.lit(False)).alias("has_null")
    right = rich.agg(F.struct(has_null, (F.count("*") == 0).alias("empty"))).scalar()
    c = table(spark, sf, "customer").select("c_custkey", "c_name").withColumn("_right", right)
    asked = c.where((F.col("c_custkey").isNotNull() & ~F.col("_right.has_null")) | F.col("_right.empty"))
    return asked.join(rich.where(F.col("c_custkey").isNotNull()).distinct(), "c_custkey", "left_anti").select("c_custkey", "c_name")


# --- aggregates ----------------------------------------------------------------------------------------------------


@query(
    "agg_01_daily",
    """SELECT CAST(ts AS DATE) AS day, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total,
      CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean, count(DISTINCT user_id) AS users
    FROM events GROUP BY 1""",
)
def _(spark, sf):
    cents = F.col("value").cast("decimal(18,2)")
    return (
        table(spark, sf, "events")
        .groupBy(F.to_date("ts").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(cents).cast("double").alias("total"),
            (F.sum(cents).cast("double") / F.count(F.lit(1))).alias("mean"),
            F.count_distinct("user_id").alias("users"),
        )
    )


@query(
    "agg_02_conditional",
    """SELECT CAST(ts AS DATE) AS day, count(CASE WHEN event_type = 'error' THEN 1 END) AS errors,
      CAST(sum(CASE WHEN event_type = 'error' THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE)
        / nullif(count(CASE WHEN event_type = 'error' THEN 1 END), 0) AS error_mean,
      round(count(CASE WHEN event_type = 'error' THEN 1 END) * CAST(100 AS DOUBLE) / count(*), 2) AS error_rate
    FROM events GROUP BY 1""",
)
def _(spark, sf):
    error = F.col("event_type") == "error"
    cents = F.when(error, F.col("value").cast("decimal(18,2)"))
    n = F.count(F.when(error, 1))
    return (
        table(spark, sf, "events")
        .groupBy(F.to_date("ts").alias("day"))
        .agg(
            n.alias("errors"),
            F.try_divide(F.sum(cents).cast("double"), n).alias("error_mean"),
            F.round(n * F.lit(100.0) / F.count(F.lit(1)), 2).alias("error_rate"),
        )
    )


@query("agg_03_group_as_distinct", "SELECT o_orderstatus, o_orderpriority FROM orders GROUP BY o_orderstatus, o_orderpriority")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@query(
    "agg_04_distinct_computed",
    "SELECT DISTINCT c_mktsegment, CASE WHEN c_acctbal > 5000 THEN 'High' ELSE 'Low' END AS band FROM customer",
)
def _(spark, sf):
    band = F.when(F.col("c_acctbal") > 5000, "High").otherwise("Low").alias("band")
    return table(spark, sf, "customer").select("c_mktsegment", band).distinct()


@query(
    "agg_05_having",
    "SELECT l_suppkey, count(*) AS n, count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY 1 "
    "HAVING count(*) > 50 AND count(DISTINCT l_orderkey) > 50",
)
def _(spark, sf):
    counted = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("l_orderkey").alias("orders")
    )
    return counted.where((F.col("n") > 50) & (F.col("orders") > 50))


@query(
    "agg_06_ungrouped",
    "SELECT max(ts) AS newest, min(ts) AS oldest, count(*) AS n FROM events",
)
def _(spark, sf):
    return table(spark, sf, "events").agg(
        F.max("ts").alias("newest"), F.min("ts").alias("oldest"), F.count(F.lit(1)).alias("n")
    )


@query(
    "agg_07_group_by_first",
    "SELECT l_returnflag, l_linestatus, count(*) AS total FROM lineitem GROUP BY 1, 2",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    return columns.group_by_first(lines, 2).agg(F.count(F.lit(1)).alias("total"))


@query(
    "agg_08_deduplicate",
    "SELECT user_id, event_type, event_id, ts, value FROM events "
    "QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1",
)
def _(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return reshape.deduplicate(e, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")])


@query(
    "agg_08_latest_by",
    "SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY 1",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return reshape.latest_by(orders, ["o_custkey"], "o_orderkey")


TYPES = ["click", "view", "purchase", "refund"]


@query(
    "agg_09_pivot",
    "SELECT user_id, "
    + ", ".join(f"CAST(sum(CASE WHEN event_type = '{t}' THEN 1 ELSE 0 END) AS BIGINT) AS n_{t}" for t in TYPES)
    + ", max(CASE WHEN event_type = 'click' THEN value ELSE CAST(0 AS DOUBLE) END) AS top_click FROM events GROUP BY 1",
)
def _(spark, sf):
    """The value ``refund`` does not occur and yields 0."""
    counts = reshape.pivot_columns("event_type", TYPES, prefix="n_")
    top = reshape.pivot_columns("event_type", ["click"], agg="max", prefix="top_", then_value=F.col("value"), else_value=0.0)
    return table(spark, sf, "events").groupBy("user_id").agg(*counts, *top)


@query(
    "agg_10_column_values",
    "SELECT o_orderpriority AS value, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1 ORDER BY n DESC, value LIMIT 3",
)
def _(spark, sf):
    return values.column_values(table(spark, sf, "orders"), "o_orderpriority", max_records=3, where="o_orderstatus = 'F'")


@query(
    "agg_11_single_value",
    "SELECT event_type, count(*) AS n FROM events WHERE event_type = (SELECT event_type FROM events "
    "GROUP BY 1 ORDER BY count(*) DESC, event_type LIMIT 1) GROUP BY 1",
)
def _(spark, sf):
    """The most frequent type, fetched as a single value, then used as a literal."""
    e = table(spark, sf, "events")
    top = values.get_single_value(values.column_values(e, "event_type", max_records=1), default="none")
    return e.where(F.col("event_type") == F.lit(top)).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "agg_12_two_phase_pivot",
    "SELECT o_orderstatus, "
    + ", ".join(
        f"CAST(sum(CASE WHEN o_orderpriority = '{p}' THEN 1 ELSE 0 END) AS BIGINT) AS {n}"
        for p, n in [("1-URGENT", "_1_urgent"), ("2-HIGH", "_2_high"), ("3-MEDIUM", "_3_medium"),
                     ("4-NOT SPECIFIED", "_4_not_specified"), ("5-LOW", "_5_low")]
    )
    + " FROM orders GROUP BY 1",
)
def _(spark, sf):
    """Values fetched first (bounded), then one aggregate over the table."""
    orders = table(spark, sf, "orders")
    found = values.get_results_as_dict(values.column_values(orders, "o_orderpriority"))["value"]
    return orders.groupBy("o_orderstatus").agg(*reshape.pivot_columns("o_orderpriority", sorted(found), slug=True))


@query(
    "agg_13_difference_total",
    "WITH d AS (SELECT o_custkey, abs(sum(CASE WHEN o_orderstatus = 'F' THEN 1 END) - sum(CASE WHEN o_orderstatus = 'O' THEN 1 END)) AS diff "
    "FROM orders GROUP BY 1) SELECT CAST(sum(coalesce(diff, 0)) AS BIGINT) AS failures FROM d",
)
def _(spark, sf):
    from txnspark.operators.quality import sum_failures

    def n(status):
        return F.sum(F.when(F.col("o_orderstatus") == status, 1))

    return sum_failures(table(spark, sf, "orders").groupBy("o_custkey").agg(F.abs(n("F") - n("O")).alias("diff")), "diff")


@query(
    "agg_14_mean_stddev",
    "SELECT round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS std FROM orders",
)
def _(spark, sf):
    return table(spark, sf, "orders").agg(
        F.round(F.avg("o_totalprice"), 4).alias("mean"), F.round(F.stddev_samp("o_totalprice"), 4).alias("std")
    )


# --- windows -------------------------------------------------------------------------------------------------------


def _cents(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", "user_id", "ts", F.col("value").cast("decimal(18,2)").alias("value"))


@query(
    "win_01_count_rows",
    "SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS n "
    "FROM events",
)
def _(spark, sf):
    e = _cents(spark, sf)
    out = W.rolling_rows(e, ["user_id"], ["ts", "event_id"], "value", {"n": 1}, {}, W.stored_hot_keys(e, ["user_id"], 60))
    return out.select("event_id", "n")


@query(
    "win_02_avg_rows",
    """SELECT event_id, CAST(sum(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) / count(*) OVER w AS mean FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)""",
)
def _(spark, sf):
    e = _cents(spark, sf)
    out = W.rolling_rows(e, ["user_id"], ["ts", "event_id"], "value", {}, {"mean": 7}, W.stored_hot_keys(e, ["user_id"], 60))
    return out.select("event_id", "mean")


@query(
    "win_03_count_range",
    "SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS n "
    "FROM events",
)
def _(spark, sf):
    out = W.rolling_count(table(spark, sf, "events").select("event_id", "user_id", "ts"), ["user_id"], "ts", W.DAY, "n")
    return out.select("event_id", "n")


@query(
    "win_04_lag",
    "SELECT event_id, lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS previous FROM events",
)
def _(spark, sf):
    """Five types share all rows, so each holds a fifth; types above the bound are spread over slices of a day."""
    e = table(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    hot = W.stored_hot_keys(e, ["event_type"], 1000)
    return W.lag_by_slice(e, ["event_type"], ["ts", "event_id"], "value", "previous", hot, W.DAY).select("event_id", "previous")


@query(
    "win_05_lag_over_days",
    """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1)
    SELECT day, n, round((n - lag(n) OVER (ORDER BY day)) * CAST(100 AS DOUBLE) / lag(n) OVER (ORDER BY day), 2) AS change FROM d""",
)
def _(spark, sf):
    daily = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return W.previous_day_change(daily, "day", "n", "change")


@query(
    "win_06_lead",
    """SELECT user_id, ts, event_id, nxt AS next_id FROM (
      SELECT user_id, ts, event_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt FROM events)
    WHERE nxt IS NOT NULL""",
)
def _(spark, sf):
    """Successor inside a user, found in the global order (user, time, id): no user has to fit one task."""
    e = table(spark, sf, "events").select("user_id", "ts", "event_id")
    pairs = W.adjacent_pairs(e, ["user_id", "ts", "event_id"], lambda n: F.col("user_id") == n["user_id"])
    return pairs.select("user_id", "ts", "event_id", F.col("_next")["event_id"].alias("next_id"))


@query(
    "win_07_last_record",
    """SELECT o_custkey, o_orderdate, o_orderkey FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    return reshape.deduplicate(orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])


@query(
    "win_08_row_number",
    """SELECT l_orderkey, min(l_linenumber) AS l_linenumber FROM lineitem GROUP BY 1""",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return reshape.deduplicate(lines, ["l_orderkey"], ["l_linenumber"])


@query(
    "win_09_offsets",
    """WITH b AS (SELECT CAST(min(ts) AS DATE) AS lo, CAST(max(ts) AS DATE) AS hi FROM events)
    SELECT CAST(o AS BIGINT) AS day_offset, CAST(lo + CAST(o AS INTEGER) AS DATE) AS day
    FROM b, (SELECT unnest(range(0, (SELECT datediff('day', lo, hi) FROM b))) AS o)""",
)
def _(spark, sf):
    """Offsets from the first day, without numbering rows in a window."""
    b = table(spark, sf, "events").agg(F.to_date(F.min("ts")).alias("lo"), F.to_date(F.max("ts")).alias("hi"))
    days = b.select("lo", F.explode(generators.spine("day", F.col("lo"), F.col("hi"))).alias("day"))
    return days.select(F.date_diff("day", "lo").cast("bigint").alias("day_offset"), "day")


@query(
    "win_10_sequence_breaks",
    """SELECT user_id, day, previous_day FROM (
      SELECT user_id, day, lag(day) OVER (PARTITION BY user_id ORDER BY day) AS previous_day
      FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events))
    WHERE NOT (day = previous_day + 1)""",
)
def _(spark, sf):
    from txnspark.operators.quality import sequential_values

    days = table(spark, sf, "events").select("user_id", F.to_date("ts").alias("day")).distinct()
    return sequential_values(days, "day", 1, "day", ["user_id"])


# --- sorts ---------------------------------------------------------------------------------------------------------


@query(
    "sort_01_newest_days",
    "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1 ORDER BY day DESC LIMIT 7",
)
def _(spark, sf):
    daily = table(spark, sf, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return daily.orderBy(F.desc("day")).limit(7)


@query("sort_02_order_by_two", ctes(B.RAW_INDICATORS) + "SELECT indicator, date, value FROM raw_indicators ORDER BY 1, 2")
def _(spark, sf):
    return B.raw_indicators(spark, sf).select("indicator", "date", "value").orderBy("indicator", "date")


@query("sort_03_newest_first", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderdate").orderBy(F.desc("o_orderdate"))


@query(
    "sort_04_top_values",
    "SELECT l_partkey AS value, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, value LIMIT 10",
)
def _(spark, sf):
    return values.column_values(table(spark, sf, "lineitem"), "l_partkey", max_records=10)


@query("sort_06_schema_only", "SELECT * FROM orders LIMIT 0")
def _(spark, sf):
    return table(spark, sf, "orders").limit(0)


# --- set operations and reshaping ----------------------------------------------------------------------------------


@query("set_01_union_all", "SELECT c_custkey AS key, c_acctbal AS balance FROM customer UNION ALL SELECT s_suppkey, s_acctbal FROM supplier")
def _(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance"))
    return c.union(table(spark, sf, "supplier").select("s_suppkey", "s_acctbal"))


@query(
    "set_02_union_relations",
    """SELECT 'customer' AS source, CAST(c_custkey AS VARCHAR) AS id, c_acctbal AS balance, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS city
      FROM customer WHERE c_acctbal > 1000
    UNION ALL SELECT 'supplier', CAST(s_suppkey AS VARCHAR), s_acctbal, NULL, s_name FROM supplier WHERE s_acctbal > 1000""",
)
def _(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"),
        F.col("c_name").alias("note"),
    )
    s = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"), F.col("s_name").alias("city")
    )
    return reshape.union_relations(
        {"customer": c, "supplier": s}, exclude=["NOTE"], source_column_name="source", where="balance > 1000"
    )


@query(
    "set_03_except",
    "SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderstatus")
    done = orders.where(F.col("o_orderstatus") == "F").select("o_custkey")
    return done.subtract(orders.where(F.col("o_orderstatus") == "O").select("o_custkey"))


@query(
    "set_04_unpivot",
    """SELECT o_orderkey, 'o_orderstatus' AS prop, o_orderstatus AS val FROM orders
    UNION ALL SELECT o_orderkey, 'late', CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE CAST(o_custkey % 2 = 0 AS VARCHAR) END FROM orders
    UNION ALL SELECT o_orderkey, 'o_custkey', CAST(o_custkey AS VARCHAR) FROM orders""",
)
def _(spark, sf):
    late = F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey") % 2 == 0)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", late.alias("late"), "o_custkey", "o_totalprice")
    return reshape.unpivot(orders, "string", ["O_ORDERKEY"], ["o_totalprice"], "prop", "val")


# --- generators ----------------------------------------------------------------------------------------------------


@query(
    "gen_01_series",
    "SELECT n AS generated_number, o_totalprice FROM (SELECT unnest(range(1, (SELECT count(*) FROM orders) + 1)) AS n) "
    "LEFT JOIN orders ON o_orderkey = n",
)
def _(spark, sf):
    """1 .. number of orders, matched with the orders of that key."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    series = generators.generate_series(spark, values.get_single_value(orders.agg(F.count(F.lit(1)))))
    joined = series.join(orders, series.generated_number == orders.o_orderkey, "left")
    return joined.select("generated_number", "o_totalprice")


@query(
    "gen_02_date_spine",
    """WITH b AS (SELECT date_trunc('hour', min(ts)) AS lo, date_trunc('hour', max(ts)) + INTERVAL 1 HOUR AS hi FROM events),
    h AS (SELECT unnest(generate_series(lo, hi - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS date_hour FROM b),
    n AS (SELECT date_trunc('hour', ts) AS date_hour, count(*) AS n FROM events GROUP BY 1)
    SELECT date_hour, coalesce(n, 0) AS n FROM h LEFT JOIN n USING (date_hour)""",
)
def _(spark, sf):
    """Hours of the events' span, end excluded, with the number of events."""
    e = table(spark, sf, "events").select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("date_hour"))
    bounds = e.agg(F.min("date_hour").alias("lo"), (F.max("date_hour") + F.expr("INTERVAL 1 HOUR")).alias("hi"))
    n = e.groupBy("date_hour").agg(F.count(F.lit(1)).alias("n"))
    return generators.date_spine_over(bounds, "hour", "lo", "hi").join(n, "date_hour", "left").fillna(0, ["n"])


@query(
    "gen_03_intervals_between",
    """SELECT o_orderkey, date_diff('day', o_orderdate, d) AS days, date_diff('month', o_orderdate, d) AS months,
      date_diff('year', o_orderdate, d) AS years FROM orders, (SELECT max(l_shipdate) AS d FROM lineitem)""",
)
def _(spark, sf):
    from txnspark.functions import intervals_between

    orders = table(spark, sf, "orders")
    last = B.newest(table(spark, sf, "lineitem"), "l_shipdate")
    return orders.withColumn("d", last).select(
        "o_orderkey", *[intervals_between(p, "o_orderdate", "d").alias(f"{p}s") for p in ("day", "month", "year")]
    )
