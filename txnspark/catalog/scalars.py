"""Scalar functions over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from txnspark import bindings as B
from txnspark import functions as X
from txnspark.catalog.registry import query

table = B.table


@query(
    "fn_01_json_scalar",
    "SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS missing, "
    "'[' || event_type || '] Shop' AS bracketed, CAST(NULL AS VARCHAR) AS nested FROM events",
)
def _(spark, sf):
    """Text that starts with a bracket is a scalar, an object is not."""
    wrapped = F.concat(F.lit('{"t":"['), "event_type", F.lit('] Shop","o":'), "props", F.lit("}"))
    return table(spark, sf, "events").select(
        "event_id",
        X.json_scalar("props", "$.k").alias("k"),
        X.json_scalar("props", "$.none").alias("missing"),
        X.json_scalar(wrapped, "$.t").alias("bracketed"),
        X.json_scalar(wrapped, "$.o").alias("nested"),
    )


@query(
    "fn_02_casts",
    """SELECT event_id, CAST(user_id AS VARCHAR) AS user_text, CAST(CAST(value AS DECIMAL(38,9)) AS DOUBLE) AS amount,
      CAST(ts AS DATE) AS day, CAST(CAST(event_id AS VARCHAR) AS BIGINT) AS id_again, CAST(event_id AS DOUBLE) AS id_double,
      CAST(ts AS TIMESTAMP) AS ts_again FROM events""",
)
def _(spark, sf):
    ts = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").cast("timestamp")
    return table(spark, sf, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("user_text"),
        F.col("value").cast(B.NUMERIC).alias("amount"),
        F.to_date("ts").alias("day"),
        F.col("event_id").cast("string").cast("bigint").alias("id_again"),
        F.col("event_id").cast("double").alias("id_double"),
        ts.alias("ts_again"),
    )


@query(
    "fn_03_safe_cast",
    "SELECT o_orderkey, TRY_CAST(left(o_orderpriority, 1) AS INTEGER) AS rank, TRY_CAST(o_orderpriority AS INTEGER) AS none FROM orders",
)
def _(spark, sf):
    p = F.col("o_orderpriority")
    return table(spark, sf, "orders").select(
        "o_orderkey", F.left(p, F.lit(1)).try_cast("int").alias("rank"), p.try_cast("int").alias("none")
    )


@query(
    "fn_04_05_06_predicates",
    """SELECT p_partkey, regexp_matches(p_brand, '#[12]') AS has_low_brand, p_size BETWEEN 5 AND 20 AS mid_size,
      p_type IN ('SMALL', 'ECONOMY') AS in_types, NOT p_size > 25 AS small, p_name LIKE '%ring' AS like_ring,
      p_name ILIKE 'RED %' AS ilike_red FROM part""",
)
def _(spark, sf):
    size, name = F.col("p_size"), F.col("p_name")
    return table(spark, sf, "part").select(
        "p_partkey",
        F.col("p_brand").rlike("#[12]").alias("has_low_brand"),
        size.between(5, 20).alias("mid_size"),
        F.col("p_type").isin("SMALL", "ECONOMY").alias("in_types"),
        (~(size > 25)).alias("small"),
        name.like("%ring").alias("like_ring"),
        name.ilike("RED %").alias("ilike_red"),
    )


@query(
    "fn_07_08_conditionals",
    """SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'big' WHEN o_totalprice > 100000 THEN 'mid' ELSE 'small' END AS band,
      CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS status,
      nullif(o_orderstatus, 'P') AS no_p, coalesce(nullif(o_orderstatus, 'P'), 'pending') AS filled FROM orders""",
)
def _(spark, sf):
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    no_p = F.nullif(status, F.lit("P"))
    names = F.create_map(F.lit("F"), F.lit("finished"), F.lit("O"), F.lit("open"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(price > 300000, "big").when(price > 100000, "mid").otherwise("small").alias("band"),
        F.try_element_at(names, status).alias("status"),
        no_p.alias("no_p"),
        F.coalesce(no_p, F.lit("pending")).alias("filled"),
    )


@query(
    "fn_09_to_12_strings",
    """SELECT p_partkey, p_brand || ' ' || p_type AS label, p_brand || nullif(p_type, 'SMALL') AS nullable_label,
      trim('  ' || p_name || ' ') AS trimmed, lower(p_type) AS lowered, replace(p_name, 'ring', 'RING') AS replaced,
      split_part(p_name, ' ', 2) AS second, split_part(p_name, ' ', 9) AS ninth, CAST(position('#' IN p_brand) AS INTEGER) AS hash_at,
      right(p_name, 3) AS tail, CAST(length(p_name) AS INTEGER) AS n_chars FROM part""",
)
def _(spark, sf):
    name, brand, kind = F.col("p_name"), F.col("p_brand"), F.col("p_type")
    return table(spark, sf, "part").select(
        "p_partkey",
        F.concat(brand, F.lit(" "), kind).alias("label"),
        F.concat(brand, F.nullif(kind, F.lit("SMALL"))).alias("nullable_label"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.lower(kind).alias("lowered"),
        F.replace(name, F.lit("ring"), F.lit("RING")).alias("replaced"),
        F.split_part(name, F.lit(" "), F.lit(2)).alias("second"),
        F.split_part(name, F.lit(" "), F.lit(9)).alias("ninth"),
        F.locate("#", brand).alias("hash_at"),
        F.right(name, F.lit(3)).alias("tail"),
        F.length(name).alias("n_chars"),
    )


BARE = "replace(replace(url, 'http://', ''), 'https://', '')"


@query(
    "fn_13_14_15_urls",
    f"""SELECT page_id, split_part(split_part(replace(replace(replace(url, 'android-app://', ''), 'http://', ''), 'https://', ''), '/', 1), '?', 1) AS host,
      CASE WHEN position('/' IN {BARE}) > 0 THEN split_part(substr({BARE}, position('/' IN {BARE}) + 1), '?', 1)
           WHEN position('?' IN {BARE}) > 0 THEN '' ELSE {BARE} END AS path,
      nullif(split_part(split_part(url, 'utm_source=', 2), '&', 1), '') AS source,
      nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') AS page FROM pages""",
)
def _(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id",
        X.url_host("url").alias("host"),
        X.url_path("url").alias("path"),
        X.url_parameter("url", "utm_source").alias("source"),
        X.url_parameter("url", "page").alias("page"),
    )


@query(
    "fn_16_surrogate_key",
    """SELECT o_orderkey, md5(coalesce(CAST(o_orderkey AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-' ||
        coalesce(nullif(o_orderstatus, 'P'), '_dbt_utils_surrogate_key_null_')) AS sk,
      md5(coalesce(nullif(o_orderstatus, 'P'), '') || '-' || o_orderpriority) AS sk_empty FROM orders""",
)
def _(spark, sf):
    status = F.nullif("o_orderstatus", F.lit("P"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        X.surrogate_key("o_orderkey", status).alias("sk"),
        X.surrogate_key(status, "o_orderpriority", empty_for_null=True).alias("sk_empty"),
    )


@query(
    "fn_17_18_safe_arithmetic",
    """SELECT event_id, coalesce(nullif(user_id, 3), 0) + coalesce(event_id, 0) + coalesce(CAST(NULL AS BIGINT), 0) AS total,
      value / nullif(CAST(user_id % 5 AS DOUBLE), 0) AS ratio FROM events""",
)
def _(spark, sf):
    missing = F.lit(None).cast("bigint")
    return table(spark, sf, "events").select(
        "event_id",
        X.safe_add(F.nullif("user_id", F.lit(3)), "event_id", missing).alias("total"),
        X.safe_divide("value", (F.col("user_id") % 5).cast("double")).alias("ratio"),
    )


@query(
    "fn_19_width_bucket",
    """SELECT o_orderkey, CAST(CASE WHEN o_totalprice < 50000 THEN 0 WHEN o_totalprice >= 450000 THEN 9
      ELSE floor((o_totalprice - 50000) * 8 / 400000) + 1 END AS BIGINT) AS bucket FROM orders""",
)
def _(spark, sf):
    bucket = X.width_bucket("o_totalprice", F.lit(50000), F.lit(450000), 8)
    return table(spark, sf, "orders").select("o_orderkey", bucket.alias("bucket"))


ANGLE = """asin(sqrt(pow(sin(radians(merchant_latitude - latitude) / 2), 2) + cos(radians(latitude))
  * cos(radians(merchant_latitude)) * pow(sin(radians(merchant_longitude - longitude) / 2), 2)))"""


@query(
    "fn_20_haversine",
    f"""WITH {B.RAW_TRANSACTIONS}, {B.RAW_USERS}, {B.MERCHANTS}
    SELECT t.id, round(2 * 3961 * {ANGLE}, 2) AS miles, round(2 * 3961 * {ANGLE} * CAST(1.60934 AS DOUBLE), 2) AS km,
      round(2 * CAST(6371010 AS DOUBLE) * {ANGLE}) AS metres
    FROM raw_transactions t JOIN raw_users u ON t.client_id = u.id JOIN merchants m ON t.merchant_id = m.merchant_id""",
)
def _(spark, sf):
    t = B.raw_transactions(spark, sf).select("id", "client_id", "merchant_id")
    u = B.raw_users(spark, sf).select(F.col("id").alias("client_id"), "latitude", "longitude")
    joined = t.join(u, "client_id").join(B.merchants(spark, sf), "merchant_id")
    points = ("latitude", "longitude", "merchant_latitude", "merchant_longitude")
    return joined.select(
        "id",
        F.round(X.haversine_distance(*points), 2).alias("miles"),
        F.round(X.haversine_distance(*points, unit="km"), 2).alias("km"),
        F.round(X.point_distance_m(*points)).alias("metres"),
    )


@query(
    "fn_21_math",
    """SELECT o_orderkey, round(sqrt(o_totalprice), 6) AS root, round(pow(o_totalprice, CAST(0.25 AS DOUBLE)), 6) AS fourth_root,
      round(sin(radians(CAST(o_orderkey % 80 AS DOUBLE))), 9) AS s, round(cos(radians(CAST(o_orderkey % 80 AS DOUBLE))), 9) AS c,
      round(asin(CAST(o_orderkey % 100 AS DOUBLE) / 100), 9) AS inv_s, round(acos(CAST(o_orderkey % 100 AS DOUBLE) / 100), 9) AS inv_c,
      CAST(ceil(o_totalprice) AS BIGINT) AS up, least(o_orderkey, o_custkey) AS low, o_orderkey % 7 AS rest,
      abs(o_custkey - o_orderkey) AS gap, round(o_totalprice / 8, 1) AS eighth FROM orders""",
)
def _(spark, sf):
    price, key = F.col("o_totalprice"), F.col("o_orderkey")
    angle = F.radians((key % 80).cast("double"))
    unit = (key % 100).cast("double") / 100
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.round(F.sqrt(price), 6).alias("root"),
        F.round(F.pow(price, F.lit(0.25)), 6).alias("fourth_root"),
        F.round(F.sin(angle), 9).alias("s"),
        F.round(F.cos(angle), 9).alias("c"),
        F.round(F.asin(unit), 9).alias("inv_s"),
        F.round(F.acos(unit), 9).alias("inv_c"),
        F.ceil(price).alias("up"),
        F.least("o_orderkey", "o_custkey").alias("low"),
        (key % 7).alias("rest"),
        F.abs(F.col("o_custkey") - key).alias("gap"),
        F.round(price / 8, 1).alias("eighth"),
    )


@query(
    "fn_22_23_24_date_parts",
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS y, CAST(month(ts) AS INTEGER) AS m, CAST(day(ts) AS INTEGER) AS d,
      CAST(quarter(ts) AS INTEGER) AS q, CAST(dayofweek(ts) + 1 AS INTEGER) AS dow, CAST(dayofyear(ts) AS INTEGER) AS doy,
      CAST(hour(ts) AS INTEGER) AS h, monthname(ts) AS month_name, dayname(ts) AS day_name, CAST(ts AS DATE) AS day FROM events""",
)
def _(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        F.year("ts").alias("y"),
        F.month("ts").alias("m"),
        F.dayofmonth("ts").alias("d"),
        F.quarter("ts").alias("q"),
        F.dayofweek("ts").alias("dow"),
        F.dayofyear("ts").alias("doy"),
        F.hour("ts").alias("h"),
        F.date_format("ts", "MMMM").alias("month_name"),
        F.date_format("ts", "EEEE").alias("day_name"),
        F.to_date("ts").alias("day"),
    )


@query(
    "fn_25_local_wall_clock",
    "SELECT o_orderkey, CAST((o_orderdate AT TIME ZONE 'UTC') AT TIME ZONE 'Africa/Cairo' AS TIMESTAMP) AS cairo FROM orders",
)
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", X.local_wall_clock("o_orderdate", "Africa/Cairo").alias("cairo"))


@query(
    "fn_26_27_date_arithmetic",
    """SELECT o_orderkey, date_sub('month', o_orderdate, TIMESTAMP '2001-08-15 00:00:00') AS whole_months,
      CAST(o_orderdate - INTERVAL 30 DAY AS DATE) AS month_ago, o_orderdate + INTERVAL 36 HOUR AS later,
      CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month_start,
      CAST(date_diff('day', o_orderdate, TIMESTAMP '2001-08-15 00:00:00') AS INTEGER) AS days FROM orders""",
)
def _(spark, sf):
    end = F.lit("2001-08-15").cast("timestamp_ntz")
    day = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        X.months_between_whole(day, end).alias("whole_months"),
        F.date_sub(day.cast("date"), 30).alias("month_ago"),
        X.add_interval("hour", 36, day).alias("later"),
        F.date_trunc("month", day).alias("month_start"),
        F.date_diff(end.cast("date"), day.cast("date")).alias("days"),
    )


@query(
    "fn_28_29_as_of_and_make_date",
    """SELECT c_custkey, CAST(make_date(CAST(1983 - c_custkey % 60 AS INTEGER), CAST(1 + c_custkey % 12 AS INTEGER), 1) AS TIMESTAMP) AS birth_date,
      date_sub('year', CAST(make_date(CAST(1983 - c_custkey % 60 AS INTEGER), CAST(1 + c_custkey % 12 AS INTEGER), 1) AS TIMESTAMP),
        (SELECT max(o_orderdate) FROM orders)) AS age FROM customer""",
)
def _(spark, sf):
    """Ages on the newest order date: "now" is always a parameter."""
    now = B.newest(table(spark, sf, "orders"), "o_orderdate")
    k = F.col("c_custkey")
    born = F.make_date((1983 - k % 60).cast("int"), (1 + k % 12).cast("int"), F.lit(1)).cast("timestamp_ntz")
    people = table(spark, sf, "customer").select("c_custkey", born.alias("birth_date"))
    return people.select("c_custkey", "birth_date", F.timestamp_diff("YEAR", "birth_date", now).alias("age"))


@query(
    "fn_30_iso_utc",
    "SELECT event_id, strftime(make_timestamp((1700000000 + event_id * 60) * 1000000), '%Y-%m-%dT%H:%M:%S+00:00') AS iso FROM events",
)
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", X.iso_utc(1700000000 + F.col("event_id") * 60).alias("iso"))


@query(
    "fn_31_slug_aliases",
    "SELECT c_nationkey, CAST(sum(CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 1 ELSE 0 END) AS BIGINT) AS seg_automobile, "
    "CAST(sum(CASE WHEN c_mktsegment = '1st Class-X!' THEN 1 ELSE 0 END) AS BIGINT) AS seg__1st_class_x FROM customer GROUP BY 1",
)
def _(spark, sf):
    from txnspark.operators.reshape import pivot_columns

    cells = pivot_columns("c_mktsegment", ["AUTOMOBILE", "1st Class-X!"], prefix="seg_", slug=True)
    return table(spark, sf, "customer").groupBy("c_nationkey").agg(*cells)
