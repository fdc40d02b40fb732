"""Mixing sources to target weights along a time-varying curriculum.

A mix takes as many words as all sources hold. Source s gets target_s of them: its share by weight, at most three times
its own size, the excess shared out again by weight. Its schedule is a shape over training time 0..1 with mean 1
(straight between 0 and 1), so its demand up to time t is target_s times the integral of the shape. Its documents stand
in the order of a hash, one epoch after another; a copy is taken if its middle word lies before target_s, and its
training position is the time at which the demand reaches that word: the inverse of the integral. Sorting by
position (a range partitioning) gives the training order.

Running sums over a source are taken in two levels, words per hash bucket and then inside each bucket, with buckets cut so
that one holds about ``BUCKET_ROWS`` documents; a source with a third of all rows spreads over as many tasks as it needs.

Defined results: NULL and empty texts have size 0 and are never taken; NULL is a source of its own, the last; a table
without rows gives none, one without words takes nothing; repeated rows are documents of their own (equal in hash and
size, so their order does not matter); other columns pass through ``mix`` and may not be lost to clashing names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnspark.llm.common import free_name, stored, words

CAP = 3
BUCKET_ROWS = 50_000
# Slope of a source's shape by its weight: light sources fade out, heavy ones come in. In (-1, 1).
SLOPES = {1: -0.5, 2: 0.0, 3: 0.5}


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def targets(sized: DataFrame) -> DataFrame:
    """(source, source_size, weight, target) from rows of (source, size): one row per source, as named by whoever sets weights.

    With sources in order of cap per weight, those up to some point are capped and the rest share what is left by weight;
    that point is where handing out excess again and again ends. The tests are made on whole numbers.
    """
    per_source = stored(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = per_source.withColumn("weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("bigint"))
    everything = Window.partitionBy(F.lit(0))
    tightest = everything.orderBy((F.col("cap") / F.col("weight")), F.col("source").asc_nulls_last())
    d = lambda c: F.col(c).cast("decimal(38,0)")
    shares = (
        ranked.withColumn("cap", CAP * F.col("source_size"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("before", F.coalesce(F.sum("cap").over(tightest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("open_weight", F.sum("weight").over(tightest.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("left", F.col("total") - F.col("before"))
        .withColumn("capped", d("cap") * F.col("open_weight").cast("decimal(18,0)") <= d("left") * F.col("weight").cast("decimal(18,0)"))
    )
    # The first open source in that order fixes the words per weight of all open ones.
    open_row = F.when(~F.col("capped"), F.struct("left", "open_weight"))
    rate = F.max_by(open_row, F.when(~F.col("capped"), F.col("open_weight"))).over(everything)
    return shares.withColumn("rate", rate).select(
        "source", "source_size", "weight",
        F.when(F.col("capped"), F.col("cap").cast("double"))
        .otherwise(F.col("rate.left").cast("double") / F.col("rate.open_weight") * F.col("weight")).alias("target"),
    )


def order_key(key: Column) -> Column:
    return F.md5(F.coalesce(key.cast("string"), F.lit("")))


def schedule(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of (key, source, size) to the same rows plus source_size, weight, target, copies and before: the words of the
    source that stand before the document within an epoch."""
    goals = stored(targets(docs), "targets")
    rows = docs.count()
    buckets = max(1, 2 ** math.ceil(math.log2(max(1, rows / BUCKET_ROWS))))
    hashed = docs.withColumn("_h", order_key(F.col(key)))
    # The first eight hex digits as a number; its top bits are the bucket.
    bucketed = hashed.withColumn("_b", F.floor(F.conv(F.substring("_h", 1, 8), 16, 10).cast("bigint") * buckets / 2**32).cast("bigint"))
    bucketed = bucketed.withColumn("_s", F.col("source").isNull()).withColumn("_n", F.coalesce("source", F.lit("")))
    place = ["_s", "_n", "_b"]
    sums = bucketed.groupBy(*place).agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("_s", "_n").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*place, F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("_o"))
    goals = goals.select(F.col("source").isNull().alias("_s"), F.coalesce("source", F.lit("")).alias("_n"), "source_size", "weight", "target")
    starts = stored(offsets.join(goals, ["_s", "_n"]), "bucket-starts")
    inside = Window.partitionBy(*place).orderBy("_h", F.col(key), "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = bucketed.join(starts, place).withColumn("before", F.col("_o") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    # Epochs e with e * source_size + before + size / 2 < target.
    room = (F.col("target") - F.col("before") - F.col("size") / 2) / F.col("source_size")
    copies = F.when(F.col("size") > 0, F.greatest(F.ceil(room), F.lit(0))).otherwise(F.lit(0)).cast("bigint")
    return placed.withColumn("copies", F.least(copies, F.lit(CAP))).drop("_h", "_b", "_s", "_n", "_o")


def position(share: Column, weight: Column) -> Column:
    """Time at which a source has given ``share`` of its target: with slope b the shape is 1 - b + 2 b t, its integral
    (1 - b) t + b t^2, and this is the inverse of that."""
    out = share
    for w, b in SLOPES.items():
        if b:
            out = F.when(weight == w, (F.sqrt((1 - b) ** 2 + 4 * b * share) - (1 - b)) / (2 * b)).otherwise(out)
    return out


def middle(copy: Column) -> Column:
    """Share of the target at the middle word of a copy."""
    return (copy * F.col("source_size") + F.col("before") + F.col("size") / 2) / F.col("target")


def plan(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Per document: key, size, source_size, target, taken (words, repeats counted) and first_position (of its first copy)."""
    sized = stored(docs.select(F.col(key).alias(key), F.col(source).alias("source"), n_words(F.col(text)).alias("size")), "sizes")
    first = F.when(F.col("copies") > 0, F.round(position(middle(F.lit(0)), F.col("weight")), 9))
    return schedule(sized, key).select(
        key, "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), first.alias("first_position")
    )


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The training sequence: the columns of ``docs`` once per copy taken, plus ``copy`` and ``position``, sorted by position.

    Rows meet their copies by a hash of the whole row; equal rows share out the copies of their group among themselves.
    """
    names = {n: free_name(docs, n) for n in ("copy", "position")}
    whole = [F.xxhash64(F.lit(seed), *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in docs.columns]) for seed in (1, 2)]
    sized = stored(
        docs.select(F.col(key).alias(key), F.col(source).alias("source"), n_words(F.col(text)).alias("size"), whole[0].alias("i1"), whole[1].alias("i2")),
        "sizes",
    )
    copies = schedule(sized, key).select(
        "i1", "i2",
        F.transform(
            F.when(F.col("copies") > 0, F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)),
            lambda c: F.struct(position(middle(c), F.col("weight")).alias("position"), c.alias("copy")),
        ).alias("times"),
        "copies",
    )
    ids = ["i1", "i2"]
    times = F.array_sort(F.flatten(F.collect_list(F.when(F.col("copies") > 0, F.col("times")))))
    timed = stored(copies.groupBy(*ids).agg(times.alias("times"), F.count("*").alias("rows")), "positions").where(F.size("times") > 0)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), whole[0].alias("i1"), whole[1].alias("i2"))
    nth = F.row_number().over(Window.partitionBy(*ids).orderBy(*ids)) - 1
    shared = rows.join(timed, ids).withColumn("nth", nth)
    mine = F.filter("times", lambda t, i: i % F.col("rows") == F.col("nth"))
    return (
        shared.select("row", F.explode(mine).alias("time"))
        .select("row.*", F.col("time.copy").alias(names["copy"]), F.col("time.position").alias(names["position"]))
        .orderBy(names["position"], key, names["copy"])
    )
