"""Approximate nearest neighbours by locality-sensitive hashing, in linear work.

Every table of hashes turns the standardised features by random projections, quantises them, and interleaves the bits to
one number: rows that are near in space share leading bits and lie near each other in the order of that number. A row's
candidates are the ``reach`` rows before and after it in each table; the candidates of all tables are merged and the nearest
kept by true distance. Orders are cut into buckets between sampled bounds, ties spread by a hash of the key, so a dense
place is neither one task nor a group of all pairs.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnspark.operators.windows import bucket_of, sampled_bounds

TABLES = 8
REACH = 12
PROJECTIONS = 6  # per table; 60 bits are dealt to them


def spreads(df: DataFrame, features: Sequence[str]) -> dict[str, float | None]:
    """Sample deviation of each feature, None for a constant one."""
    row = df.agg(*[F.stddev_samp(c).alias(c) for c in features]).first()
    return {c: row[c] or None for c in features}


def _interleaved(cells: Sequence[Column], bits: int) -> Column:
    """Bits of the cells, the highest of each first."""
    out = F.lit(0).cast("bigint")
    for bit in range(bits):
        for j, cell in enumerate(cells):
            taken = F.shiftright(cell, bit).bitwiseAND(F.lit(1).cast("bigint"))
            out = out.bitwiseOR(F.shiftleft(taken, bit * len(cells) + len(cells) - 1 - j))
    return out


def nearest(
    df: DataFrame,
    features: Sequence[str],
    key: str,
    k: int,
    tables: int = TABLES,
    reach: int = REACH,
    seed: int = 42,
) -> DataFrame:
    """(key, near): up to ``k`` near rows of each row, nearest first, as structs (dist, key, x); ``x`` holds the features
    divided by their deviations (0 for constant ones), ``dist`` is the squared distance between these. Keys are unique."""
    deviation = spreads(df, features)
    x = F.array(*[F.col(c) / F.lit(deviation[c]) if deviation[c] else F.lit(0.0) for c in features])
    rng = random.Random(seed)
    n = min(PROJECTIONS, len(features))
    lines = [[[rng.gauss(0, 1) for _ in features] for _ in range(n)] for _ in range(tables)]

    def along(line: list[float]) -> Column:
        total = F.lit(0.0)
        for c, w in zip(features, line, strict=True):
            if deviation[c]:
                total = total + F.col(c) * F.lit(w / deviation[c])
        return total

    places = {f"_p{t}_{j}": along(line) for t, table in enumerate(lines) for j, line in enumerate(table)}
    placed = df.select(F.col(key).alias("key"), x.alias("x"), *[c.alias(name) for name, c in places.items()])
    ends = placed.agg(*[f(c).alias(f"{c}_{f.__name__}") for c in places for f in (F.min, F.max)]).first()
    bits = 60 // n
    hashes = []
    for t in range(tables):
        cells = []
        for j in range(n):
            name = f"_p{t}_{j}"
            low, high = ends[f"{name}_min"], ends[f"{name}_max"]
            width = (high - low) if low is not None and high > low else 1.0
            scaled = (F.col(name) - F.lit(low)) / F.lit(width) * F.lit(float((1 << bits) - 1))
            cells.append(F.floor(scaled).cast("bigint"))
        hashes.append(F.struct(F.lit(t).alias("table"), F.array(*cells).alias("cells")))
    entries = placed.select("key", "x", F.explode(F.array(*hashes)).alias("h")).select("key", "x", "h.*")
    entries = entries.withColumn("hash", _interleaved([F.col("cells")[j] for j in range(n)], bits)).drop("cells")
    order = ["table", "hash", "tie"]
    entries = entries.withColumn("tie", F.xxhash64("key", F.lit(seed)))
    buckets = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds, _ = sampled_bounds(entries, order, buckets)
    entries = entries.withColumn("_bucket", bucket_of(F.struct(*order), bounds, buckets))
    frame = Window.partitionBy("_bucket", "table").orderBy("hash", "tie").rowsBetween(-reach, reach)
    met = entries.select("key", "x", F.collect_list(F.struct("key", "x")).over(frame).alias("met"))

    def distance(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, d: s + d)

    others = F.filter("met", lambda m: m["key"] != F.col("key"))
    judged = F.transform(others, lambda m: F.struct(distance(F.col("x"), m["x"]).alias("dist"), m["key"].alias("key"), m["x"].alias("x")))
    best = met.select("key", F.slice(F.array_sort(judged), 1, k).alias("best"))
    merged = best.groupBy("key").agg(F.flatten(F.collect_list("best")).alias("best"))
    near = F.slice(F.array_sort(F.array_distinct("best")), 1, k)
    return merged.select(F.col("key").alias(key), near.alias("near"))
