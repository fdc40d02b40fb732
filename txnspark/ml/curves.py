"""Exact precision-recall curve of any number of scores (ML-07)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnspark.operators.windows import bucket_of, sampled_bounds


def precision_recall_curve(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(threshold, true_positives, predicted, precision, recall) per distinct score, all rows of at least that score being
    predicted positive. NULL scores are never predicted but count as missed.

    Equal scores are one row. The order is cut into buckets between sampled bounds; a window adds up inside a bucket,
    and the totals of the buckets, one row each, are added up before them.
    """
    rows = scored.select(F.col(score).cast("double").alias("threshold"), (F.col(label) == 1).cast("bigint").alias("hit"))
    total = rows.agg(F.coalesce(F.sum("hit"), F.lit(0))).scalar()
    counted = rows.where("threshold IS NOT NULL").groupBy("threshold").agg(F.coalesce(F.sum("hit"), F.lit(0)).alias("hits"), F.count("*").alias("n"))
    buckets = 2 * int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds, _ = sampled_bounds(rows.where("threshold IS NOT NULL"), ["threshold"], buckets)
    placed = counted.withColumn("_bucket", bucket_of(F.struct("threshold"), bounds, buckets))
    totals = placed.groupBy("_bucket").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n"))
    above = Window.orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        F.col("_bucket").alias("_at"), *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in ("hits", "n")]
    )
    within = Window.partitionBy("_bucket").orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    running = placed.select("_bucket", "threshold", *[F.sum(c).over(within).alias(c) for c in ("hits", "n")])
    joined = running.join(F.broadcast(before), F.col("_bucket") == F.col("_at"))
    hits, n = F.col("hits") + F.col("hits_above"), F.col("n") + F.col("n_above")
    return joined.select(
        "threshold", "_bucket", hits.alias("true_positives"), n.alias("predicted"), (hits / n).alias("precision"), F.try_divide(hits, total).alias("recall")
    )


def area(curve: DataFrame) -> DataFrame:
    """One row ``pr_auc``: area under the curve by trapezoids, from recall 0 with precision 1 on.

    The area is a sum over neighbours: inside a bucket by a window, between buckets by their first and last points.
    """
    point = F.struct("threshold", "recall", "precision")
    w = Window.partitionBy("_bucket").orderBy(F.desc("threshold"))
    step = curve.select("_bucket", "threshold", "recall", "precision", F.lag(point).over(w).alias("_p"))
    inside = step.groupBy("_bucket").agg(
        F.sum((F.col("recall") - F.col("_p.recall")) * (F.col("precision") + F.col("_p.precision")) / 2).alias("inside"),
        F.max(point).alias("first"),
        F.min(point).alias("last"),
    )
    last = F.lag("last").over(Window.orderBy(F.desc("_bucket")))
    edges = inside.select(F.coalesce("inside", F.lit(0.0)).alias("inside"), "first", last.alias("_l"))
    between = (F.col("first.recall") - F.coalesce("_l.recall", F.lit(0.0))) * (F.col("first.precision") + F.coalesce("_l.precision", F.lit(1.0))) / 2
    return edges.agg(F.sum(F.col("inside") + between).alias("pr_auc"))
