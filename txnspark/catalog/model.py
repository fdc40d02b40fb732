"""Fraud model over the test tables."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnspark import bindings as B
from txnspark.catalog import marts
from txnspark.catalog.registry import query
from txnspark.ml import balance, curves, fraud
from txnspark.plans import cards
from txnspark.session import scratch_path
from txnspark.sources.tables import stored

DAYS = 90


def recent_features(spark, sf):
    orders = B.table(spark, sf, "orders")
    return fraud.training_set(cards.ml_features(marts.analysis(spark, sf)), B.newest(orders, "o_orderdate"), DAYS)


def balanced_source(spark, sf):
    """Cheap features straight from the orders, for the balancing operators."""
    o = B.table(spark, sf, "orders")
    return o.select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_totalprice").alias("amount"),
        (F.col("o_custkey") % 60).cast("double").alias("current_age"),
        (F.col("o_orderpriority") == "1-URGENT").cast("double").alias("label"),
    )


RECENT = "SELECT * FROM analysis WHERE transaction_date >= (SELECT CAST(max(o_orderdate) AS DATE) - 90 FROM orders)"


@query(
    "ml_01_training_set",
    marts.FACTS
    + "SELECT transaction_id, transaction_date, amount, use_chip, has_chip, credit_limit, current_age, "
    "round(distance_to_merchant) AS distance_to_merchant, transaction_hour, transaction_day_of_week, unemployment_rate, "
    f"unemployment_change_rate, is_fraud FROM ({RECENT})",
)
def _(spark, sf):
    return recent_features(spark, sf).withColumn("distance_to_merchant", F.round("distance_to_merchant"))


@query(
    "ml_02_scaled_features",
    """WITH t AS (SELECT o_orderkey AS transaction_id, o_totalprice AS amount, CAST(o_custkey % 60 AS DOUBLE) AS current_age FROM orders),
    s AS (SELECT avg(amount) AS m1, stddev_samp(amount) AS s1, avg(current_age) AS m2, stddev_samp(current_age) AS s2 FROM t)
    SELECT transaction_id, round((amount - m1) / s1, 6) AS amount, round((current_age - m2) / s2, 6) AS current_age FROM t, s""",
)
def _(spark, sf):
    source = balanced_source(spark, sf).select("transaction_id", "amount", "current_age")
    scaled = fraud.z_scores(source, ["amount", "current_age"])
    return scaled.select("transaction_id", F.round("amount", 6).alias("amount"), F.round("current_age", 6).alias("current_age"))


@query(
    "ml_03_class_weights",
    """WITH t AS (SELECT o_orderkey AS transaction_id, o_orderpriority = '1-URGENT' AS f FROM orders),
    c AS (SELECT CAST(count(*) AS DOUBLE) AS n, count(*) FILTER (f) AS p FROM t)
    SELECT transaction_id, n / (CAST(2 AS DOUBLE) * (CASE WHEN f THEN p ELSE n - p END)) AS balanced_weight,
      CASE WHEN f THEN CAST(10 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS positive_weight FROM t, c""",
)
def _(spark, sf):
    return fraud.with_weights(balanced_source(spark, sf)).select("transaction_id", "balanced_weight", "positive_weight")


@query(
    "ml_03_smote_counts",
    """SELECT label, synthetic, n FROM (
      SELECT CAST(0 AS DOUBLE) AS label, false AS synthetic, count(*) AS n FROM orders WHERE o_orderpriority <> '1-URGENT'
      UNION ALL SELECT CAST(1 AS DOUBLE), false, count(*) FROM orders WHERE o_orderpriority = '1-URGENT'
      UNION ALL SELECT CAST(1 AS DOUBLE), true, count(*) FILTER (o_orderpriority <> '1-URGENT') - count(*) FILTER (o_orderpriority = '1-URGENT') FROM orders)""",
)
def _(spark, sf):
    """Synthetic positives bring both classes to the same number of rows."""
    grown = fraud.smote(balanced_source(spark, sf), ["amount", "current_age"])
    return grown.groupBy("label", "synthetic").agg(F.count(F.lit(1)).alias("n"))


def assembled(df, features):
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(df)


@query(
    "ml_04_candidates",
    """WITH t AS (SELECT o_orderpriority = '1-URGENT' AS f FROM orders),
    c AS (SELECT count(*) AS n, count(*) FILTER (f) AS p FROM t)
    SELECT 'rf' AS candidate, 'balanced' AS strategy, n, p AS positives, CAST(n AS DOUBLE) AS weight FROM c
    UNION ALL SELECT 'gb', 'smote', 2 * (n - p), n - p, CAST(2 * (n - p) AS DOUBLE) FROM c
    UNION ALL SELECT 'weighted_gb', 'positive', n, p, CAST(n + 9 * p AS DOUBLE) FROM c""",
)
def _(spark, sf):
    """What each candidate is fitted on: its balancing of the same rows."""
    data = assembled(balanced_source(spark, sf), ["amount", "current_age"])
    out = []
    for name, estimator in fraud.candidates().items():
        rows = balance.balance(data, estimator.strategy)
        weight = F.col("weight") if "weight" in rows.columns else F.lit(1.0)
        out.append(rows.agg(
            F.lit(name).alias("candidate"), F.lit(estimator.strategy).alias("strategy"), F.count("*").alias("n"),
            F.count_if(F.col("label") == 1).alias("positives"), F.round(F.sum(weight), 6).alias("weight"),
        ))
    return reduce(DataFrame.unionByName, out)


@query(
    "ml_05_folds",
    """WITH t AS (SELECT o_orderkey, o_orderpriority = '1-URGENT' AS f,
      CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 5 AS fold FROM orders),
    k AS (SELECT CAST(unnest(range(5)) AS INTEGER) AS fold),
    c AS (SELECT k.fold, count(*) FILTER (t.fold = k.fold) AS held_out, count(*) FILTER (t.fold = k.fold AND f) AS held_out_positives,
      count(*) FILTER (t.fold <> k.fold) AS training, count(*) FILTER (t.fold <> k.fold AND f) AS positives FROM k, t GROUP BY 1)
    SELECT fold, held_out, held_out_positives, training, round(training / CAST(2 * positives AS DOUBLE), 9) AS positive_weight,
      2 * (training - positives) AS oversampled FROM c""",
)
def _(spark, sf):
    """Per fold: the rows held out, as they are, and the balanced training rows, by weights and by synthetic rows."""
    data = fraud.with_folds(assembled(balanced_source(spark, sf), ["amount", "current_age"]))
    out = []
    for fold in range(fraud.FOLDS):
        held_out, training = data.where(F.col("fold") == fold), data.where(F.col("fold") != fold)
        weighted, grown = balance.balance(training, "balanced"), balance.balance(training, "smote")
        sizes = held_out.agg(F.lit(fold).alias("fold"), F.count("*").alias("held_out"), F.count_if(F.col("label") == 1).alias("held_out_positives"))
        weight = F.round(F.max(F.when(F.col("label") == 1, F.col("weight"))), 9).alias("positive_weight")
        sizes = sizes.crossJoin(weighted.agg(F.count("*").alias("training"), weight))
        out.append(sizes.crossJoin(grown.agg(F.count("*").alias("oversampled"))))
    return reduce(DataFrame.unionByName, out)


@query(
    "ml_06_feature_importances",
    """SELECT feature, rank, decides FROM (SELECT count(*) AS n FROM orders) o,
    (VALUES ('amount', 1, true), ('current_age', 2, false)) f(feature, rank, decides) WHERE n > 0""",
)
def _(spark, sf):
    """The full forest on a label that one feature decides: that feature has nearly all importance."""
    data = balanced_source(spark, sf).withColumn("label", (F.col("amount") > 150000).cast("double"))
    model = fraud.fit(data, fraud.candidates()["rf"], "rf", ["amount", "current_age"], ["amount"])
    rows = [(n, i, w > 0.9) for i, (n, w) in enumerate(model.importances(), 1)]
    return spark.createDataFrame(rows, "feature string, rank int, decides boolean")


RULE = "CASE WHEN o_totalprice > 250000 OR o_custkey % 7 = 0 THEN 1 ELSE 0 END"


@query(
    "ml_07_classification_report",
    f"""WITH t AS (SELECT CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS DOUBLE) AS label, CAST({RULE} AS DOUBLE) AS p FROM orders),
    c AS (SELECT CAST(unnest([0, 1]) AS DOUBLE) AS class),
    n AS (SELECT class, count(*) FILTER (label = class) AS support, count(*) FILTER (p = class) AS predicted,
      count(*) FILTER (label = class AND p = class) AS hit FROM c, t GROUP BY 1)
    SELECT class, hit / CAST(predicted AS DOUBLE) AS precision, hit / CAST(support AS DOUBLE) AS recall,
      CAST(2 AS DOUBLE) * hit / (predicted + support) AS f1, support FROM n""",
)
def _(spark, sf):
    """Report of a fixed rule's predictions over all orders."""
    o = B.table(spark, sf, "orders")
    label = (F.col("o_orderpriority") == "1-URGENT").cast("double").alias("label")
    return fraud.classification_report(o.select(label, F.expr(RULE).cast("double").alias("prediction")))


# Scores with ties, and rows without a score.
SCORED = """SELECT CASE WHEN o_orderkey % 11 <> 0 THEN CAST(floor(o_totalprice / 500) AS DOUBLE) END AS score,
    CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS DOUBLE) AS label FROM orders"""
CURVE = f"""WITH t AS ({SCORED}), p AS (SELECT sum(label) AS total FROM t),
    c AS (SELECT score AS threshold, sum(label) AS hits, count(*) AS n FROM t WHERE score IS NOT NULL GROUP BY 1),
    curve AS (SELECT threshold, CAST(sum(hits) OVER w AS BIGINT) AS true_positives, CAST(sum(n) OVER w AS BIGINT) AS predicted,
      sum(hits) OVER w / sum(n) OVER w AS precision, sum(hits) OVER w / total AS recall FROM c, p WINDOW w AS (ORDER BY threshold DESC)) """


def scored_orders(spark, sf):
    o = B.table(spark, sf, "orders")
    score = F.when(F.col("o_orderkey") % 11 != 0, F.floor(F.col("o_totalprice") / 500).cast("double"))
    return o.select(score.alias("score"), (F.col("o_orderpriority") == "1-URGENT").cast("double").alias("label"))


@query("ml_07_precision_recall_curve", CURVE + "SELECT * FROM curve")
def _(spark, sf):
    return curves.precision_recall_curve(scored_orders(spark, sf)).drop("_bucket")


@query(
    "ml_07_pr_auc",
    CURVE
    + """SELECT round(sum((recall - r) * (precision + p) / 2), 9) AS pr_auc FROM (SELECT recall, precision,
      coalesce(lag(recall) OVER w, 0) AS r, coalesce(lag(precision) OVER w, 1) AS p FROM curve WINDOW w AS (ORDER BY threshold DESC))""",
)
def _(spark, sf):
    return curves.area(curves.precision_recall_curve(scored_orders(spark, sf))).select(F.round("pr_auc", 9).alias("pr_auc"))


def held_out_model(spark, sf):
    """The full forest fitted on the first 60 of the last 90 days, and the rows of the last 30.

    Fitting and scoring read the features a dozen times, so these are stored once, in a file for every core.
    """
    features = fraud.numeric(recent_features(spark, sf))
    spread = features.repartition(spark.sparkContext.defaultParallelism)
    data = stored(spread, "features")
    boundary = F.date_sub(B.newest(B.table(spark, sf, "orders"), "o_orderdate").cast("date"), 30)
    early, late = fraud.split_by_time(data, "transaction_date", boundary)
    return fraud.fit(early, fraud.candidates()["rf"], "rf"), late


LATE = "SELECT * FROM analysis WHERE transaction_date >= (SELECT CAST(max(o_orderdate) AS DATE) - 30 FROM orders)"


@query(
    "ml_07_held_out_report",
    marts.FACTS + f"SELECT CAST(CASE WHEN is_fraud THEN 1 ELSE 0 END AS DOUBLE) AS class, count(*) AS support, true AS sound FROM ({LATE}) GROUP BY 1",
)
def _(spark, sf):
    """Report on a time hold-out; what the trees find is theirs, the support and the bounds of the shares are not."""
    model, late = held_out_model(spark, sf)
    report = fraud.classification_report(model.pipeline.transform(late))
    shares = [F.coalesce(F.col(c), F.lit(0.0)) for c in ("precision", "recall", "f1")]
    sound = reduce(Column.__and__, [s.between(0, 1) for s in shares])
    return report.where("support > 0").select("class", "support", sound.alias("sound"))


@query(
    "ml_08_saved_model",
    marts.FACTS + f"SELECT transaction_id, 'rf' AS model_used, true AS same FROM ({LATE})",
)
def _(spark, sf):
    """Scores of a model that was saved and loaded again equal those of the fitted one."""
    model, late = held_out_model(spark, sf)
    late, path = late.drop("label"), scratch_path(spark, "model")
    model.save(path)
    kept = fraud.score(model, late).select("transaction_id", F.col("fraud_probability").alias("kept"))
    again = fraud.score(fraud.TrainedModel.load(path), late)
    return again.join(kept, "transaction_id").select("transaction_id", "model_used", (F.col("fraud_probability") == F.col("kept")).alias("same"))


@query(
    "ml_09_scores",
    """SELECT o_orderkey AS transaction_id, p AS fraud_probability, p > 0.5 AS is_fraud, abs(p - 0.5) * 2 AS confidence
    FROM (SELECT o_orderkey, (o_orderkey % 1000) / CAST(1000 AS DOUBLE) AS p FROM orders)""",
)
def _(spark, sf):
    """The arithmetic of a score on a column of probabilities."""
    o = B.table(spark, sf, "orders")
    p = (F.col("o_orderkey") % 1000) / F.lit(1000.0)
    return o.select(F.col("o_orderkey").alias("transaction_id"), *[c.alias(n) for n, c in fraud.verdict(p).items()])
