"""Fraud model on a small separable data set."""

from __future__ import annotations

import datetime as dt
import random
import statistics

import numpy as np
import pytest
from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.sql import functions as F

from helpers import rows
from txnspark.ml import curves, fraud
from txnspark.ml.balance import Balanced
from txnspark.ml.neighbours import nearest


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(7)
    out = []
    for i in range(400):
        is_fraud = rng.random() < 0.15
        amount = rng.gauss(300 if is_fraud else 50, 20)
        out.append((i, amount, rng.random() < 0.5, True, 1000.0, 20 + i % 50, rng.random() * 1e5, i % 24, 1 + i % 7, 4.0, None, is_fraud))
    columns = (
        "transaction_id long, amount double, use_chip boolean, has_chip boolean, credit_limit double, current_age int, "
        "distance_to_merchant double, transaction_hour int, transaction_day_of_week int, unemployment_rate double, "
        "unemployment_change_rate double, is_fraud boolean"
    )
    return spark.createDataFrame(out, columns).repartition(3).cache()


def forest(**kw):
    inner = RandomForestClassifier(numTrees=5, maxDepth=4, weightCol="weight", featuresCol="features", labelCol="label", seed=1, **kw)
    return Balanced(inner, "balanced")


def test_numeric(data):
    n = fraud.numeric(data)
    assert {dict(n.dtypes)[c] for c in [*fraud.FEATURES, "label"]} == {"double"}
    assert n.where("unemployment_change_rate IS NULL").count() == 0


def test_z_scores(data):
    got = [r[0] for r in fraud.z_scores(data, ["amount", "credit_limit"]).select("amount").collect()]
    assert abs(statistics.mean(got)) < 1e-9 and abs(statistics.stdev(got) - 1) < 1e-9
    assert fraud.z_scores(data, ["credit_limit"]).where("credit_limit IS NOT NULL").count() == 0
    train = data.where("transaction_id < 100")
    held_out = fraud.z_scores(data, ["amount"], fitted_on=train)
    assert held_out.count() == 400


def test_weights(data):
    w = fraud.with_weights(fraud.numeric(data))
    totals = dict(w.groupBy("label").agg(F.sum("balanced_weight")).collect())
    assert totals[0.0] == pytest.approx(200) and totals[1.0] == pytest.approx(200)
    assert dict(w.groupBy("label").agg(F.max("positive_weight")).collect()) == {0.0: 1.0, 1.0: 10.0}


def test_smote_balances_by_interpolation(data):
    n = fraud.numeric(data)
    grown = fraud.smote(n)
    per_class = dict(grown.groupBy("label").count().collect())
    assert per_class[0.0] == per_class[1.0]
    assert grown.where("NOT synthetic").count() == 400
    bounds = n.where("label = 1").agg(F.min("amount"), F.max("amount")).first()
    made = grown.where("synthetic").agg(F.min("amount"), F.max("amount"), F.min("label")).first()
    assert bounds[0] <= made[0] and made[1] <= bounds[1] and made[2] == 1.0
    # Constant features stay what they are.
    assert grown.select("credit_limit", "unemployment_rate").distinct().count() == 1


def test_smote_repeats_itself(data):
    n = fraud.numeric(data).select("transaction_id", "amount", "current_age", "label")
    assert rows(fraud.smote(n, ["amount", "current_age"])) == rows(fraud.smote(n.repartition(5), ["amount", "current_age"]))


def test_smote_needs_two_positives(data):
    n = fraud.numeric(data).withColumn("label", (F.col("transaction_id") == 3).cast("double"))
    with pytest.raises(ValueError, match="interpolation needs two"):
        fraud.smote(n)


def _recall(df, features, k=5):
    """Share of the true nearest neighbours, by distance, that the hashes find."""
    got = {r["transaction_id"]: [x["dist"] for x in r["near"]] for r in nearest(df, features, "transaction_id", k).collect()}
    table = df.select("transaction_id", *features).toPandas()
    x = table[features].to_numpy(float)
    deviation = x.std(axis=0, ddof=1)
    x = x[:, deviation > 0] / deviation[deviation > 0]
    found = total = 0
    for i, key in enumerate(table["transaction_id"]):
        d = ((x - x[i]) ** 2).sum(axis=1)
        d[i] = np.inf
        limit = np.sort(d)[k - 1] * (1 + 1e-9) + 1e-12
        found += sum(v <= limit for v in got[key])
        total += k
    return found / total


def test_hashed_neighbours_reach_recall(spark):
    from txnspark.catalog import model

    source = model.balanced_source(spark, "/root/testdata/sf0.01").where("label = 1")
    assert _recall(source, ["amount", "current_age"]) >= 0.9
    # Ten dimensions, as many as the model has.
    rng = np.random.default_rng(3)
    wide = rng.normal(size=(1500, 3)) @ rng.normal(size=(3, 10)) + 0.05 * rng.normal(size=(1500, 10))
    names = [f"f{i}" for i in range(10)]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(wide)], "transaction_id long, " + ", ".join(f"{n} double" for n in names))
    assert _recall(df, names) >= 0.9


def test_neighbours_of_equal_and_lone_rows(spark):
    df = spark.createDataFrame([(i, 1.0, 2.0) for i in range(50)] + [(99, 5.0, 9.0)], "transaction_id long, a double, b double")
    near = {r["transaction_id"]: r["near"] for r in nearest(df, ["a", "b"], "transaction_id", 3).collect()}
    assert len(near) == 51 and all(len(n) == 3 for n in near.values())
    assert all(x["dist"] == 0 for k, n in near.items() if k != 99 for x in n)
    one = df.limit(1)
    assert nearest(one, ["a"], "transaction_id", 3).first()["near"] == []


def test_smote_leaves_balanced_data(data):
    n = fraud.numeric(data).where("label = 1")
    assert fraud.smote(n).where("synthetic").count() == 0


def test_train_select_score_save(spark, data, tmp_path):
    n = fraud.numeric(data)
    models = {
        "rf": forest(),
        "gb": Balanced(GBTClassifier(maxIter=3, stepSize=0.1, featuresCol="features", labelCol="label", seed=1), "smote"),
    }
    model = fraud.train(n, models, folds=3)
    assert set(model.scores) == {"rf", "gb"} and model.scores[model.name][0] == max(s[0] for s in model.scores.values())
    assert model.scores[model.name][0] > 0.9
    top = model.importances()
    assert top[0][0] == "amount" and len(top) == len(fraud.FEATURES)
    model.save(str(tmp_path / "model"))
    again = fraud.TrainedModel.load(str(tmp_path / "model"))
    assert again.name == model.name and again.scores == model.scores
    scored = fraud.score(again, data.drop("is_fraud"))
    assert scored.columns == ["transaction_id", "fraud_probability", "is_fraud", "confidence", "model_used", "top_features"]
    assert rows(scored) == rows(fraud.score(model, data))
    assert scored.where("is_fraud <> (fraud_probability > 0.5) OR confidence > 1 OR size(top_features) <> 5").count() == 0


def test_report_and_auc(data):
    n = fraud.numeric(data)
    predictions = fraud.fit(n, forest()).pipeline.transform(n)
    report = {r["class"]: r for r in fraud.classification_report(predictions).collect()}
    tp = predictions.where("label = 1 AND prediction = 1").count()
    assert report[1.0]["support"] == predictions.where("label = 1").count()
    assert report[1.0]["recall"] == tp / report[1.0]["support"]
    assert report[1.0]["precision"] == tp / predictions.where("prediction = 1").count()
    assert 0.9 < fraud.pr_auc(predictions) <= 1.0


class Recorder(Estimator):
    """Notes what it is fitted on."""

    seen: list = []

    def _fit(self, dataset):
        Recorder.seen.append((dataset.count(), dict(dataset.groupBy("label").count().collect()), dataset.agg(F.sum("weight")).first()[0] if "weight" in dataset.columns else None))
        return RandomForestClassifier(numTrees=1, maxDepth=2, seed=1, featuresCol="features", labelCol="label").fit(dataset)

    def copy(self, extra=None):
        return self


def test_balancing_touches_the_training_fold_alone(data):
    n = fraud.numeric(data)
    folds = fraud.with_folds(n, 3)
    sizes = {(f, l): c for f, l, c in folds.groupBy("fold", "label").count().collect()}
    for strategy in ("balanced", "smote"):
        Recorder.seen = []
        fraud.cross_validate(n, {"x": Balanced(Recorder(), strategy)}, folds=3, parallelism=1)
        want = []
        for f in range(3):
            p, q = (sum(c for (g, l), c in sizes.items() if g != f and l == label) for label in (1.0, 0.0))
            want.append((p + q, {1.0: p, 0.0: q}, pytest.approx(p + q)) if strategy == "balanced" else (2 * q, {1.0: q, 0.0: q}, None))
        # The last fit is the refit on all rows.
        assert Recorder.seen[:3] == want


@pytest.mark.parametrize("partitions", ["1", "5"])
def test_curve_equals_brute_force(spark, partitions):
    rng = random.Random(6)
    scored = [(round(rng.random(), 2) if rng.random() < 0.95 else None, float(rng.random() < 0.3)) for _ in range(500)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        curve = curves.precision_recall_curve(spark.createDataFrame(scored, "score double, label double"))
        got = {r["threshold"]: (r["true_positives"], r["predicted"], r["precision"], r["recall"]) for r in curve.collect()}
        area = curves.area(curve).first()["pr_auc"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    total = sum(l for _, l in scored)
    want, whole, r0, p0 = {}, 0.0, 0.0, 1.0
    for t in sorted({s for s, _ in scored if s is not None}, reverse=True):
        above = [l for s, l in scored if s is not None and s >= t]
        hits = sum(above)
        want[t] = (hits, len(above), hits / len(above), hits / total)
        whole += (hits / total - r0) * (hits / len(above) + p0) / 2
        r0, p0 = hits / total, hits / len(above)
    assert got == want and area == pytest.approx(whole)


def test_curve_of_nothing(spark):
    curve = curves.precision_recall_curve(spark.createDataFrame([(None, 1.0)], "score double, label double"))
    assert curve.count() == 0 and curves.area(curve).first()["pr_auc"] is None


def test_candidates_and_split(data):
    models = fraud.candidates(trees=2)
    assert set(models) == {"rf", "gb", "weighted_gb"}
    assert models["rf"].inner.getMaxDepth() == 10 and models["rf"].copy().strategy == "balanced"
    early, late = fraud.split_by_time(data, "transaction_hour", F.lit(12))
    assert early.count() + late.count() == 400
    assert fraud.with_folds(data).select("fold").distinct().count() == 5


def test_model_is_fitted_and_scored_on_features_computed_once(spark, tmp_path, monkeypatch):
    from txnspark.catalog import model

    days = [dt.datetime(2024, 3, 31) - dt.timedelta(days=d) for d in (0, 10, 29, 31, 60, 89)]
    orders = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "o_orderkey bigint, o_orderdate timestamp_ntz")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    named = [F.lit(1.0).alias(c) for c in fraud.FEATURES]
    features = orders.select(F.col("o_orderkey").alias("transaction_id"), F.col("o_orderdate").alias("transaction_date"), *named, F.lit(True).alias("is_fraud"))
    joined = features.join(orders.select(F.col("o_orderkey").alias("transaction_id")), "transaction_id")
    monkeypatch.setattr(model, "recent_features", lambda *_: joined)
    monkeypatch.setattr(model.fraud, "fit", lambda df, *_: df)
    early, late = model.held_out_model(spark, str(tmp_path))
    assert sorted(r["transaction_id"] for r in early.collect()) == [3, 4, 5]
    assert sorted(r["transaction_id"] for r in late.collect()) == [0, 1, 2]
    for df in (early, late):
        assert "Join" not in df._jdf.queryExecution().optimizedPlan().toString()
