"""Fraud model: training set, scaling, balancing, selection, evaluation, scoring (ML-01 .. ML-09)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnspark.ml.curves import area, precision_recall_curve
from txnspark.ml.neighbours import nearest, spreads
from txnspark.plans.staging import last_days

# Features of the model, the scaled ones, and the parameters of the candidates.
FEATURES = [
    "amount",
    "use_chip",
    "has_chip",
    "credit_limit",
    "current_age",
    "distance_to_merchant",
    "transaction_hour",
    "transaction_day_of_week",
    "unemployment_rate",
    "unemployment_change_rate",
]
SCALED = ["amount", "credit_limit", "distance_to_merchant", "unemployment_rate", "unemployment_change_rate"]
TREES = 100
FOREST_DEPTH = 10
LEARNING_RATE = 0.1
POSITIVE_WEIGHT = 10.0
FOLDS = 5
SEED = 42
SMOTE_NEIGHBOURS = 5


def training_set(features: DataFrame, as_of: Column | None = None, days: int = 90) -> DataFrame:
    """ML-01: features and label of the last days, with the keys needed for splits."""
    recent = last_days(features, "transaction_date", days, as_of)
    return recent.select("transaction_id", "transaction_date", *FEATURES, "is_fraud")


def numeric(df: DataFrame) -> DataFrame:
    """ML-02: booleans as 0/1, all features as doubles, label as double; missing values become 0."""
    columns = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in FEATURES]
    kept = [c for c in df.columns if c not in FEATURES]
    label = [F.col("is_fraud").cast("double").alias("label")] if "is_fraud" in df.columns else []
    return df.select(*kept, *columns, *label)


def z_scores(df: DataFrame, columns: Sequence[str] = SCALED, fitted_on: DataFrame | None = None) -> DataFrame:
    """ML-02, AGG-14: (x - mean) / sample deviation; a constant column becomes NULL.

    The statistics are one aggregate row; give ``fitted_on`` to scale with the training set's.
    """
    source = df if fitted_on is None else fitted_on
    moments = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("mean", F.avg), ("std", F.stddev_samp))]
    stats = source.agg(F.struct(*moments)).scalar()
    scaled = {c: F.try_divide(F.col(c) - F.col("_stats")[f"mean_{c}"], F.col("_stats")[f"std_{c}"]) for c in columns}
    return df.withColumn("_stats", stats).withColumns(scaled).drop("_stats")


def balanced_weights(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """ML-03: weight n / (2 * n_class) per row."""
    counts = df.agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col(label) == 1, 1)).alias("positive"))
    ).scalar()
    both = df.withColumn("_c", counts)
    size = F.when(F.col(label) == 1, F.col("_c.positive")).otherwise(F.col("_c.n") - F.col("_c.positive"))
    return both.withColumn(out, F.col("_c.n") / (2.0 * size)).drop("_c")


def positive_weights(df: DataFrame, scale: float = POSITIVE_WEIGHT, label: str = "label", out: str = "weight") -> DataFrame:
    """ML-03: weight ``scale`` for positives, 1 for the rest."""
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(scale)).otherwise(F.lit(1.0)))


_RANK_BUCKETS = 1 << 16


def _lowest(df: DataFrame, key: str, seed: int, n: int) -> Column:
    """Condition that holds for exactly ``n`` rows of a frame with unique ``key``: those of lowest hash.

    Counts per hash bucket find the bucket of the n-th row; only that bucket (a 65 536th of the rows) is sorted.
    """
    hashed = F.xxhash64(F.col(key), F.lit(seed))
    bucket = F.pmod(hashed, F.lit(_RANK_BUCKETS))
    order = F.struct(hashed.alias("h"), F.col(key).alias("k"))
    counts = df.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).orderBy("b").collect()
    left = n
    for b, size in counts:
        if left <= size:
            break
        left -= size
    cut = df.where(bucket == b).select(order.alias("o")).orderBy("o").offset(left - 1).limit(1).first()["o"]
    bound = F.struct(F.lit(cut["h"]).cast("bigint").alias("h"), F.lit(cut["k"]).cast(df.schema[key].dataType).alias("k"))
    return (bucket < b) | ((bucket == b) & (order <= bound))


def smote(
    df: DataFrame,
    features: Sequence[str] = FEATURES,
    label: str = "label",
    key: str = "transaction_id",
    neighbours: int = SMOTE_NEIGHBOURS,
    seed: int = SEED,
) -> DataFrame:
    """ML-03: oversampling of the positives to the number of negatives, by interpolation between near positives.

    Each synthetic row lies between a positive and one of its ``neighbours`` nearest positives, found by
    locality-sensitive hashing in linear work (``neighbours.nearest``). All choices come from hashes of ``key`` and
    ``seed``, so a recomputed task yields the same rows. Fewer than two positives cannot be interpolated and are an error.
    """
    columns = [key, *features, label]
    base = df.select(*columns)
    counts = base.agg(F.count(F.when(F.col(label) == 1, 1)).alias("p"), F.count(F.when(F.col(label) != 1, 1)).alias("n")).first()
    positives, negatives = counts["p"], counts["n"]
    missing = negatives - positives
    if missing <= 0:
        return base.withColumn("synthetic", F.lit(False))
    if positives < 2:
        raise ValueError(f"{positives} positives: interpolation needs two")

    def uniform(*parts: Column) -> Column:
        return F.pmod(F.xxhash64(*parts, F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))

    minority = base.where(F.col(label) == 1)
    deviation = spreads(minority, features)
    near = nearest(minority, features, key, neighbours, seed=seed)
    each, rest = divmod(missing, positives)
    extra = F.when(_lowest(minority, key, seed + 1, rest), 1).otherwise(0) if rest else F.lit(0)
    copies = minority.withColumn("_copies", F.lit(each) + extra).where(F.col("_copies") > 0).join(near, key, "left")
    copies = copies.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
    pick = F.floor(uniform(F.col(key), F.col("_copy"), F.lit("pick")) * F.size("near")).cast("int")
    gap = uniform(F.col(key), F.col("_copy"), F.lit("gap"))
    # A row without neighbours is its own.
    chosen = copies.withColumn("_to", F.when(F.size("near") > 0, F.get("near", pick)["x"])).withColumn("_gap", gap)

    def between(i: int, c: str) -> Column:
        if deviation[c] is None:
            return F.col(c)
        to = F.coalesce(F.get("_to", F.lit(i)) * F.lit(deviation[c]), F.col(c))
        return F.col(c) + F.col("_gap") * (to - F.col(c))

    synthetic = chosen.select(key, *[between(i, c).alias(c) for i, c in enumerate(features)], label, F.lit(True).alias("synthetic"))
    return base.withColumn("synthetic", F.lit(False)).unionByName(synthetic)


def stages(features: Sequence[str] = FEATURES, scaled: Sequence[str] = SCALED) -> list:
    """Assembling and scaling stages; the scaler is fitted with the model and so applies to scored rows as well."""
    plain = [c for c in features if c not in scaled]
    return [
        VectorAssembler(inputCols=list(scaled), outputCol="_to_scale"),
        StandardScaler(inputCol="_to_scale", outputCol="_scaled", withMean=True, withStd=True),
        VectorAssembler(inputCols=["_scaled", *plain], outputCol="features"),
    ]


def feature_order(features: Sequence[str] = FEATURES, scaled: Sequence[str] = SCALED) -> list[str]:
    """Feature names in the order of the assembled vector."""
    return [*scaled, *[c for c in features if c not in scaled]]


def candidates(trees: int = TREES, depth: int = FOREST_DEPTH, seed: int = SEED) -> dict[str, Estimator]:
    """ML-04: estimators, each with the balancing of its training rows.

    The third candidate of the reference is another boosting library; here it is boosting with positives weighted up.
    """
    from txnspark.ml.balance import Balanced

    shared = {"featuresCol": "features", "labelCol": "label", "seed": seed}
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, weightCol="weight", **shared)
    boosting = GBTClassifier(maxIter=trees, stepSize=LEARNING_RATE, maxDepth=3, **shared)
    weighted = GBTClassifier(maxIter=trees, stepSize=0.3, maxDepth=6, weightCol="weight", **shared)
    return {"rf": Balanced(forest, "balanced"), "gb": Balanced(boosting, "smote"), "weighted_gb": Balanced(weighted, "positive")}


def with_folds(df: DataFrame, folds: int = FOLDS, key: str = "transaction_id") -> DataFrame:
    """ML-05: fold number from a digest of the key, so the shares of the label are equal up to chance in every fold."""
    digits = F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint")
    return df.withColumn("fold", (digits % folds).cast("int"))


def with_weights(df: DataFrame) -> DataFrame:
    return positive_weights(balanced_weights(df, out="balanced_weight"), out="positive_weight")


def f1_evaluator() -> MulticlassClassificationEvaluator:
    """F1 of the positive class."""
    return MulticlassClassificationEvaluator(
        labelCol="label", predictionCol="prediction", metricName="fMeasureByLabel", metricLabel=1.0
    )


@dataclass
class TrainedModel:
    """ML-08: fitted pipeline with its metadata."""

    name: str
    pipeline: PipelineModel
    scores: dict[str, tuple[float, float]] = field(default_factory=dict)
    features: Sequence[str] = tuple(FEATURES)
    scaled: Sequence[str] = tuple(SCALED)

    def importances(self) -> list[tuple[str, float]]:
        """ML-06, SORT-05: features by importance, greatest first."""
        model = self.pipeline.stages[-1]
        weights = model.featureImportances.toArray().tolist()
        return sorted(zip(feature_order(self.features, self.scaled), weights), key=lambda x: (-x[1], x[0]))

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        features, scaled = list(self.features), list(self.scaled)
        rows = [(self.name, n, m, s, features, scaled) for n, (m, s) in self.scores.items()]
        meta = _session().createDataFrame(rows or [(self.name, self.name, None, None, features, scaled)], _METADATA)
        meta.coalesce(1).write.mode("overwrite").json(f"{path}/metadata")

    @staticmethod
    def load(path: str) -> TrainedModel:
        rows = _session().read.json(f"{path}/metadata", _METADATA).collect()
        scores = {r["candidate"]: (r["mean_f1"], r["std_f1"]) for r in rows if r["mean_f1"] is not None}
        first = rows[0]
        return TrainedModel(first["best_model"], PipelineModel.load(f"{path}/pipeline"), scores, tuple(first["features"]), tuple(first["scaled"]))


_METADATA = "best_model string, candidate string, mean_f1 double, std_f1 double, features array<string>, scaled array<string>"


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession()


def cross_validate(
    df: DataFrame, models: dict[str, Estimator] | None = None, folds: int = FOLDS, parallelism: int = 2
) -> dict[str, tuple[float, float]]:
    """ML-05: mean and deviation of the F1 score per candidate.

    Scaling and balancing are fitted with the training rows; the held-out fold has neither synthetic nor weighted rows.
    """
    data = with_folds(df, folds)
    scores = {}
    for name, estimator in (models or candidates()).items():
        validator = CrossValidator(
            estimator=Pipeline(stages=[*stages(), estimator]),
            estimatorParamMaps=ParamGridBuilder().build(),
            evaluator=f1_evaluator(),
            numFolds=folds,
            foldCol="fold",
            parallelism=parallelism,
        )
        fitted = validator.fit(data)
        scores[name] = (float(fitted.avgMetrics[0]), float(fitted.stdMetrics[0]))
    return scores


def fit(
    df: DataFrame, estimator: Estimator, name: str = "model", features: Sequence[str] = FEATURES, scaled: Sequence[str] = SCALED
) -> TrainedModel:
    """ML-06: pipeline of scaling and one estimator, which balances its rows itself (``balance.Balanced``)."""
    pipeline = Pipeline(stages=[*stages(features, scaled), estimator])
    return TrainedModel(name, pipeline.fit(df), features=tuple(features), scaled=tuple(scaled))


def train(df: DataFrame, models: dict[str, Estimator] | None = None, folds: int = FOLDS) -> TrainedModel:
    """ML-04 .. ML-06: compare the candidates, refit the best on all rows. ``df`` comes from ``numeric``."""
    models = models or candidates()
    scores = cross_validate(df, models, folds)
    best = max(scores, key=lambda n: scores[n][0])
    model = fit(df, models[best], best)
    model.scores = scores
    return model


def verdict(probability: Column) -> dict[str, Column]:
    """ML-09: probability, flag and confidence of a scored row."""
    return {
        "fraud_probability": probability,
        "is_fraud": probability > 0.5,
        "confidence": F.abs(probability - 0.5) * 2,
    }


def score(model: TrainedModel, df: DataFrame) -> DataFrame:
    """ML-09: probability, flag, confidence, model name and top features for batch or streaming rows."""
    top = [F.struct(F.lit(n).alias("feature"), F.lit(float(w)).alias("importance")) for n, w in model.importances()[:5]]
    kept = [c for c in df.columns if c not in FEATURES and c != "is_fraud"]
    return model.pipeline.transform(numeric(df)).select(
        *kept,
        *[c.alias(n) for n, c in verdict(vector_to_array("probability")[1]).items()],
        F.lit(model.name).alias("model_used"),
        F.array(*top).alias("top_features"),
    )


def classification_report(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """ML-07: precision, recall, F1 and support per class, from four confusion counts."""
    counts = predictions.groupBy(F.col(label).alias("t"), F.col(prediction).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sides = counts.select(
        F.explode(
            F.array(
                F.struct(F.col("t").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"),
                         F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(F.lit(0)).alias("hit")),
                F.struct(F.col("p").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"),
                         F.lit(0).cast("bigint").alias("hit")),
            )
        ).alias("s")
    ).select("s.*")
    total = sides.groupBy("class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hit").alias("hit")
    )
    precision, recall = F.try_divide("hit", "predicted"), F.try_divide("hit", "support")
    return total.select(
        "class",
        precision.alias("precision"),
        recall.alias("recall"),
        F.try_divide(F.lit(2.0) * F.col("hit"), F.col("predicted") + F.col("support")).alias("f1"),
        "support",
    )


def pr_auc(predictions: DataFrame) -> float:
    """ML-07: area under the exact precision-recall curve of the probabilities."""
    scored = predictions.select(vector_to_array("probability")[1].alias("score"), "label")
    return area(precision_recall_curve(scored)).first()["pr_auc"]


def split_by_time(df: DataFrame, ts: str, boundary: Column) -> tuple[DataFrame, DataFrame]:
    """Training rows before a point in time, test rows from it on."""
    return df.where(F.col(ts) < boundary), df.where(F.col(ts) >= boundary)
