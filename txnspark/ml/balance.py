"""Balancing that belongs to fitting: an estimator that balances what it is fitted on and nothing else (ML-03 .. ML-05)."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnspark.ml import fraud

STRATEGIES = ("none", "balanced", "positive", "smote")


def balance(df: DataFrame, strategy: str, weight: str = "weight", features: str = "features", label: str = "label", key: str = "transaction_id") -> DataFrame:
    """Training rows with weights (``balanced``: n / (2 n_class), ``positive``: a constant for positives) or with synthetic
    positives up to the number of negatives (``smote``, on the assembled vector)."""
    if strategy == "balanced":
        return fraud.balanced_weights(df, label, weight)
    if strategy == "positive":
        return fraud.positive_weights(df, label=label, out=weight)
    if strategy == "smote":
        size = df.select(F.size(vector_to_array(features)).alias("n")).first()["n"]
        parts = [f"_x{i}" for i in range(size)]
        wide = df.select(key, label, vector_to_array(features).alias("_x"))
        wide = wide.select(key, label, *[F.col("_x")[i].alias(c) for i, c in enumerate(parts)])
        grown = fraud.smote(wide, parts, label, key)
        return grown.select(key, label, array_to_vector(F.array(*parts)).alias(features), "synthetic")
    if strategy != "none":
        raise ValueError(f"strategy must be one of {STRATEGIES}, got {strategy!r}")
    return df


class Balanced(Estimator):
    """Fits ``inner`` on balanced rows and returns its model.

    Scored rows, and held-out folds of a cross-validation, pass the model untouched: weights and synthetic rows come from
    the training fold alone. An inner estimator with weights names the column ``weight``.
    """

    def __init__(self, inner: Estimator, strategy: str):
        super().__init__()
        if strategy not in STRATEGIES:
            raise ValueError(f"strategy must be one of {STRATEGIES}, got {strategy!r}")
        self.inner, self.strategy = inner, strategy

    def _fit(self, dataset: DataFrame) -> Model:
        return self.inner.fit(balance(dataset, self.strategy))

    def copy(self, extra=None) -> Balanced:
        return Balanced(self.inner.copy(extra or {}), self.strategy)
