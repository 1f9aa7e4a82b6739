"""Independent class-against-rest models on top of the built-in estimators.

A label row may end up with no class or several: there is no argmax between
the models. Inputs are tables with ``category`` and a vector column ``features``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import DecisionTreeClassifier, LinearSVC, LogisticRegression, OneVsRest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fits that may be submitted at the same time; the cluster shares them out
PARALLEL_FITS = 8


def linear_svm(n: int, c: float = 1.0, tol: float = 1e-4, max_iter: int = 100) -> LinearSVC:
    """C weighs the summed loss, hence regParam = 1 / (C n); stops at ``tol`` or ``max_iter``."""
    return LinearSVC(regParam=1.0 / (c * n), tol=tol, maxIter=max_iter, standardization=False)


def logistic(n: int, c: float = 1.0, l1: bool = False, max_iter: int = 100) -> LogisticRegression:
    return LogisticRegression(
        regParam=1.0 / (c * n), elasticNetParam=1.0 if l1 else 0.0, maxIter=max_iter, standardization=False
    )


def decision_tree(n: int, max_depth: int = 30, min_leaf: int = 1, seed: int = 1) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(maxDepth=max_depth, minInstancesPerNode=min_leaf, seed=seed, maxMemoryInMB=512)


ESTIMATORS: dict[str, Callable[[int], Estimator]] = {
    "SVM/Linear SVC": linear_svm,
    "Logistic Regression": logistic,
    "Decision Tree": decision_tree,
}


def in_parallel(tasks: Sequence[Callable], threads: int = PARALLEL_FITS) -> list:
    """Run independent Spark actions side by side from the driver."""
    with ThreadPoolExecutor(max_workers=max(1, min(threads, len(tasks)))) as pool:
        return [f.result() for f in [pool.submit(t) for t in tasks]]


@dataclass(frozen=True)
class BinaryRelevance:
    """One fitted binary model per class."""

    models: list[Model]
    classes: list

    def predict(
        self,
        df: DataFrame,
        key: str = "doc_id",
        category: str = "category",
        keep: Sequence[str] = (),
        features: Sequence[str] | None = None,
    ) -> DataFrame:
        """Long (key, keep..., class_id, y, score, pred); all models score in one pass.

        ``features`` names the vector column of each model, where they differ.
        """
        columns = list(features or ["features"] * len(self.models))
        scored = df.select(key, category, *dict.fromkeys(columns), *keep)
        entries = []
        for i, (c, model) in enumerate(zip(self.classes, self.models)):
            has_probability = model.hasParam("probabilityCol")
            params = {
                model.featuresCol: columns[i],
                model.rawPredictionCol: f"_raw{i}",
                model.predictionCol: f"_pred{i}",
            }
            if has_probability:
                params[model.probabilityCol] = f"_prob{i}"
            scored = model.transform(scored, params)
            score = vector_to_array(F.col(f"_prob{i}" if has_probability else f"_raw{i}"))[1]
            entries.append(
                F.struct(
                    F.lit(i).alias("class_id"),
                    (F.col(category) == F.lit(c)).cast("int").alias("y"),
                    score.alias("score"),
                    F.col(f"_pred{i}").cast("int").alias("pred"),
                )
            )
        return scored.select(key, *keep, F.inline(F.array(*entries)))


def binary_target(df: DataFrame, value, category: str = "category") -> DataFrame:
    return df.withColumn("label", (F.col(category) == F.lit(value)).cast("double"))


def fit_binary_relevance(
    df: DataFrame,
    estimator: Estimator,
    classes: Sequence,
    category: str = "category",
    threads: int = PARALLEL_FITS,
    weight: str | None = None,
) -> BinaryRelevance:
    """Fit one copy of ``estimator`` per class; the caller keeps ``df`` cached."""
    extra = {estimator.weightCol: weight} if weight else {}
    fits = [lambda c=c: estimator.fit(binary_target(df, c, category), extra) for c in classes]
    return BinaryRelevance(in_parallel(fits, threads), list(classes))


def linear_table(model: BinaryRelevance) -> list[tuple[int, list[float], float]]:
    """(class_id, coefficients, bias) of fitted linear models."""
    return [(i, [float(x) for x in m.coefficients.toArray()], float(m.intercept)) for i, m in enumerate(model.models)]


def fit_one_vs_rest(df: DataFrame, estimator: Estimator, category: str = "category"):
    """Argmax multiclass model on a one-dimensional label (0-based)."""
    labelled = df.withColumn("label", F.col(category).cast("double") - 1)
    if isinstance(estimator, DecisionTreeClassifier):
        return estimator.fit(labelled)
    return OneVsRest(classifier=estimator, parallelism=PARALLEL_FITS).fit(labelled)


def predict_label(model, df: DataFrame, key: str = "doc_id", category: str = "category") -> DataFrame:
    """(key, actual, predicted), both 0-based."""
    return model.transform(df).select(
        key, (F.col(category) - 1).alias("actual"), F.col("prediction").cast("int").alias("predicted")
    )
