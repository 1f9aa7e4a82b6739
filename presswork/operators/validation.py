"""Cross-validation, grid search, learning curves and feature sweeps.

Only model-sized and report-sized values reach the driver; the feature table is
cached once and shared by all fits.
"""

from __future__ import annotations

import itertools
import time
from collections.abc import Callable, Iterable, Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.operators import bayes
from presswork.operators import linear as lm
from presswork.operators import metrics as mt
from presswork.operators import wide as wd
from presswork.operators.models import ESTIMATORS, BinaryRelevance, fit_binary_relevance, in_parallel
from presswork.operators.sampling import prefix_subsets
from presswork.plans import staged

# a fitter takes (training rows, classes) and returns rows -> long scored table
Scorer = Callable[[DataFrame], DataFrame]
Fitter = Callable[[DataFrame, Sequence], Scorer]

RESULT = "algo STRING, cv_fold INT, metric STRING, value DOUBLE"


def estimator_fitter(make: Callable, threads: int = 4) -> Fitter:
    """Fitter for a factory n -> estimator."""

    def fit(train: DataFrame, classes: Sequence) -> Scorer:
        model: BinaryRelevance = fit_binary_relevance(train, make(train.count()), classes, threads=threads)
        return model.predict

    return fit


def gaussian_fitter(var_smoothing: float = 1e-9) -> Fitter:
    def fit(train: DataFrame, classes: Sequence) -> Scorer:
        model = bayes.fit_gaussian_nb(train, classes, var_smoothing)
        return lambda rows: bayes.score_gaussian_nb(rows, model, classes)

    return fit


def standard_fitters() -> dict[str, Fitter]:
    fitters = {"Gaussian Naive Bayes": gaussian_fitter()}
    fitters.update({name: estimator_fitter(make) for name, make in ESTIMATORS.items()})
    return fitters


def cross_validate(
    df: DataFrame,
    fitters: Mapping[str, Fitter],
    classes: Sequence,
    fold: str = "fold",
    threads: int = 4,
) -> DataFrame:
    """(algo, cv_fold, metric, value): fit and score time, micro precision, recall, F1, ROC AUC."""
    df = df.persist()
    folds = sorted(r[0] for r in df.select(fold).distinct().collect())

    def one(name: str, held_out: int) -> list[tuple]:
        start = time.perf_counter()
        score = fitters[name](df.where(F.col(fold) != held_out), classes)
        fitted = time.perf_counter()
        row = mt.micro_metrics(score(df.where(F.col(fold) == held_out))).first()
        done = time.perf_counter()
        values = {"fit_time": fitted - start, "score_time": done - fitted}
        values.update({f"test_{m}": row[m] for m in ("precision", "recall", "f1", "roc_auc")})
        return [(name, int(held_out), metric, float(v)) for metric, v in values.items()]

    try:
        parts = in_parallel([lambda n=n, f=f: one(n, f) for n in fitters for f in folds], threads)
    finally:
        df.unpersist()
    return df.sparkSession.createDataFrame(list(itertools.chain.from_iterable(parts)), RESULT)


def grid_search(
    df: DataFrame,
    settings: Iterable[dict],
    make: Callable[..., object],
    classes: Sequence,
    fold: str = "fold",
    threads: int = 8,
    train_scores: bool = False,
) -> DataFrame:
    """(setting, fold, train_f1, test_f1): micro F1 of every setting and fold.

    ``make(n, **setting)`` returns the estimator; ``setting`` is kept as text.
    """
    df = df.persist()
    folds = sorted(r[0] for r in df.select(fold).distinct().collect())
    sizes = dict(df.groupBy(fold).count().collect())
    total = sum(sizes.values())

    def one(setting: dict, held_out: int) -> tuple:
        train = df.where(F.col(fold) != held_out)
        model = fit_binary_relevance(train, make(total - sizes[held_out], **setting), classes, threads=1)
        test = mt.micro_metrics(model.predict(df.where(F.col(fold) == held_out))).first().f1
        fitted = mt.micro_metrics(model.predict(train)).first().f1 if train_scores else None
        text = ", ".join(f"{k}={v}" for k, v in setting.items())
        return text, int(held_out), fitted, test

    try:
        rows = in_parallel([lambda s=s, f=f: one(s, f) for s in settings for f in folds], threads)
    finally:
        df.unpersist()
    return df.sparkSession.createDataFrame(rows, "setting STRING, fold INT, train_f1 DOUBLE, test_f1 DOUBLE")


# Grids. Solver variants have no counterpart here, and a hinge with an L1 penalty is no setting.
PENALTIES = [1e-4, 1e-3, 1e-2, 1e-1, 1.0, 10.0, 100.0, 1000.0]
TOLERANCES = [1e-8, 1e-7, 1e-6, 1e-5, 1e-4, 1e-3, 1e-2, 1e-1, 1.0]


MARGINS = [("hinge", False), ("squared_hinge", False), ("squared_hinge", True)]


def logistic_grid(costs: Sequence[float] = tuple(PENALTIES)) -> list[dict]:
    return [{"loss": "logistic", "l1": l1, "c": c, "tol": 1e-4} for c in costs for l1 in (False, True)]


def svm_grid(costs: Sequence[float] = tuple(PENALTIES), tolerances: Sequence[float] = tuple(TOLERANCES)) -> list[dict]:
    return [{"loss": loss, "l1": l1, "c": c, "tol": t} for loss, l1 in MARGINS for c in costs for t in tolerances]


def grid_search_linear(df: DataFrame, settings: Sequence[dict], classes: Sequence, fold: str = "fold", max_passes: int = 150) -> DataFrame:
    """(setting, fold, train_f1, test_f1, distance): micro F1 of every setting and fold, from vectors ``vec``.

    All models are fitted side by side (``operators.linear``); settings that differ in ``tol`` alone
    are one path. ``distance`` is the farthest of a setting's classes from its optimum, in the measure
    that ``tol`` bounds; it is above ``tol`` where ``max_passes`` did not suffice.
    """
    rows = staged(lm.labelled(df, classes).select("label", F.col(fold).alias("fold"), "vec"), "grid-rows")
    first = rows.select(F.size("vec").alias("d")).first()
    schema = "setting STRING, fold INT, train_f1 DOUBLE, test_f1 DOUBLE, distance DOUBLE"
    if first is None:
        return df.sparkSession.createDataFrame([], schema)
    folds = sorted(r[0] for r in rows.select("fold").distinct().collect())
    paths: dict[tuple, list[float]] = {}
    for s in settings:
        paths.setdefault((s["loss"], s["l1"], s["c"]), []).append(s["tol"])
    problems = [
        lm.Problem(label, loss, l1, c, tuple(sorted(tols, reverse=True)), held)
        for (loss, l1, c), tols in paths.items() for held in folds for label in range(len(classes))
    ]
    fits = lm.fit_many(rows, first.d, problems, max_passes=max_passes)
    counts = lm.outcomes(rows, first.d, fits)
    keys = [(f.problem.loss, f.problem.l1, f.problem.c, t, f.problem.held) for f in fits for t in f.problem.tolerances]
    sums: dict[tuple, np.ndarray] = {}
    for key, inside, outside, reached in zip(keys, counts["inside"], counts["outside"], (r for f in fits for r in f.reached), strict=True):
        one = sums.setdefault(key, np.zeros(7))
        one[:6] += np.concatenate([inside, outside])
        one[6] = max(one[6], reached)
    out = []
    for s in settings:
        text = ", ".join(f"{k}={v}" for k, v in s.items())
        for held in folds:
            tp, fp, fn, ttp, tfp, tfn, distance = sums[s["loss"], s["l1"], s["c"], s["tol"], held].tolist()
            scores = [2 * a / (2 * a + b + c) if a + b + c else 0.0 for a, b, c in ((tp, fp, fn), (ttp, tfp, tfn))]
            out.append((text, int(held), *scores, distance))
    return df.sparkSession.createDataFrame(out, schema)


def tree_grid(leaves: Sequence[int] = tuple(range(1, 20)), depths: Sequence[int] = (5, 30)) -> list[dict]:
    return [{"min_leaf": m, "max_depth": d} for m in leaves for d in depths]


def learning_curve(
    train: DataFrame,
    test: DataFrame,
    fitter: Fitter,
    classes: Sequence,
    percents: Sequence[int] = tuple(range(10, 101, 10)),
    threads: int = 4,
) -> DataFrame:
    """(percent, train_error, test_error): misclassified rows over growing training prefixes."""
    subsets = prefix_subsets(train, percents=percents).persist()
    test = test.persist()

    def one(percent: int) -> tuple:
        rows = subsets.where(F.col("percent") == percent).drop("percent")
        score = fitter(rows, classes)
        errors = [mt.misclassification(score(part)).first().error for part in (rows, test)]
        return percent, *errors

    try:
        rows = in_parallel([lambda p=p: one(p) for p in percents], threads)
    finally:
        subsets.unpersist()
        test.unpersist()
    return train.sparkSession.createDataFrame(rows, "percent INT, train_error DOUBLE, test_error DOUBLE")


def feature_sweep(
    tables: Mapping[str, tuple[DataFrame, int, Mapping[str, np.ndarray]]], classes: Sequence, split: str = "split", c: float = 1.0,
    tol: float = 1e-4, max_passes: int = 500, threads: int = 4,
) -> DataFrame:
    """(family, class_id, average_precision, f1, distance) of one squared-hinge SVM a class and family.

    ``tables`` has for each name the rows (doc_id, label, fold, split, features), their width and the
    subsets of features to fit: a family's name to its 0/1 array, or to None for all features. The
    families of a table are fitted side by side.
    """

    def one(name: str) -> list[tuple]:
        rows, width, families = tables[name]
        masks = {k: v for k, v in families.items() if v is not None}
        problems = [lm.Problem(label, c=c, tolerances=(tol,), mask=k if k in masks else None) for k in families for label in range(len(classes))]
        train, test = rows.where(F.col(split) == "train"), rows.where(F.col(split) == "test")
        if "indices" in rows.columns and width > train.count():
            wide = wd.fit_wide(train, width, problems, masks, max_passes)
            scored, reached = wd.scored(test, wide), wide.reached
        else:
            fits = lm.fit_many(train, width, problems, masks, max_passes)
            scored, reached = lm.scored(test, width, fits), [float(f.reached[-1]) for f in fits]
        scored = staged(scored, "sweep-scores")
        scores = mt.average_precision(scored).join(mt.class_metrics(scored).select("class_id", "f1"), "class_id").collect()
        names = [(k, label) for k in families for label in range(len(classes))]
        return [(*names[r.class_id], r.average_precision, r.f1, reached[r.class_id]) for r in scores]

    parts = in_parallel([lambda n=n: one(n) for n in tables], threads)
    spark = next(iter(tables.values()))[0].sparkSession
    schema = "family STRING, class_id INT, average_precision DOUBLE, f1 DOUBLE, distance DOUBLE"
    return spark.createDataFrame(list(itertools.chain.from_iterable(parts)), schema)
