"""Scores of predictions held as a long table (doc_id, class_id, y, score, pred).

``y`` and ``pred`` are 0/1. All counts are conditional sums, so every metric is
one aggregation with partial results, whatever the size of a class.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.functions.numbers import ratio, round_even
from presswork.plans import running_sums, staged


def outcome_counts(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn per group (or over all pairs)."""

    def total(y: int, pred: int) -> Column:
        return F.count_if((F.col("y") == y) & (F.col("pred") == pred))

    return scored.groupBy(*by).agg(
        total(1, 1).alias("tp"), total(0, 1).alias("fp"), total(1, 0).alias("fn"), total(0, 0).alias("tn")
    )


def precision() -> Column:
    return ratio(F.col("tp"), F.col("tp") + F.col("fp"))


def recall() -> Column:
    return ratio(F.col("tp"), F.col("tp") + F.col("fn"))


def f1() -> Column:
    return ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))


def accuracy() -> Column:
    return ratio(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))


def hard_roc_auc() -> Column:
    """Area under the one-point curve of hard predictions."""
    return (recall() + ratio(F.col("tn"), F.col("tn") + F.col("fp"))) / 2


def mcc() -> Column:
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    bottom = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    return F.when(bottom == 0, 0.0).otherwise((tp * tn - fp * fn) / bottom)


def class_metrics(scored: DataFrame) -> DataFrame:
    """precision, recall, f1, accuracy and mcc per class."""
    counts = outcome_counts(scored, ["class_id"])
    return counts.select(
        "class_id",
        precision().alias("precision"),
        recall().alias("recall"),
        f1().alias("f1"),
        accuracy().alias("accuracy"),
        mcc().alias("mcc"),
    )


def micro_metrics(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Micro precision, recall, F1 and ROC AUC of the hard predictions."""
    return outcome_counts(scored, by).select(
        *by,
        precision().alias("precision"),
        recall().alias("recall"),
        f1().alias("f1"),
        hard_roc_auc().alias("roc_auc"),
    )


def long_metrics(metrics: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """(keys..., metric, value), one row per metric."""
    pairs = F.array(*[F.struct(F.lit(f"test_{n}").alias("metric"), F.col(n).alias("value")) for n in names])
    return metrics.select(*keys, F.inline(pairs))


def tally(scored: DataFrame) -> DataFrame:
    """Staged (class_id, score, pred, hits, cases): all that curves and counts need, in one pass."""
    grouped = scored.groupBy("class_id", "score", "pred")
    return staged(grouped.agg(F.sum("y").alias("hits"), F.count(F.lit(1)).alias("cases")), "tally")


def _curve_steps(tallied: DataFrame, by: str | None) -> DataFrame:
    """Cumulative true positives and cases per distinct score, highest first.

    Equal scores are merged before the ordered pass, which itself runs per
    range partition with offsets, so no class ends up in a single task.
    """
    keys = [by] if by else []
    steps = tallied.groupBy(*keys, "score").agg(F.sum("hits").alias("hits"), F.sum("cases").alias("cases"))
    return _with_positives(running_sums(steps, [F.desc("score")], {"tp": "hits", "seen": "cases"}, by=by), tallied, by)


def _with_positives(steps: DataFrame, tallied: DataFrame, by: str | None) -> DataFrame:
    positives = tallied.groupBy(*([by] if by else [])).agg(F.sum("hits").alias("positives"))
    if by:
        return steps.join(F.broadcast(positives), by)  # one row per class
    return steps.withColumn("positives", positives.scalar())


def pr_curve(scored: DataFrame, by: str | None = "class_id") -> DataFrame:
    """Precision and recall at every threshold until recall is full."""
    steps = _curve_steps(tally(scored), by)
    kept = steps.where(F.col("tp") - F.col("hits") < F.col("positives"))
    keys = [by] if by else []
    return kept.select(
        *keys,
        F.col("score").alias("threshold"),
        ratio(F.col("tp"), F.col("seen")).alias("precision"),
        ratio(F.col("tp"), F.col("positives")).alias("recall"),
    )


def average_precision(scored: DataFrame, by: str | None = "class_id") -> DataFrame:
    """Sum of precision times recall step; equal scores are one step."""
    return _areas(tally(scored), by)


def _areas(tallied: DataFrame, by: str | None) -> DataFrame:
    steps = _curve_steps(tallied, by)
    area = F.sum(ratio(F.col("hits"), F.col("positives")) * ratio(F.col("tp"), F.col("seen")))
    return steps.groupBy(*([by] if by else [])).agg(area.alias("average_precision"))


def score_sheet(scored: DataFrame, algo: str) -> DataFrame:
    """Long score sheet (algo, class_id, metric, value): per class and micro, 3 digits.

    The micro value of MCC is the mean over the classes.
    """
    tallied = tally(scored)
    # a tallied row is a number of cases with the same prediction
    yes, hits, misses = F.col("pred") == 1, F.col("hits"), F.col("cases") - F.col("hits")
    cells = {"tp": F.when(yes, hits), "fp": F.when(yes, misses), "fn": F.when(~yes, hits), "tn": F.when(~yes, misses)}
    sums = [F.coalesce(F.sum(cell), F.lit(0)).cast("double").alias(name) for name, cell in cells.items()]
    per_class = tallied.groupBy("class_id").agg(*sums).select(
        F.col("class_id").cast("string").alias("class_id"), f1().alias("f1"), mcc().alias("mcc")
    )
    counts = tallied.agg(*sums).select(f1().alias("f1"))
    micro = counts.select(
        F.lit("micro").alias("class_id"), "f1", per_class.agg(F.avg("mcc")).scalar().alias("mcc")
    )
    pairs = F.array(
        F.struct(F.lit("F1").alias("metric"), F.col("f1").alias("value")),
        F.struct(F.lit("MCC").alias("metric"), F.col("mcc").alias("value")),
    )
    hard = per_class.unionByName(micro).select("class_id", F.inline(pairs))
    areas = _areas(tallied, "class_id").select(
        F.col("class_id").cast("string").alias("class_id"), F.col("average_precision").alias("value")
    )
    total = _areas(tallied, None).select(
        F.lit("micro").alias("class_id"), F.col("average_precision").alias("value")
    )
    curves = areas.unionByName(total).withColumn("metric", F.lit("P-R"))
    sheet = hard.unionByName(curves)
    return sheet.select(F.lit(algo).alias("algo"), "class_id", "metric", round_even(F.col("value"), 3).alias("value"))


def wide_sheet(sheet: DataFrame, classes: Sequence[str] = ("0", "1", "2", "3", "micro")) -> DataFrame:
    """One row per algorithm with columns such as ``F1 0`` or ``P-R micro``."""
    names = [f"{m} {c}" for c in classes for m in ("P-R", "F1", "MCC")]
    named = sheet.withColumn("name", F.concat_ws(" ", "metric", "class_id"))
    return named.groupBy("algo").pivot("name", names).agg(F.first("value"))


def first_positive(scored: DataFrame) -> DataFrame:
    """(doc_id, actual, predicted): first class with a 1, class 0 where there is none."""

    def first(column: str) -> Column:
        return F.coalesce(F.min(F.when(F.col(column) == 1, F.col("class_id"))), F.lit(0))

    return scored.groupBy("doc_id").agg(first("y").alias("actual"), first("pred").alias("predicted"))


def best_class(scored: DataFrame) -> DataFrame:
    """(doc_id, actual, predicted) by highest score; the lower class wins a tie."""
    best = F.min(F.struct((-F.col("score")).alias("s"), F.col("class_id").alias("c")))["c"]
    actual = F.coalesce(F.min(F.when(F.col("y") == 1, F.col("class_id"))), F.lit(0))
    return scored.groupBy("doc_id").agg(actual.alias("actual"), best.alias("predicted"))


def confusion_matrix(pairs: DataFrame, classes: Sequence[int]) -> DataFrame:
    """One row per actual class, one column ``p<class>`` per predicted class."""
    cells = [F.count_if(F.col("predicted") == c).alias(f"p{c}") for c in classes]
    return pairs.groupBy("actual").agg(*cells)


def misclassification(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of documents whose 0/1 row is not predicted exactly."""
    wrong = F.max((F.col("y") != F.col("pred")).cast("int")).alias("wrong")
    return scored.groupBy(*by, "doc_id").agg(wrong).groupBy(*by).agg(F.avg("wrong").alias("error"))
