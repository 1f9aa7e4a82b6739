"""Choosing terms by their ANOVA F score against the category."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.plans import global_rank, lookup_join, staged

# values are summed as whole hundredths, so that sums do not depend on their order
SCALE = 100
# a within-class spread below this share of the total is rounding noise
NOISE = 1e-9


def class_sizes(docs: DataFrame, category: str = "category") -> dict[int, int]:
    """Documents per class; one row per class comes back."""
    rows = docs.where(F.col(category).isNotNull()).groupBy(category).count().collect()
    return {row[0]: row[1] for row in sorted(rows)}


def anova_f(terms: DataFrame, sizes: dict[int, int], value: str = "n", category: str = "category") -> DataFrame:
    """(term, f_score, total) from sums per term and class; absent cells are zeros.

    One aggregation by term with partial sums: nothing but (term, sums) moves.
    A constant term has no score (null); a term that separates the classes
    perfectly scores infinity.
    """
    whole = F.rint(F.col(value) * SCALE).cast("bigint")
    sums = [F.sum(F.when(F.col(category) == c, F.col("_v")).otherwise(0)).alias(f"s{i}") for i, c in enumerate(sizes)]
    squares = F.sum(F.col("_v") * F.col("_v")).alias("q")
    grouped = terms.withColumn("_v", whole).groupBy("term").agg(*sums, squares)
    n, k = sum(sizes.values()), len(sizes)

    def as_value(name: str):
        return F.col(name).cast("double") / SCALE

    class_part = sum(
        (as_value(f"s{i}") * as_value(f"s{i}") / size for i, size in enumerate(sizes.values())), F.lit(0.0)
    )
    total = sum((F.col(f"s{i}") for i in range(k)), F.lit(0)).cast("double") / SCALE
    q = F.col("q").cast("double") / (SCALE * SCALE)
    parts = grouped.select("term", total.alias("total"), class_part.alias("c"), q.alias("q"))
    between = F.col("c") - F.col("total") * F.col("total") / n
    within = F.col("q") - F.col("c")
    noise = F.lit(NOISE) * F.col("q")
    score = (
        F.when((within <= noise) & (between <= noise), F.lit(None).cast("double"))
        .when(within <= noise, F.lit(float("inf")))
        .otherwise((between / (k - 1)) / (within / (n - k)))
    )
    return parts.select("term", score.alias("f_score"), "total")


def select_percentiles(scores: DataFrame, percents: Sequence[int] = (10, 25, 50, 75)) -> DataFrame:
    """(percent, term, f_score, total, rank): the best p % of the terms for every p.

    Order: score (to 9 digits) descending, then term; the first floor(n * p / 100) stay.
    """
    ranked = global_rank(
        scores.withColumn("_s", F.round("f_score", 9)), [F.desc_nulls_last("_s"), "term"], "rank", total="_total"
    )
    kept = F.filter(
        F.array(*[F.lit(p) for p in percents]), lambda p: F.col("rank") <= F.floor(F.col("_total") * p / 100)
    )
    return ranked.select(F.explode(kept).alias("percent"), "term", "f_score", "total", "rank")


def keep_terms(terms: DataFrame, selected: DataFrame) -> DataFrame:
    """The cells of the selected terms, once for every percent that selected them.

    Terms are grouped to one row with the list of their percents, so that the
    term table is read and joined once.
    """
    lists = selected.groupBy("term").agg(
        F.array_sort(F.collect_list("percent")).alias("_percents"), F.max("total").alias("_total")
    )
    found = lookup_join(terms, staged(lists, "selected"), "term", weight="_total")
    return found.select(F.explode("_percents").alias("percent"), *terms.columns)


def select_features(
    cells: DataFrame,
    sizes: dict[int, int],
    value: str = "n",
    percents: Sequence[int] = (10, 25, 50, 75),
    fit_on: str = "split = 'train'",
) -> DataFrame:
    """Score on the fitting split, keep the best terms of every percentile in all splits.

    The cells are staged: they are read twice, and tokenising twice costs more.
    """
    cells = staged(cells, "cells")
    scores = anova_f(cells.where(fit_on), sizes, value)
    return keep_terms(cells, select_percentiles(scores, percents))
