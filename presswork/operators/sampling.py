"""Seeded samples, folds and growing prefixes; all by key, so repeatable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.plans import global_rank


def sample_order(key: str | Column, seed: int = 123) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def sample_n(df: DataFrame, n: int, seed: int = 123, key: str = "doc_id") -> DataFrame:
    """``n`` rows without replacement: the smallest seeded hashes of the key."""
    return df.orderBy(sample_order(key, seed), key).limit(n)


def assign_folds(df: DataFrame, k: int = 5, order: str = "doc_id") -> DataFrame:
    """Unshuffled k-fold numbers over row order; the first n mod k folds have one row more."""
    ranked = global_rank(df, [order], "_rank", total="_total")
    base = F.floor(F.col("_total") / k)
    longer = F.col("_total") % k
    row = F.col("_rank") - 1
    in_longer = longer * (base + 1)
    fold = F.when(row < in_longer, F.floor(row / (base + 1))).otherwise(
        longer + F.floor((row - in_longer) / base)
    )
    return ranked.withColumn("fold", fold.cast("int")).drop("_rank", "_total")


def prefix_subsets(
    df: DataFrame,
    order: str = "doc_id",
    percents: Sequence[int] = tuple(range(10, 101, 10)),
) -> DataFrame:
    """First p % of the rows for every p, as one table with a ``percent`` column."""
    ranked = global_rank(df, [order], "_rank", total="_total")
    keep = F.filter(
        F.array(*[F.lit(p) for p in percents]),
        lambda p: F.col("_rank") <= F.floor(F.col("_total") * p / 100),
    )
    return ranked.withColumn("percent", F.explode(keep)).drop("_rank", "_total")
