"""Ranks and running sums over a total order, without a one-partition window.

The rows are range-sorted once and staged with their place
(partition number, row number). Everything that crosses a partition border is
then carried by a table with one row per sorted partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presswork.plans.stage import staged

# monotonically_increasing_id keeps the row number in the low 33 bits
_ROW_BITS = 33


def _placed(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    place = F.monotonically_increasing_id()
    return staged(df.orderBy(*order).withColumn("_row_place", place), "sorted").withColumn(
        "_row_part", F.shiftright("_row_place", _ROW_BITS)
    )


def global_rank(
    df: DataFrame,
    order: Sequence[Column | str],
    name: str = "rank",
    total: str | None = None,
) -> DataFrame:
    """1-based position of each row in ``order``; ``total`` also adds the row count.

    ``order`` should end in a unique key so that the result is fixed.
    """
    placed = _placed(df, order)
    per_part = placed.groupBy("_row_part").agg(F.count(F.lit(1)).alias("_rows_in_part"))
    before = Window.orderBy("_row_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(
        "_row_part",
        F.coalesce(F.sum("_rows_in_part").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_rows_in_part").over(Window.partitionBy()).alias("_rows_in_all"),
    )
    row = F.col("_row_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    ranked = placed.join(F.broadcast(offsets), "_row_part").withColumn(name, F.col("_rows_before") + row + 1)
    if total:
        ranked = ranked.withColumn(total, F.col("_rows_in_all"))
    return ranked.drop("_row_part", "_row_place", "_rows_before", "_rows_in_all")


def running_sums(
    df: DataFrame,
    order: Sequence[Column | str],
    sums: dict[str, str],
    by: str | None = None,
) -> DataFrame:
    """Running totals of integer columns in ``order``, restarted for every ``by`` value.

    ``sums`` maps a new column to the summed one. ``by`` must have few values
    (classes): the border table has one row per sorted partition and value.
    """
    keys = [by] if by else []
    placed = _placed(df, [*keys, *order])
    per_part = placed.groupBy(*keys, "_row_part").agg(
        *[F.sum(source).alias(f"_sum_{new}") for new, source in sums.items()]
    )
    before = Window.partitionBy(*keys).orderBy("_row_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(
        *keys,
        "_row_part",
        *[F.coalesce(F.sum(f"_sum_{new}").over(before), F.lit(0)).alias(f"_before_{new}") for new in sums],
    )
    inside = (
        Window.partitionBy(*keys, "_row_part")
        .orderBy("_row_place")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        placed.join(F.broadcast(offsets), [*keys, "_row_part"])
        .select(
            "*",
            *[(F.sum(source).over(inside) + F.col(f"_before_{new}")).alias(new) for new, source in sums.items()],
        )
        .drop("_row_part", "_row_place", *[f"_before_{new}" for new in sums])
    )
