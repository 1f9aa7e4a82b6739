"""Joins of a large table with a one-row-per-key table whose size is not known ahead."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# what a broadcast may hold: rows of (key, a few numbers), and their bytes
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 128 * 1024 * 1024
# beyond that: how many of the busiest keys are split, and into parts of how many rows
HEAVY_KEYS = 10_000
PART_ROWS = 100_000


def _width(field: T.StructField) -> Column:
    """Bytes of a value, about."""
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(field.name), F.lit(0)) + 16
    if isinstance(field.dataType, T.ArrayType):
        return F.coalesce(F.size(field.name), F.lit(0)) * 8 + 16
    return F.lit(8)


def fits_broadcast(keyed: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Is a staged table small enough to be broadcast, in rows and in bytes?"""
    if rows <= 0:
        return False
    count = keyed.count()  # from the files' footers
    if count > rows:
        return False
    width = sum((_width(f) for f in keyed.schema.fields), F.lit(0))
    return count == 0 or keyed.agg(F.sum(width)).first()[0] <= size


def lookup_join(
    big: DataFrame,
    keyed: DataFrame,
    key: str,
    how: str = "inner",
    *,
    weight: str,
    broadcast_rows: int | None = None,
    heavy_keys: int = HEAVY_KEYS,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Join ``big`` with a staged table holding one row per ``key``.

    ``keyed`` is measured first. Within ``broadcast_rows`` and ``BROADCAST_BYTES`` it is
    broadcast and ``big`` does not move. Beyond that it is a shuffle join in which
    the ``heavy_keys`` keys with the largest ``weight`` (rows expected in ``big``)
    are split: a key of n rows goes to n / ``part_rows`` parts, its lookup row is
    repeated for each, and its rows of ``big`` are dealt over them by hash. The
    list of heavy keys is broadcast; its length is the bound.
    """
    limit = BROADCAST_ROWS if broadcast_rows is None else broadcast_rows
    if fits_broadcast(keyed, limit):
        return big.join(F.broadcast(keyed), key, how)
    parts = F.ceil(F.col(weight) / part_rows).cast("int").alias("_parts")
    heavy = keyed.orderBy(F.desc(weight), key).limit(heavy_keys).select(key, parts).where("_parts > 1")
    part = F.when(F.col("_parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*big.columns), "_parts").cast("int"))
    dealt = big.join(F.broadcast(heavy), key, "left").withColumn("_part", part).drop("_parts")
    every = F.when(F.col("_parts").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("_parts") - 1))
    copies = keyed.join(F.broadcast(heavy), key, "left").withColumn("_part", F.explode(every)).drop("_parts")
    return dealt.join(copies, [key, "_part"], how).drop("_part")
