"""What several operators share: the learn/held-out split, Arrow passes, tables of tasks' rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presswork.plans.stage import staged

# lookups of at most so many narrow rows are broadcast; larger ones are salted shuffle joins
BROADCAST_ROWS = 100_000


def remainder(key: str, divisor: int) -> Column:
    """crc32 of the key written as text, modulo ``divisor``; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % divisor


def whole_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def kept_rows(docs: DataFrame, decided: DataFrame, key: str, told: Column) -> DataFrame:
    """``docs`` without the rows that ``decided`` drops; columns as given.

    ``decided`` has one row (key, print, kept) for each row of a group, ``told`` makes the print of
    a row of ``docs``. A row is known by key and print, where a null key equals a null key. Of rows
    that agree in both and of which one is kept, one stays: the first by all its columns as text.
    """
    pairs = decided.groupBy("key", "print").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    pairs = staged(pairs.where("n > 1 or not kept"), "decided")
    rows = docs.select(F.struct("*").alias("row"), F.col(key).alias("key"), told.alias("print"))

    def matched(some: DataFrame, how: str) -> DataFrame:
        other = some.select(F.col("key").alias("k"), F.col("print").alias("p"))
        if some.count() <= BROADCAST_ROWS:
            other = F.broadcast(other)
        return rows.join(other, F.col("key").eqNullSafe(F.col("k")) & (F.col("print") == F.col("p")), how)

    left = matched(pairs, "left_anti").select("row.*")
    repeated = pairs.where("kept")
    if repeated.isEmpty():
        return left
    one = matched(repeated, "left_semi").groupBy("key", "print").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return left.unionByName(one.select("row.*"))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def arrow_rows(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str) -> DataFrame:
    """``work`` yields dicts of equally long columns; they become the rows of ``schema``."""
    kinds = T._parse_datatype_string(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(kinds)
        for columns in work(batches):
            yield pa.RecordBatch.from_arrays(
                [_array(columns[field.name], field.type) for field in arrow], schema=arrow
            )

    return df.mapInArrow(run, kinds)


def add_columns(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], fields: str) -> DataFrame:
    """Append columns that ``work`` computes from each batch, in order; all old columns stay.

    A new name that ``df`` already has raises ``ValueError``.
    """
    added = T._parse_datatype_string(fields)
    clash = {f.name.lower() for f in added} & {c.lower() for c in df.columns}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are there already")
    whole = T.StructType([*df.schema.fields, *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(added)
        seen: list[pa.RecordBatch] = []

        def noted():
            for batch in batches:
                seen.append(batch)
                yield batch

        for columns in work(noted()):
            batch = seen.pop(0)
            arrays = [_array(columns[field.name], field.type) for field in arrow]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *arrays], names=[*batch.schema.names, *(f.name for f in arrow)]
            )

    return df.mapInArrow(run, whole)


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array):
        return values.cast(kind)
    if isinstance(values, np.ndarray) and values.dtype != object:
        return pa.array(values).cast(kind)
    return pa.array(values, type=kind)


def pieces(batch: pa.RecordBatch, name: str, limit: int = 1_000_000) -> Iterator[tuple[int, pa.Array]]:
    """Slices of a text column of about ``limit`` bytes each, as (first row, slice); a text is never cut."""
    yield from slices(batch.column(name), limit)


def slices(column: pa.Array, limit: int) -> Iterator[tuple[int, pa.Array]]:
    n = len(column)
    if not n:
        return
    ends = offsets(column)[1:]
    first, base = 0, int(offsets(column)[0])
    while first < n:
        last = int(np.searchsorted(ends, base + limit, side="right"))
        last = min(max(last, first + 1), n)
        yield first, column.slice(first, last - first)
        first, base = last, int(ends[last - 1])


def offsets(column: pa.Array) -> np.ndarray:
    """Byte offsets of a string column into its data buffer: one more than rows."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    raw = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    return raw[column.offset : column.offset + len(column) + 1].astype(np.int64)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column (a view) and each row's bounds in them; nulls are empty."""
    at = offsets(column)
    data = column.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
    return flat, at - at[0]


def sums_by_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between neighbouring bounds; empty ranges give 0."""
    total = np.empty(len(values) + 1, dtype=np.float64)
    total[0] = 0.0
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def unit_interval(x: np.ndarray) -> np.ndarray:
    """64-bit integers as numbers in (0, 1)."""
    return ((x >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52


def names_of(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} are missing")
    return list(wanted)
