"""Sums of arrays that tasks compute, added up without a task or the driver holding all of them.

A task adds up what it makes of its batches. Its sum is cut into parts of bounded size; parts of the
same place are added in lanes of tasks, and the driver gets one row for each part and lane, or, of
large sums, one for each part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

PART = 1 << 20  # numbers of a part
LANES = 16  # rows of a part that reach the driver, at most; one of large sums
DIRECT = 32 << 20  # sums of so many bytes together go straight to the driver

SCHEMA = "part int, lane int, task int, value binary"


def array_sums(rows: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], size: int, tasks: int, kind: type = np.float64) -> np.ndarray:
    """The sum of all arrays of ``size`` float64 that ``work`` yields; ``tasks`` bounds the number of tasks.

    Sums are added in the order of tasks, so reruns over the same files agree. They are added as
    float64 and travel as ``kind``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for made in work(batches):
            total = made if total is None else total + made
        if total is None:
            return
        task = TaskContext.get().partitionId()
        for part in range(0, size, PART):
            value = total[part : part + PART].astype(kind).tobytes()
            columns = [pa.array([part // PART], pa.int32()), pa.array([task % LANES], pa.int32()), pa.array([task], pa.int32()), pa.array([value])]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "lane", "task", "value"])

    def add(some: pa.Table) -> pa.Table:
        some = some.sort_by([("lane", "ascending"), ("task", "ascending")])
        total = sum(np.frombuffer(v.as_buffer(), kind).astype(np.float64) for v in some.column("value"))
        return pa.table({**{c: some.column(c).slice(0, 1) for c in ("part", "lane", "task")}, "value": pa.array([total.astype(kind).tobytes()], pa.binary())})

    parts, width = rows.mapInArrow(run, SCHEMA), np.dtype(kind).itemsize
    if tasks > LANES:  # of fewer, a lane has one row of a part already
        parts = parts.groupBy("part", "lane").applyInArrow(add, SCHEMA)
    if min(tasks, LANES) * size * width > DIRECT:  # lanes, too, would be many times the sum
        parts = parts.groupBy("part").applyInArrow(add, SCHEMA)
    found = parts.toArrow().sort_by([("part", "ascending"), ("lane", "ascending"), ("task", "ascending")])
    total = np.zeros(size)
    for part, value in zip(found.column("part").to_pylist(), found.column("value"), strict=True):
        made = np.frombuffer(value.as_buffer(), kind)
        total[part * PART : part * PART + len(made)] += made
    return total
