"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Vectors are rounded to a lattice of integers, so that counts, sums and deviations are exact. The
covariance of the distinct ones is never formed: a pass over their blocks gives the product of the
covariance with a thin matrix, each vector centred before it is multiplied. A round filters a block
of directions by a Chebyshev polynomial in the covariance, whose recurrence takes one pass a
degree; it is small on the interval below the block's smallest Ritz value, the unwanted spectrum,
and grows fast above. QR and Rayleigh-Ritz follow, until the residuals of the wanted pairs certify
them. The interval's lower end comes from a few Lanczos steps; a wrong one costs rounds, not accuracy.

The driver holds matrices of dimensions x block only; sums of tasks are added up in as many lanes
as the square root of the number of blocks.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import ceil, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.llm.shared import arrow_rows, names_of
from presswork.plans.stage import staged

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
GUARD = 16  # directions of the block beyond the wanted ones
DEGREE = 12  # of the filter, at most
GROWTH = 1e8  # of the strongest direction in a filter, at most: more drowns the others in rounding
LANCZOS = 10
TIGHT, CERTIFIED = 1e-14, 1e-10  # a pair's residual over its eigenvalue: aimed at, and asked for
FLOOR = 1e-4  # smaller eigenvalues count as this share of the first: rounding is of its size
ROUNDS = 40  # without a certificate the block doubles; one of all dimensions is exact
BLOCK = 1 << 18  # entries of a block of vectors
STEP = 1 << 20  # entries of vectors whitened at a time
RANK = 1e-12  # components with less variance than this share of the first have none
LANES = 64  # sums of so many tasks go straight to the driver


@dataclass(frozen=True)
class Whitening:
    """n vectors with integer sums per dimension, and components as columns with their eigenvalues."""

    n: int
    sums: list[int]
    directions: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float

    @property
    def dimensions(self) -> int:
        return len(self.sums)


def finite(vector: str) -> Column:
    """Is a vector neither null nor empty, and without null, infinite or not-a-number entries?"""
    good = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(good & (F.size(vector) > 0), F.lit(False))


def lattice(vectors: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """All columns of the rows with a finite vector, and ``_x``: floor(scale * entry), without the offset."""
    if "_x" in vectors.columns:
        raise ValueError("column '_x' is there already")
    whole = F.transform(vector, lambda c: F.floor(c.cast("double") * scale))
    return vectors.where(finite(vector)).withColumn("_x", whole)


def usual_length(rows: DataFrame) -> int:
    """The most frequent number of entries, the smaller of equally frequent ones; 0 without rows."""
    lengths = rows.groupBy(F.size("_x").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return lengths[0].d if lengths else 0


def matrix_of(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def packed(rows: DataFrame, d: int) -> DataFrame:
    """Staged (block): the distinct vectors as blocks of 64-bit integers."""

    def work(batches):
        held, n = [], 0
        for batch in batches:
            if len(batch):
                held.append(matrix_of(batch.column(0), d))
                n += len(batch)
            if n * d >= BLOCK:
                yield {"block": [np.concatenate(held).tobytes()]}
                held, n = [], 0
        if n:
            yield {"block": [np.concatenate(held).tobytes()]}

    return staged(arrow_rows(rows.select("_x").distinct(), work, "block binary"), "lattice-blocks")


def added_up(blocks: DataFrame, count: int, work: Callable[[np.ndarray], np.ndarray], d: int, kind: type) -> np.ndarray:
    """Sum of ``work`` over all blocks: a partial sum for each task, added up in lanes, in a fixed order."""
    lanes = max(LANES, isqrt(count))

    def run(batches):
        from pyspark import TaskContext

        total = None
        for batch in batches:
            for raw in batch.column("block"):
                part = work(np.frombuffer(raw.as_buffer(), np.int64).reshape(-1, d))
                total = part if total is None else total + part
        if total is not None:
            task = TaskContext.get().partitionId()
            yield {"lane": [task % lanes], "task": [task], "value": [total.tobytes()]}

    def add(some: pa.Table) -> pa.Table:
        some = some.sort_by("task")
        total = sum(np.frombuffer(v.as_buffer(), kind) for v in some.column("value"))
        return pa.table({"lane": some.column("lane").slice(0, 1), "task": some.column("task").slice(0, 1), "value": pa.array([total.tobytes()], pa.binary())})

    parts = arrow_rows(blocks, run, "lane int, task int, value binary")
    if count > lanes:
        parts = parts.groupBy("lane").applyInArrow(add, parts.schema)
    return sum(np.frombuffer(v, kind) for v in parts.toArrow().sort_by("task").column("value").to_pylist())


class Covariance:
    """The covariance of the packed vectors as an operator: each product is a pass over them."""

    def __init__(self, blocks: DataFrame, d: int):
        self.blocks, self.d, self.count = blocks, d, blocks.count()
        self.spark = blocks.sparkSession
        moments = self._sum(lambda x: np.append(x.sum(axis=0), len(x)), np.int64)
        self.sums, self.n = [int(s) for s in moments[:-1]], int(moments[-1])
        self.whole, self.rest = centre(self.sums, self.n)
        whole, rest = self.whole, self.rest
        self.trace = float(self._sum(lambda x: np.array([(centred(x, whole, rest) ** 2).sum()]), np.float64)[0]) / self.n

    def _sum(self, work, kind) -> np.ndarray:
        return added_up(self.blocks, self.count, work, self.d, kind)

    def times(self, thin: np.ndarray) -> np.ndarray:
        """The product with a matrix of few columns."""
        shared, whole, rest = self.spark.sparkContext.broadcast(thin), self.whole, self.rest

        def work(x):
            c = centred(x, whole, rest)
            return c.T @ (c @ shared.value)

        made = self._sum(work, np.float64).reshape(thin.shape) / self.n
        shared.unpersist()
        return made

    def gram(self, thin: np.ndarray) -> np.ndarray:
        """Covariance of the vectors projected on the columns."""
        shared, whole, rest = self.spark.sparkContext.broadcast(thin), self.whole, self.rest

        def work(x):
            z = centred(x, whole, rest) @ shared.value
            return z.T @ z

        made = self._sum(work, np.float64).reshape(thin.shape[1], -1) / self.n
        shared.unpersist()
        return made


def centre(sums: list[int], n: int) -> tuple[np.ndarray, np.ndarray]:
    """The mean as a whole part and a rest below 1, so that vectors are centred without rounding of large sums."""
    return np.array([s // n for s in sums], np.int64), np.array([(s % n) / n for s in sums])


def centred(x: np.ndarray, whole: np.ndarray, rest: np.ndarray) -> np.ndarray:
    return (x - whole).astype(np.float64) - rest


def lower_end(v: Covariance, steps: int, rng: np.random.Generator) -> float:
    """An estimate of the smallest eigenvalue from Lanczos steps, each made orthogonal to all before."""
    basis = [_unit(rng.standard_normal(v.d))]
    images = []
    for _ in range(min(steps, v.d)):
        images.append(v.times(basis[-1][:, None])[:, 0])
        rest = images[-1].copy()
        for _ in range(2):
            for b in basis:
                rest -= (b @ rest) * b
        norm = np.linalg.norm(rest)
        if norm <= 1e-12 * max(np.linalg.norm(images[-1]), 1e-300):
            break
        basis.append(rest / norm)
    q, y = np.column_stack(basis[: len(images)]), np.column_stack(images)
    values, turns = np.linalg.eigh((q.T @ y + y.T @ q) / 2)
    off = np.linalg.norm(y @ turns[:, 0] - q @ turns[:, 0] * values[0])
    return max(0.0, float(values[0] - off))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x)


def degree_for(low: float, high: float, top: float) -> int:
    """The largest degree at which the polynomial grows by no more than ``GROWTH`` up to ``top``."""
    if high <= low or top <= high:
        return 1
    t = (2 * top - low - high) / (high - low)
    return int(min(DEGREE, max(1, np.log(2 * GROWTH) // np.arccosh(t))))


def filtered(v: Covariance, q: np.ndarray, first: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial of [low, high] in the covariance, scaled to 1 at ``top``, times ``q``.

    ``first`` is the product of the covariance with ``q``, known from Rayleigh-Ritz.
    """
    middle, half = (high + low) / 2, max((high - low) / 2, 1e-300)
    start = sigma = half / (top - middle)
    older, newer = q, (first - middle * q) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / start - sigma)
        newer, older = (v.times(newer) - middle * newer) * (2 * after / half) - sigma * after * older, newer
        sigma = after
    return newer


def ritz(v: Covariance, block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values in falling order, their vectors, and the covariance times these."""
    q, _ = np.linalg.qr(block)
    q, _ = np.linalg.qr(q)
    y = v.times(q)
    values, turns = np.linalg.eigh((q.T @ y + y.T @ q) / 2)
    turns = turns[:, ::-1]
    return values[::-1], q @ turns, y @ turns


def leading_pairs(v: Covariance, wanted: int, guard: int = GUARD, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and unit eigenvectors as columns."""
    rng = np.random.default_rng(seed)
    wanted = min(wanted, v.d)
    size = min(v.d, wanted + guard)
    low = lower_end(v, LANCZOS, rng) if size < v.d else 0.0
    values, q, y = ritz(v, rng.standard_normal((v.d, size)))
    best, rounds = np.inf, 0
    while True:
        size_of = np.maximum(values[:wanted], max(FLOOR * values[0], 1e-300))
        off = (np.linalg.norm(y - q * values, axis=0)[:wanted] / size_of).max()
        if off <= TIGHT or size == v.d or (off <= CERTIFIED and off > best / 2):
            return values[:wanted], q[:, :wanted]
        best, rounds = min(best, off), rounds + 1
        if rounds % ROUNDS == 0:
            size = min(v.d, 2 * size)
            block = np.column_stack([q, rng.standard_normal((v.d, size - q.shape[1]))])
            best = np.inf
        else:
            high = max(values[-1], low)
            block = filtered(v, q, y, low, high, values[0], degree_for(low, high, values[0])) if values[0] > high else y
        values, q, y = ritz(v, block)


def jacobi(h: np.ndarray, sweeps: int = 30) -> np.ndarray:
    """Rotation that makes a positive matrix diagonal, each entry small against its own row and column.

    Unlike a dense solver it loses no accuracy where eigenvalues differ by many orders.
    """
    h, turn = h.copy(), np.eye(len(h))
    for _ in range(sweeps):
        done = True
        for i in range(len(h)):
            for j in range(i):
                if abs(h[i, j]) <= 1e-15 * np.sqrt(h[i, i] * h[j, j]):
                    continue
                done = False
                t = (h[j, j] - h[i, i]) / (2 * h[i, j])
                t = (1.0 if t >= 0 else -1.0) / (abs(t) + np.hypot(1, t))
                c = 1 / np.hypot(1, t)
                r = np.array([[c, t * c], [-t * c, c]])
                at = [i, j]
                h[:, at] = h[:, at] @ r
                h[at] = r.T @ h[at]
                turn[:, at] = turn[:, at] @ r
        if done:
            break
    return turn


def polished(v: Covariance, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit directions after a Rayleigh-Ritz step on projected vectors, whose
    covariance is accurate for each pair of directions by itself."""
    h = v.gram(q)
    turn = jacobi(h)
    values = np.diag(turn.T @ h @ turn)
    order = np.argsort(-values, kind="stable")
    q = q @ turn[:, order]
    return values[order], q / np.linalg.norm(q, axis=0)


def fit(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> Whitening:
    """Whitening from each distinct lattice vector (floor(scale * entry) + offset) once.

    Vectors that are null or empty or have null or non-finite entries take no part, nor do those of
    another length than the most frequent one. Components without variance are left out, so a
    single distinct vector or an empty table gives none; repeated rows and ties change nothing.
    """
    names_of(vectors, [vector])
    rows = lattice(vectors.select(vector), vector, scale)
    d = usual_length(rows)
    if not d:
        return Whitening(0, [], np.empty((0, 0)), np.empty(0), 0.0, 0.0)
    v = Covariance(packed(rows.where(F.size("_x") == d), d), d)
    sums = [s + offset * v.n for s in v.sums]
    if v.trace == 0:
        return Whitening(v.n, sums, np.empty((d, 0)), np.empty(0), 0.0, 0.0)
    values, q = leading_pairs(v, components)
    there = values > RANK * values[0]
    values, q = polished(v, q[:, there])
    q = q * np.sign(q[np.abs(q).argmax(axis=0), np.arange(q.shape[1])])
    error = np.abs(v.gram(q / np.sqrt(values)) - np.eye(len(values))).max()
    return Whitening(v.n, sums, q, values, v.trace, float(error))


def deviations(x: np.ndarray, whole: np.ndarray, rest: np.ndarray, n: int) -> pa.Array:
    """Sum over dimensions of (n x - S)^2, exact; null where it does not fit 64 bits."""
    about = n * np.linalg.norm((x - whole).astype(np.float64) - rest / n, axis=1)
    if len(x) == 0 or about.max() < 2.0**31:
        return pa.array((((x - whole) * n - rest) ** 2).sum(axis=1))
    exact = [sum((n * (a - w) - r) ** 2 for a, w, r in zip(row, whole.tolist(), rest.tolist(), strict=True)) for row in x.tolist()]
    return pa.array([e if e < 2**63 else None for e in exact], pa.int64())


def whiten(vectors: DataFrame, model: Whitening, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """One row for each row with a usable vector and each component: key, component (from 1), n,
    deviation, whitened, explained, identity_error.

    Rows left out are those that ``fit`` leaves out. Repeated rows and null keys give rows of their
    own; other columns are not carried, so none can clash. Without components there are no rows.
    """
    names_of(vectors, [key, vector])
    d, k = model.dimensions, len(model.eigenvalues)
    rows = lattice(vectors.select(F.col(key).alias("_key"), F.col(vector).alias("_vector")), "_vector", scale)
    rows = rows.where(F.size("_x") == d).select("_key", "_x")
    if not k:
        rows = rows.limit(0)
    sums = [s - offset * model.n for s in model.sums]
    whole, part = centre(sums, model.n) if model.n else (np.empty(0, np.int64), np.empty(0))
    rest = np.array([s % model.n for s in sums] if model.n else [], np.int64)
    shared = vectors.sparkSession.sparkContext.broadcast(model.directions / np.sqrt(model.eigenvalues) if k else None)
    explained = model.eigenvalues / model.trace if k else np.empty(0)

    def work(batches):
        for batch in batches:
            for first in range(0, len(batch), max(1, STEP // d)):
                some = batch.slice(first, max(1, STEP // d))
                x = matrix_of(some.column("_x"), d)
                z = centred(x, whole, part) @ shared.value
                at = pa.array(np.repeat(np.arange(len(x)), k))
                yield {
                    key: some.column("_key").take(at),
                    "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)),
                    "n": np.full(len(x) * k, model.n),
                    "deviation": deviations(x, whole, rest, model.n).take(at),
                    "whitened": z.reshape(-1),
                    "explained": np.tile(explained, len(x)),
                    "identity_error": np.full(len(x) * k, model.identity_error),
                }

    kind = vectors.schema[key].dataType.simpleString()
    return arrow_rows(rows, work, f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
