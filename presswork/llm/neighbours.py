"""Approximate nearest neighbours by shifted space-filling curves.

Vectors are projected at random to a few dimensions, shifted, cut into a grid and numbered along a
Hilbert curve; several projections give several orders of all vectors. Each order is range-sorted
by Spark and ranked. A query looks at the vectors within a window of ranks around its own on every
curve: ranks are dealt into blocks of equal size, so vectors that are alike or equal in great
numbers fill many blocks. Each block gives a query's nearest of its window by the exact distance on
the original vectors, and the nearest of all blocks and curves are merged.

Equal vectors are one point with its smallest ids. The window is a share of all points: on data
without structure, as random directions in many dimensions, neighbours lie scattered over any
order, and a fixed window would find ever fewer of them as the table grows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presswork.llm.shared import add_columns, names_of
from presswork.plans.ordering import global_rank
from presswork.plans.stage import staged

CURVES = 12
DIMENSIONS = 8
BITS = 4
WINDOW = 0.1  # share of all points around a query, on each curve
LEAST_WINDOW = 256  # points on either side, at least
BLOCK = 2048
NEAREST = 10
RANGE_SAMPLE = 4096


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each grid cell (a row of coordinates below 2^bits) on the Hilbert curve.

    Coordinates are turned into the transposed index axis by axis (Skilling, 2004), then interleaved.
    """
    x = cells.astype(np.uint64).T.copy()
    n = len(x)
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        high, low = one << np.uint64(level), (one << np.uint64(level)) - one
        for axis in range(n):
            set_ = (x[axis] & high) != 0
            swap = np.where(set_, np.uint64(0), (x[0] ^ x[axis]) & low)
            x[0] ^= np.where(set_, low, swap)
            if axis:
                x[axis] ^= swap
    for axis in range(1, n):
        x[axis] ^= x[axis - 1]
    flip = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, 0, -1):
        high = one << np.uint64(level)
        flip ^= np.where((x[-1] & high) != 0, high - one, np.uint64(0))
    x ^= flip
    index = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, -1, -1):
        for axis in range(n):
            index = (index << one) | ((x[axis] >> np.uint64(level)) & one)
    return index


def projections(size: int, curves: int, dimensions: int, seed: int) -> np.ndarray:
    """Random orthonormal directions, curves x size x dimensions, with the shifts as a last row."""
    rng = np.random.default_rng(seed)
    dimensions = min(dimensions, size)
    made = [np.linalg.qr(rng.standard_normal((size, dimensions)))[0] for _ in range(curves)]
    return np.stack([np.vstack([m, rng.random(dimensions)]) for m in made])


def usable(vector: str) -> Column:
    """Is a vector neither null nor empty, without null, infinite or not-a-number parts, and not zero?"""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good & F.exists(vector, lambda x: x != 0), F.lit(False))


def points_of(vectors: DataFrame, key: str, vector: str, nearest: int) -> DataFrame:
    """Staged (point, ids, vec): distinct vectors of the most frequent length with their smallest ids.

    ``ids`` are sorted, at most one more than are asked for; a limit within each task goes before
    the exchange, so a vector with very many ids is no bottleneck.
    """
    rows = vectors.where(F.col(key).isNotNull() & usable(vector)).select(
        F.col(key).cast("long").alias("id"), F.transform(vector, lambda x: x.cast("double") + 0.0).alias("vec")
    )
    lengths = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    rows = rows.where(F.size("vec") == (lengths[0].n if lengths else 0))
    order = Window.partitionBy("vec").orderBy("id")
    few = rows.distinct().withColumn("at", F.row_number().over(order)).where(F.col("at") <= nearest + 1)
    made = few.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return staged(made.select(F.col("ids")[0].alias("point"), "ids", "vec"), "points")


def curve_keys(points: DataFrame, curves: int, dimensions: int, bits: int, seed: int) -> DataFrame:
    """Adds keys: the point's place on each curve. The grids' extent comes from a bounded sample of points."""
    sample = points.orderBy(F.xxhash64("point")).limit(RANGE_SAMPLE).select("vec").toArrow().column("vec")
    if not len(sample):
        return points.withColumn("keys", F.array().cast("array<long>"))
    sample = np.stack([np.asarray(v) for v in sample.to_pylist()])
    frames = projections(sample.shape[1], curves, dimensions, seed)
    seen = np.einsum("nv,cvd->cnd", sample, frames[:, :-1])
    low, high = seen.min(axis=1), seen.max(axis=1)
    span = np.maximum(high - low, 1e-300) * 1.5  # room for the shift
    shared = points.sparkSession.sparkContext.broadcast((frames, low, span))

    def run(batches):
        axes, lows, spans = shared.value
        for batch in batches:
            x = batch.column("vec").flatten().to_numpy().reshape(len(batch), -1) if len(batch) else np.empty((0, axes.shape[1] - 1))
            keys = np.empty((len(batch), len(axes)), dtype=np.int64)
            for c, axis in enumerate(axes):
                place = (x @ axis[:-1] - lows[c]) / spans[c] + axis[-1] / 3
                cells = np.clip(place * (1 << bits), 0, (1 << bits) - 1)
                keys[:, c] = (hilbert_index(cells.astype(np.int64), bits) >> np.uint64(1)).view(np.int64)
            ends = np.arange(len(batch) + 1, dtype=np.int32) * len(axes)
            yield {"keys": pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.reshape(-1)))}

    return add_columns(points, run, "keys array<long>")


def nearest_points(asking: np.ndarray, asked: np.ndarray, mine: np.ndarray, theirs: np.ndarray, k: int):
    """(row asking, row asked, distance) of the ``k`` nearest, all ties at the border included.

    Candidates come from the product form; their distances are computed anew from the differences.
    """
    square = (asking**2).sum(1)[:, None] + (asked**2).sum(1)[None, :] - 2 * asking @ asked.T
    k = min(k, asked.shape[0])
    border = np.partition(square, k - 1, axis=1)[:, k - 1]
    slack = 1e-9 * ((asking**2).sum(1) + (asked**2).sum(1).max(initial=0))
    a, b = np.nonzero(square <= (border + slack)[:, None])
    return mine[a], theirs[b], np.sqrt(((asking[a] - asked[b]) ** 2).sum(axis=1))


def search(
    vectors: DataFrame, asks: Column, key: str = "vec_id", vector: str = "embedding", nearest: int = NEAREST, curves: int = CURVES,
    dimensions: int = DIMENSIONS, bits: int = BITS, window: float = WINDOW, least: int = LEAST_WINDOW, block: int = BLOCK, seed: int = 7,
) -> DataFrame:
    """The ``nearest`` neighbours found of each row where ``asks`` (a condition on ``key``) holds:

    query_id, rank (from 1), vec_id, score (Euclidean distance); ties go to the smaller id. A row is
    no neighbour of itself. Vectors that are null, empty, zero or have null or non-finite parts take
    no part, nor do null keys, nor vectors of another length than the most frequent one. Rows with
    the same key and vector count once; a key with two vectors is two candidates.
    """
    names_of(vectors, [key, vector])
    points = points_of(vectors, key, vector, nearest)
    count = points.count()
    queries = vectors.where(asks & F.col(key).isNotNull() & usable(vector)).select(
        F.col(key).cast("long").alias("query_id"), F.transform(vector, lambda x: x.cast("double") + 0.0).alias("vec")
    )
    asked = queries.join(points.select("vec", "point"), "vec").select("query_id", "point").distinct()
    asked = staged(asked, "queries")
    keyed = curve_keys(points, curves, dimensions, bits, seed)
    keyed = keyed.join(asked.select("point").distinct().withColumn("asks", F.lit(True)), "point", "left")
    orders = keyed.select("point", "vec", F.coalesce("asks", F.lit(False)).alias("asks"), F.posexplode("keys").alias("curve", "key"))
    ranked = global_rank(orders, ["curve", "key", "point"], "rank")
    place = F.col("rank") - 1 - F.col("curve").cast("long") * count
    reach = max(least, int(np.ceil(window * count / 2)))
    ranked = ranked.select("point", "vec", "asks", "curve", place.alias("place"))

    # every point in the block of its rank; a query also in the other blocks that its window meets
    low = F.floor(F.greatest(F.col("place") - reach, F.lit(0)) / block)
    high = F.floor(F.least(F.col("place") + reach, F.lit(count - 1)) / block)
    held = ranked.select("curve", F.floor(F.col("place") / block).alias("block"), "point", "vec", F.lit(False).alias("asking"), "place")
    sent = ranked.where("asks").select("curve", F.explode(F.sequence(low, high)).alias("block"), "point", "vec", F.lit(True).alias("asking"), "place")

    def compare(one: pa.Table) -> pa.Table:
        asking = one.column("asking").to_numpy(zero_copy_only=False).astype(bool)
        point, at = one.column("point").to_numpy(), one.column("place").to_numpy()
        x = one.column("vec").combine_chunks().flatten().to_numpy().reshape(len(point), -1)
        a, b = np.flatnonzero(asking), np.flatnonzero(~asking)
        found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        for part in np.array_split(a, max(1, len(a) // 256)):
            if not len(part) or not len(b):
                continue
            # a part's queries see what the widest of their windows sees: more than each one's own
            seen = b[(at[b] >= at[part].min() - reach) & (at[b] <= at[part].max() + reach)]
            if len(seen):
                found.append(nearest_points(x[part], x[seen], point[part], point[seen], nearest + 1))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)]
        return pa.table({n: pa.array(c) for n, c in zip(("query", "near", "score"), columns, strict=True)})

    met = held.unionByName(sent).groupBy("curve", "block").applyInArrow(compare, "query long, near long, score double")
    # the nearest points of a query, then their ids: each point has at most one more than asked for
    best = Window.partitionBy("query").orderBy("score", "near")
    near = met.groupBy("query", "near").agg(F.min("score").alias("score"))
    near = near.withColumn("at", F.row_number().over(best)).where(F.col("at") <= nearest + 1)
    ids = near.join(points.select(F.col("point").alias("near"), "ids"), "near").select("query", "score", F.explode("ids").alias("vec_id"))
    pairs = asked.join(ids, asked.point == ids.query).where("query_id <> vec_id").select("query_id", "vec_id", "score").distinct()
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")
