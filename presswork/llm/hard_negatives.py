"""Hard negatives of anchors, with scores bounded along spanning trees of anchors.

Scores are inner products of integer vectors. By Cauchy and Schwarz the scores of one candidate with
two anchors differ by no more than the anchors' distance times the candidate's norm. Anchors that
are alike (by label and place on a Hilbert curve) are dealt into trees of bounded size, each a minimum
spanning tree of its anchors. A task scores its candidates with a tree's root; down the tree a
child's score lies within its parent's bounds, widened by the edge, and only candidates whose
bounds meet what the child still asks for are scored anew. What it asks for is a window of scores
of rows with the same or another label, from its best so far upwards.

Anchors go through in chunks of bounded bytes, each broadcast; candidates are scanned where they lie
and never shuffled. A first scan over a share of the candidates gives each anchor a floor, so that
the second, over the others, hands on little more than the results. Each chunk's results are appended
to a table in the shared folder.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presswork.llm.files import new_folder
from presswork.llm.neighbours import hilbert_index, projections
from presswork.llm.shared import add_columns, arrow_rows, names_of
from presswork.llm.whitening import finite, matrix_of, usual_length
from presswork.plans.ordering import global_rank
from presswork.plans.stage import staged

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # a negative's score, as a percentage of the positive's
TREE = 512  # anchors of a tree
CHUNK_BYTES = 8 << 20  # of anchors' vectors broadcast at a time
BLOCK = 4096  # candidates scored at a time
SHARE = 16  # one candidate of so many is in the first scan
DENSE = 0.25  # from this share of candidates to score on, a whole product is cheaper
LARGEST = 1 << 31  # vectors of at least this norm could have scores beyond 64 bits
NO_FLOOR, NO_CEILING = -(1 << 62), 1 << 62

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def usable_rows(vectors: DataFrame, label: str, key: str, vector: str, scale: int) -> DataFrame:
    """Staged (id, label, x, first): rows that take part, those that agree in all three once.

    ``first`` marks the candidates of the first scan.
    """
    rows = vectors.where(finite(vector) & F.col(key).isNotNull() & F.col(label).isNotNull()).select(
        F.col(key).cast("long").alias("id"), F.col(label).alias("label"), F.transform(vector, lambda c: F.floor(c.cast("double") * scale)).alias("_x")
    )
    rows = rows.where(F.size("_x") == usual_length(rows))
    square = F.aggregate("_x", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    rows = rows.where(square < float(LARGEST) ** 2)
    if not rows.groupBy("id").count().where("count > 1").isEmpty():
        rows = rows.distinct()
    return staged(rows.select("id", "label", F.col("_x").alias("x"), (F.pmod(F.xxhash64("id"), F.lit(SHARE)) == 0).alias("first")), "candidates")


def _curve_key(x: np.ndarray, axes: np.ndarray, bits: int = 4) -> np.ndarray:
    """Place of each vector's direction on a Hilbert curve through random projections."""
    x = x / np.maximum(np.linalg.norm(x, axis=1), 1e-300)[:, None]
    spread = (x @ axes) * np.sqrt(len(axes)) / 6 + 0.5
    cells = np.clip(spread * (1 << bits), 0, (1 << bits) - 1)
    return hilbert_index(cells.astype(np.int64), bits).astype(np.int64)


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parent, length of the edge to it, and depth of each vector in a minimum spanning tree (Prim).

    The root is the vector nearest to their mean, its own parent.
    """
    x = x.astype(np.float64)
    n = len(x)
    root = int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())
    parent, depth = np.full(n, root), np.zeros(n, np.int64)
    near = np.full(n, np.inf)
    out = np.ones(n, bool)
    out[root] = False
    last = root
    for _ in range(n - 1):
        d = ((x - x[last]) ** 2).sum(axis=1)
        closer = out & (d < near)
        near[closer], parent[closer] = d[closer], last
        last = int(np.where(out, near, np.inf).argmin())
        out[last] = False
        depth[last] = depth[parent[last]] + 1
    return parent, np.linalg.norm(x - x[parent], axis=1), depth


def anchor_trees(candidates: DataFrame, anchors: Column) -> DataFrame:
    """Staged (tree, node, parent, edge, depth, anchor, id, label, x): nodes of each tree by depth, the root first.

    ``anchor`` numbers the anchors from 0 in the order in which they are dealt into trees.
    """
    chosen = candidates.where(anchors)
    first = chosen.select("x").first()
    axes = projections(len(first.x), 1, 8, 5)[0][:-1] if first else np.empty((0, 0))

    def place(batches):
        for batch in batches:
            yield {"curve": _curve_key(matrix_of(batch.column("x"), len(axes)).astype(np.float64), axes) if len(batch) else np.empty(0, np.int64)}

    placed = global_rank(add_columns(chosen.drop("first"), place, "curve long"), ["label", "curve", "id"], "anchor")
    dealt = placed.select(F.floor((F.col("anchor") - 1) / TREE).alias("tree"), (F.col("anchor") - 1).alias("anchor"), "id", "label", "x")
    kind = candidates.schema["label"].dataType.simpleString()
    schema = f"tree long, node int, parent int, edge double, depth int, anchor long, id long, label {kind}, x array<long>"

    def grow(some: pa.Table) -> pa.Table:
        some = some.sort_by("anchor").combine_chunks()
        parent, edge, depth = spanning_tree(matrix_of(some.column("x").chunk(0), len(some["x"][0])))
        order = np.argsort(depth, kind="stable")
        node = np.empty(len(order), np.int64)
        node[order] = np.arange(len(order))
        some = some.take(pa.array(order))
        made = {"node": np.arange(len(order), dtype=np.int32), "parent": node[parent[order]].astype(np.int32), "edge": edge[order], "depth": depth[order].astype(np.int32)}
        return pa.table({"tree": some["tree"], **{n: pa.array(v) for n, v in made.items()}, **{n: some[n] for n in ("anchor", "id", "label", "x")}})

    return staged(dealt.groupBy("tree").applyInArrow(grow, schema), "anchor-trees")


@dataclass(frozen=True)
class Tree:
    """Anchors of a tree by depth; of each slot of an anchor the window of scores and the floor within it."""

    x: np.ndarray
    norm: np.ndarray
    parent: np.ndarray
    edge: np.ndarray
    levels: list[slice]
    anchor: np.ndarray
    id: np.ndarray
    label: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def of(cls, rows: pa.Table) -> Tree:
        rows = rows.sort_by("node").combine_chunks()
        depth = rows["depth"].to_numpy()
        at = np.searchsorted(depth, np.arange(depth.max() + 2))
        x = matrix_of(rows["x"].chunk(0), len(rows["x"][0]))
        parent, edge, anchor, id_, label = (rows[c].to_numpy(zero_copy_only=False) for c in ("parent", "edge", "anchor", "id", "label"))
        none = np.empty((len(x), 0), np.int64)
        levels = [slice(int(a), int(b)) for a, b in zip(at, at[1:])]
        return cls(x, np.linalg.norm(x.astype(np.float64), axis=1), parent, edge, levels, anchor, id_, label, none, none)


class Best:
    """The k best scores of each slot of a tree's anchors so far; ties go to the smaller id."""

    def __init__(self, tree: Tree, k: int):
        self.tree, self.k = tree, k
        self.floor, self.found = tree.low.copy(), {}
        self._open = tree.low <= tree.high
        self.low = np.where(self._open, self.floor, NO_CEILING).min(axis=1, initial=NO_CEILING)
        self.high = np.where(self._open, tree.high, NO_FLOOR).max(axis=1, initial=NO_FLOOR)

    def take(self, a: int, ids: np.ndarray, scores: np.ndarray) -> None:
        for slot in range(self.floor.shape[1]):
            good = (scores >= self.floor[a, slot]) & (scores <= self.tree.high[a, slot])
            if not good.any():
                continue
            i, s = ids[good], scores[good]
            if (a, slot) in self.found:
                older = self.found[a, slot]
                i, s = np.concatenate([older[0], i]), np.concatenate([older[1], s])
            if len(s) > 4 * self.k:
                some = s >= np.partition(s, len(s) - self.k)[len(s) - self.k]
                i, s = i[some], s[some]
            order = np.lexsort((i, -s))[: self.k]
            self.found[a, slot] = i[order], s[order]
            if len(order) == self.k:
                self.floor[a, slot] = s[order[-1]]
        self.low[a] = np.where(self._open[a], self.floor[a], NO_CEILING).min(initial=NO_CEILING)

    def rows(self) -> dict:
        keys = list(self.found)
        sizes = [len(self.found[k][0]) for k in keys]
        columns = [np.concatenate([self.found[k][c] for k in keys] or [np.empty(0, np.int64)]) for c in (0, 1)]
        at = np.array([a for a, _ in keys], dtype=np.int64)
        return {
            "anchor": np.repeat(self.tree.anchor[at], sizes), "slot": np.repeat(np.array([s for _, s in keys], dtype=np.int32), sizes),
            "id": columns[0], "score": columns[1],
        }


def products(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of all rows of ``a`` with all of ``b``; in floating point where that is ``exact``."""
    return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64) if exact else a @ b.T


def scan_block(best: Best, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, same: bool) -> int:
    """Offer a block of candidates to a tree's anchors; returns how many scores were computed."""
    tree = best.tree
    norm = np.linalg.norm(x.astype(np.float64), axis=1)
    reach = tree.norm.max() * norm.max()
    exact, slack = reach < 2.0**52, 0.5 + 1e-11 * reach
    low, high = np.empty((2, len(tree.x), len(x)))
    scored = 0
    for depth, level in enumerate(tree.levels):
        some, parent = np.arange(level.start, level.stop), tree.parent[level]
        if depth:
            wide = tree.edge[level, None] * norm[None, :]
            wide = np.where(wide > 0, wide + slack, 0.0)
            np.subtract(low[parent], wide, out=low[level])
            np.add(high[parent], wide, out=high[level])
            need = (high[level] >= best.low[level, None]) & (low[level] <= best.high[level, None])
        else:
            need = np.ones((1, len(x)), bool)
        wanted = (tree.label[level, None] == labels[None, :]) == same
        wanted &= tree.id[level, None] != ids[None, :]
        if depth:
            need &= wanted
        rescore = need & (low[level] != high[level]) if depth else need
        if rescore.mean() > DENSE:
            low[level] = high[level] = products(tree.x[level], x, exact)
            scored += rescore.size
        else:
            i, j = np.nonzero(rescore)
            for first in range(0, len(i), 1 << 16):
                a, c = some[i[first : first + (1 << 16)]], j[first : first + (1 << 16)]
                low[a, c] = high[a, c] = np.einsum("pd,pd->p", tree.x[a], x[c])
            scored += len(i)
        need &= wanted
        need &= (low[level] >= best.low[level, None] - slack) & (low[level] <= best.high[level, None] + slack)
        for r in np.flatnonzero(need.any(axis=1)):
            a, c = int(some[r]), np.flatnonzero(need[r])
            s = low[a, c].astype(np.int64) if exact else x[c] @ tree.x[a]
            best.take(a, ids[c], s)
    return scored


def scan(candidates: DataFrame, trees: list[Tree], same: bool, k: int) -> DataFrame:
    """(anchor, slot, id, score): each task's k best of every slot of the broadcast trees."""
    shared = candidates.sparkSession.sparkContext.broadcast(trees)

    def work(batches):
        bests = [Best(t, k) for t in shared.value]
        for batch in batches:
            for first in range(0, len(batch), BLOCK):
                part = batch.slice(first, BLOCK)
                ids, labels = (part.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label"))
                x = matrix_of(part.column("x"), bests[0].tree.x.shape[1])
                for best in bests:
                    scan_block(best, ids, labels, x, same)
        for best in bests:
            yield best.rows()

    return arrow_rows(candidates.select("id", "label", "x"), work, "anchor long, slot int, id long, score long")


def leaders(found: DataFrame, k: int) -> DataFrame:
    """Adds rank: the k best of each (anchor, slot)."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(candidates: DataFrame, trees: list[Tree], same: bool, k: int, label: str) -> DataFrame:
    """Staged leaders over all candidates: the first scan's k-th best is the floor of the second."""
    early = staged(leaders(scan(candidates.where("first"), trees, same, k), k), f"{label}-first")
    floors = early.where(F.col("rank") == k).select("anchor", "slot", "score").toArrow()
    raised = {(a, s): v for a, s, v in zip(*(floors.column(c).to_pylist() for c in ("anchor", "slot", "score")), strict=True)}
    seeded = []
    for tree in trees:
        low = tree.low.copy()
        for i, a in enumerate(tree.anchor.tolist()):
            for s in range(low.shape[1]):
                low[i, s] = raised.get((a, s), low[i, s])
        seeded.append(replace(tree, low=low))
    late = scan(candidates.where("not first"), seeded, same, k)
    return staged(leaders(early.drop("rank").unionByName(late), k), label)


def with_windows(trees: list[Tree], positives: pa.Table, slots: int, low: int, high: int) -> list[Tree]:
    """Trees whose slots ask for the scores between ``low`` and ``high`` percent of each positive's."""
    scores = {(a, r - 1): s for a, r, s in zip(*(positives.column(c).to_pylist() for c in ("anchor", "rank", "score")), strict=True)}
    made = []
    for tree in trees:
        bottom = np.full((len(tree.x), slots), NO_CEILING)
        top = np.full((len(tree.x), slots), NO_FLOOR)
        for i, a in enumerate(tree.anchor.tolist()):
            for slot in range(slots):
                if (s := scores.get((a, slot))) is not None:
                    bottom[i, slot], top[i, slot] = -((-low * s) // 100), high * s // 100
        made.append(replace(tree, low=bottom, high=top))
    return made


def mine(
    vectors: DataFrame, anchors: Column, label: str = "label", key: str = "vec_id", vector: str = "embedding",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE,
) -> DataFrame:
    """Hard negatives of every anchor (a condition on ``id``, the key) and each of its positives:

    anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score. An entry
    counts as floor(scale * entry). Positives are the ``positives`` other rows of the anchor's label
    with the highest scores, all if there are fewer; negatives the ``negatives`` rows of another label
    with the highest scores of those from ``low`` to ``high`` percent of the positive's. Ties go to
    the smaller id. Rows with a null key or label, or a vector that is null or empty, has null or
    non-finite entries, is longer or shorter than most, or of a norm from 2^31 on take no part. Rows
    that agree in key, label and vector count once; a key with several vectors is several candidates
    and several anchors, and no row is a partner of one with its own key. An empty table gives no
    rows; other columns are not read.
    """
    names_of(vectors, [label, key, vector])
    spark = vectors.sparkSession
    candidates = usable_rows(vectors, label, key, vector, scale)
    trees = anchor_trees(candidates, anchors)
    path = new_folder(spark, "hard-negatives")
    spark.createDataFrame([], RESULT).write.parquet(path)
    first = trees.select("x").first()
    step = max(1, CHUNK_BYTES // (TREE * 8 * len(first.x))) if first else 1
    last = trees.agg(F.max("tree")).first()[0]
    for chunk in range(0, -1 if last is None else last + 1, step):
        _mine_chunk(spark, candidates, trees.where(F.col("tree").between(chunk, chunk + step - 1)), path, positives, negatives, low, high)
    return spark.read.schema(RESULT).parquet(path)


def _mine_chunk(spark: SparkSession, candidates: DataFrame, rows: DataFrame, path: str, positives: int, negatives: int, low: int, high: int) -> None:
    table = rows.toArrow().sort_by([("tree", "ascending"), ("node", "ascending")])
    at = np.flatnonzero(table["node"].to_numpy() == 0).tolist() + [len(table)]
    trees = [Tree.of(table.slice(a, b - a)) for a, b in zip(at, at[1:])]
    every = [replace(t, low=np.full((len(t.x), 1), NO_FLOOR), high=np.full((len(t.x), 1), NO_CEILING)) for t in trees]
    near = search(candidates, every, True, positives, "positives")
    asking = with_windows(trees, near.toArrow(), positives, low, high)
    hard = search(candidates, asking, False, negatives, "negatives")
    pairs = near.select("anchor", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    names = rows.select("anchor", F.col("id").alias("anchor_id"))
    out = hard.join(pairs, ["anchor", "slot"]).join(names, "anchor")
    out.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")).write.mode("append").parquet(path)
