"""Language-model scoring: a hashed maximum-entropy model with a class-factored softmax.

The tokens seen at least ``LEAST`` times, up to ``COMMON``, are leaves of a tree of classes, built from
their counts so that frequent ones lie near the root; all rarer ones share one more leaf, whose mass
is spread over them by their counts plus one, one unseen token included. A token's probability is
the product, down the tree, of the softmax of ``BRANCHES`` children at each class:

    P(child | class, context) = softmax(share of the child in the class + sum of three weights)

The features of a context are the token before, the two before (n-grams) and the second before
alone (skip), whatever tokens these are: each is hashed from their 64-bit keys and the class to a row
of weights. So the probabilities of all tokens sum to one, and every count of the corpus is used.

The number of weight rows grows with the corpus, up to ``MOST_ROWS`` (64 bytes each). Each round of
training is a Spark job over its share of the documents, all documents in all: a task adds up what
it observes in each row and what the model expects there, the gradient being their difference; Spark
adds the tasks' tables up block by block, and the driver moves each weight by the logarithm of
observed over expected, smoothed, which is the gradient's direction with the step that iterative
scaling takes. Tables travel as 16-bit floats. Scoring handles a batch of texts at a time, in numpy.

Counts are keyed by 64-bit hashes of tokens. Those of the ``COMMON`` most frequent tokens are
broadcast; occurrences of the rest are joined with the table of counts, in which no key is then
left that many documents share.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.llm.shared import arrow_rows, mix64, names_of, pieces, slices, sums_by_row, whole_text
from presswork.llm.words import Words, word_key
from presswork.plans.stage import staged

COMMON = 1 << 19
LEAST = 3  # occurrences of a token with a leaf of its own
BRANCHES = 16
MOST_ROWS = 1 << 20
ROUNDS = 2
SMOOTH = 8.0  # occurrences at the model's own odds that are added to observed and expected
SHARE = 0.4  # of a whole step: the three features of a context move together
TOGETHER = 8_000_000  # bytes of text whose tokens are looked up together
BLOCK = 1 << 12  # tokens whose softmax is computed together: what that takes stays in the caches
PARTS = 64  # blocks of the tables
LANES = 32  # tasks' parts of a block are first added up in so many lanes
TASK_TOKENS = 100_000_000  # tokens that a task of a round reads, at least, where there are more tasks than cores
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_LOG10 = np.log(10.0)
# the end of a text is a token that no word can equal: words hold no white space
END = word_key("end-of-text\x00") ^ 0x5DEECE66D


@dataclass
class Counts:
    """Exact counts of the corpus' most frequent tokens, with the corpus' totals."""

    keys: np.ndarray  # sorted, uint64
    counts: np.ndarray
    total: int
    distinct: int
    end: int

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each key, and whether it is there."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys


@dataclass
class Model:
    counts: Counts
    words: np.ndarray  # sorted keys of the tokens with a leaf
    leaf: np.ndarray  # their leaves; the leaf of all others is the last
    parent: np.ndarray  # class above each leaf and class; the root, the last class, is its own
    place: np.ndarray  # among the class' children
    shares: np.ndarray  # log share of each child, classes x BRANCHES
    weights: np.ndarray  # rows x BRANCHES
    other_mass: float  # sum of count + 1 over the tokens of the last leaf, the unseen one included

    @property
    def other(self) -> int:
        return len(self.words)

    def leaves_of(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.full(len(keys), self.other)
        at = np.minimum(np.searchsorted(self.words, keys), len(self.words) - 1)
        return np.where(self.words[at] == keys, self.leaf[at], self.other)

    def way(self, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``leaf``, class, child) of every class above each leaf."""
        root, first = len(self.shares) - 1, len(self.words) + 1
        at, now = np.arange(len(leaf)), leaf
        found = [[np.empty(0, np.int64)] * 3]
        while len(now) and root >= 0:
            above = self.parent[now]
            found.append([at, above, self.place[now]])
            left = above != root
            at, now = at[left], above[left] + first
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def class_tree(counts: np.ndarray, branches: int = BRANCHES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(parent, place, log shares) of the tree that joins the ``branches`` rarest again and again.

    ``counts`` are those of the leaves. Nodes are leaves, then classes; parents are numbers of classes.
    """
    n = len(counts)
    left = [(float(c), i) for i, c in enumerate(counts)]
    heapq.heapify(left)
    parent, place, mass = [0] * n, [0] * n, list(map(float, counts))
    take = (n - 2) % (branches - 1) + 2 if n > 1 else 0  # so that all later classes are full
    children: list[list[int]] = []
    while len(left) > 1:
        some = [heapq.heappop(left) for _ in range(take)]
        for slot, (_, i) in enumerate(some):
            parent[i], place[i] = len(children), slot
        children.append([i for _, i in some])
        mass.append(sum(c for c, _ in some))
        heapq.heappush(left, (mass[-1], n + len(children) - 1))
        parent.append(len(children) - 1)
        place.append(0)
        take = branches
    shares = np.full((len(children), branches), -1e9, np.float32)
    for c, some in enumerate(children):
        shares[c, : len(some)] = np.log([max(mass[i], 1e-300) / max(mass[n + c], 1e-300) for i in some])
    return np.array(parent, np.int64), np.array(place, np.int64), shares


def features(one: np.ndarray, two: np.ndarray, above: np.ndarray, rows: int) -> list[np.ndarray]:
    """Rows of the three features of contexts (keys of the token before and of the second before) at classes."""
    node = (above.astype(np.uint64) + np.uint64(1)) * _GOLD
    kinds = (one * np.uint64(3) + np.uint64(1), two * np.uint64(5) + np.uint64(2), mix64(one + np.uint64(7)) + two * np.uint64(7))
    return [(mix64(k ^ node) & np.uint64(rows - 1)).astype(np.int64) for k in kinds]


class Workspace:
    """Arrays that blocks of tokens use again and again: fresh ones of this size would cost a page fault each 4 KB."""

    def __init__(self):
        self.held: dict[str, np.ndarray] = {}

    def get(self, name: str, n: int, kind: type) -> np.ndarray:
        """An array n x BRANCHES with any content."""
        kept = self.held.get(name)
        if kept is None or len(kept) < n:
            kept = self.held[name] = np.empty((n + n // 4, BRANCHES), kind)
        return kept[:n]


def softmax(model: Model, above: np.ndarray, rows: list[np.ndarray], space: Workspace) -> np.ndarray:
    """Probabilities of all children of classes, in the workspace; weights are bounded, so nothing overflows."""
    x, y = (space.get(name, len(above), np.float32) for name in "xy")
    np.take(model.shares, above, axis=0, out=x, mode="clip")
    for row in rows:
        x += np.take(model.weights, row, axis=0, out=y, mode="clip")
    np.exp(np.minimum(x, 60.0, out=x), out=x)
    x /= np.maximum(x @ np.ones(BRANCHES, np.float32), np.float32(1e-37))[:, None]
    return x


def log_prob(model: Model, two: np.ndarray, one: np.ndarray, leaf: np.ndarray) -> np.ndarray:
    """Natural log probability of leaves after two tokens, told by their keys."""
    out, space = np.zeros(len(leaf)), Workspace()
    for first in range(0, len(leaf), BLOCK):
        part = slice(first, first + BLOCK)
        at, above, child = model.way(leaf[part])
        p = softmax(model, above, features(one[part][at], two[part][at], above, len(model.weights)), space)
        log = np.log(np.maximum(p[np.arange(len(at)), child], 1e-37).astype(np.float64))
        out[part] = np.bincount(at, weights=log, minlength=len(leaf[part]))
    return out


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all tokens, each text's words and then its end, and each text's bounds in them."""
    parts, ends = [np.empty(0, np.uint64)], [np.zeros(1, np.int64)]
    for _, part in slices(column, 1_000_000):
        words = Words(part)
        bounds = np.cumsum(np.diff(words.rows) + 1)
        keys = np.full(bounds[-1], np.uint64(END), dtype=np.uint64)
        keys[np.arange(words.rows[-1]) + words.row_of_word()] = words.keys()
        parts.append(keys)
        ends.append(bounds + ends[-1][-1])
    return np.concatenate(parts), np.concatenate(ends)


def before(keys: np.ndarray, bounds: np.ndarray, by: int) -> np.ndarray:
    """The key ``by`` places before each, within its text; 1 where there is none."""
    out = np.ones(len(keys), dtype=np.uint64)
    out[by:] = keys[:-by]
    for k in range(by):
        at = bounds[:-1] + k
        out[at[at < bounds[1:]]] = 1
    return out


def count_tokens(docs: DataFrame, learn: Column, text: str) -> DataFrame:
    """Staged (key, n, every): occurrences of each token in the rows to learn from, and in all rows."""
    rows = docs.select(learn.alias("learn"), whole_text(text).alias("text"))

    def work(batches):
        for batch in batches:
            mine = batch.column("learn").to_numpy(zero_copy_only=False).astype(bool)
            for first, part in pieces(batch, "text", TOGETHER):
                keys, bounds = tokens(part)
                learnt = np.repeat(mine[first : first + len(part)], np.diff(bounds))
                which, distinct = pd.factorize(keys)
                yield {
                    "key": distinct.view(np.int64),
                    "n": np.bincount(which, weights=learnt, minlength=len(distinct)).astype(np.int64),
                    "every": np.bincount(which, minlength=len(distinct)),
                }

    parts = arrow_rows(rows, work, "key long, n long, every long")
    return staged(parts.groupBy("key").agg(F.sum("n").alias("n"), F.sum("every").alias("every")), "token-counts")


def common_counts(table: DataFrame, common: int = COMMON) -> Counts:
    total = table.agg(F.sum("n").alias("n"), F.sum((F.col("n") > 0).cast("long")).alias("v")).first()
    top = table.orderBy(F.desc("every"), "key").limit(common).select("key", "n").toArrow()
    keys = top.column("key").to_numpy().view(np.uint64)
    counts = top.column("n").to_numpy()
    order = np.argsort(keys)
    end = table.where(F.col("key") == int(np.uint64(END).astype(np.int64))).select("n").first()
    return Counts(keys[order], counts[order], total.n or 0, total.v or 0, end.n if end else 0)


def initial(counts: Counts, least: int = LEAST, most_rows: int = MOST_ROWS) -> Model:
    """The tree of classes, and weights of 0: a row for each token, in large corpora for 64 of them."""
    order = np.lexsort((counts.keys, -counts.counts))
    order = order[counts.counts[order] >= least]
    other = counts.total - counts.counts[order].sum() + (counts.distinct - len(order)) + 1.0
    parent, place, shares = class_tree(np.append(counts.counts[order], other))
    by_key = np.argsort(counts.keys[order])
    rows = min(counts.total, max(1 << 19, counts.total // 64), most_rows)
    rows = 1 << max(4, int(rows).bit_length() - 1)
    return Model(counts, counts.keys[order][by_key], by_key, parent, place, shares, np.zeros((rows, BRANCHES), np.float32), float(other))


def observe(model: Model, keys: np.ndarray, bounds: np.ndarray, sums: np.ndarray) -> None:
    """Add up in a flat table, rows x (observed, expected) x children, what each row's features saw, and
    what the model expected them to see."""
    one, two, leaf = before(keys, bounds, 1), before(keys, bounds, 2), model.leaves_of(keys)
    each, wide, space = np.arange(BRANCHES, 2 * BRANCHES), 2 * BRANCHES, Workspace()
    start = None if model.weights.any() else np.exp(model.shares)
    for first in range(0, len(leaf), BLOCK):
        part = slice(first, first + BLOCK)
        at, above, child = model.way(leaf[part])
        rows = features(one[part][at], two[part][at], above, len(model.weights))
        if start is None:
            p = softmax(model, above, rows, space)
        else:
            p = np.take(start, above, axis=0, out=space.get("x", len(at), np.float32), mode="clip")
        seen, cells = np.ones(len(at), np.float32), space.get("cells", len(at), np.int64)
        for row in rows:
            row = row * wide
            np.add.at(sums, row + child, seen)
            np.add.at(sums, np.add(row[:, None], each, out=cells).reshape(-1), p.reshape(-1))


def moved(observed: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """How far weights go: a share of the log of observed over expected, both smoothed by the model's odds."""
    rest = SMOOTH * expected / np.maximum(expected.sum(axis=1, keepdims=True), 1e-9) + 1e-6
    return (SHARE * np.log((observed + rest) / (expected + rest))).astype(np.float32)


def packed(x: np.ndarray) -> bytes:
    """The upper 16 bits of each float, rounded."""
    return ((x.view(np.uint32) + np.uint32(0x8000)) >> np.uint32(16)).astype(np.uint16).tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    return (np.frombuffer(raw, np.uint16).astype(np.uint32) << np.uint32(16)).view(np.float32)


def _add_up(parts: DataFrame, tasks: int) -> DataFrame:
    """One row per block; the parts of many tasks are first added up in lanes."""

    def add(one: pa.Table) -> pa.Table:
        total = sum(unpacked(value.as_py()) for value in one.column("value"))
        first = one.slice(0, 1)
        return pa.table({"block": first.column("block"), "lane": first.column("lane"), "value": pa.array([packed(total)], pa.binary())})

    if tasks > LANES:
        parts = parts.groupBy("block", "lane").applyInArrow(add, "block int, lane int, value binary")
    return parts.groupBy("block").applyInArrow(add, "block int, lane int, value binary")


def improve(model: Model, docs: DataFrame, text: str, rounds: int = ROUNDS) -> Model:
    """A Spark job a round, over the documents whose text's hash falls to it; the driver moves the weights."""
    spark = docs.sparkSession
    if not len(model.shares):
        return model
    texts = docs.select(whole_text(text).alias("text"))
    tasks = max(spark.sparkContext.defaultParallelism, model.counts.total // TASK_TOKENS)
    step = -(-len(model.weights) // PARTS)
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(replace(model, counts=None))

        def work(batches, shared=shared):
            from pyspark import TaskContext

            now = shared.value
            sums = np.zeros(2 * now.weights.size, np.float32)
            for batch in batches:
                for _, part in pieces(batch, "text", TOGETHER):
                    observe(now, *tokens(part), sums)
            size = 2 * BRANCHES * step
            for i in range(0, len(sums), size):
                yield {"block": [i // size], "lane": [TaskContext.get().partitionId() % LANES], "value": [packed(sums[i : i + size])]}

        share = texts.where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == turn).coalesce(tasks)
        got = _add_up(arrow_rows(share, work, "block int, lane int, value binary"), tasks).toArrow()
        shared.unpersist()
        weights = model.weights.copy()
        for block, value in zip(got.column("block").to_pylist(), got.column("value"), strict=True):
            part = unpacked(value.as_py()).reshape(-1, 2, BRANCHES)
            weights[block * step :][: len(part)] += moved(part[:, 0], part[:, 1])
        model = replace(model, weights=weights)
    return model


def train(docs: DataFrame, learn: Column, text: str = "text", rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """The model and the staged table of all tokens' counts, from all rows where ``learn`` holds."""
    names_of(docs, [text])
    table = count_tokens(docs, learn, text)
    return improve(initial(common_counts(table)), docs.where(learn), text, rounds), table


def score(docs: DataFrame, model: Model, table: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` (staged, without ``text``) with n_tokens, n_known, train_tokens, base_score and score.

    A null text counts as empty: its only token is its end. Scores are log10 probabilities; the
    base is the add-one unigram. Clashing names raise ``ValueError``.
    """
    names_of(docs, [text])
    new = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    clash = {c.lower() for c in docs.columns if c != text} & {*new, "_row", "_rare", "_rare_n"}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are there already")
    kept = [c for c in docs.columns if c != text]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    total, distinct = model.counts.total, model.counts.distinct
    base_log = np.log10(total + distinct + 1.0)
    other_log = np.log10(model.other_mass)

    def work(batches):
        known = shared.value
        counts = known.counts
        for batch in batches:
            for first, part in pieces(batch, text, TOGETHER):
                keys, bounds = tokens(part)
                which, distinct = pd.factorize(keys)
                leaf = known.leaves_of(distinct)[which]
                at, there = counts.find(distinct)
                n = np.where(there, counts.counts[at] if len(counts.keys) else 0, 0)
                own = np.log10(n + 1.0)[which]  # of rare tokens: added after the join
                n, there = n[which], there[which]
                outside = leaf == known.other
                model_log = log_prob(known, before(keys, bounds, 2), before(keys, bounds, 1), leaf) / _LOG10
                model_log += np.where(outside, own - other_log, 0.0)
                row = np.repeat(np.arange(len(part)), np.diff(bounds))
                rare = np.flatnonzero(~there)
                code = np.lexsort((keys[rare], row[rare]))
                rare = rare[code]
                head = np.flatnonzero(np.concatenate([[True], (keys[rare][1:] != keys[rare][:-1]) | (row[rare][1:] != row[rare][:-1])])) if len(rare) else rare
                many = np.diff(np.append(head, len(rare)))
                ends = np.searchsorted(row[rare][head], np.arange(len(part) + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in (keys[rare][head].view(np.int64), many.astype(np.int32))]
                yield {
                    **{c: batch.column(c).slice(first, len(part)) for c in kept},
                    "n_tokens": np.diff(bounds), "n_known": sums_by_row(n > 0, bounds).astype(np.int64),
                    "train_tokens": np.full(len(part), total), "base_score": sums_by_row(own - base_log, bounds),
                    "score": sums_by_row(model_log, bounds), "_rare": lists[0], "_rare_n": lists[1],
                }

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema]
    schema = ", ".join([*fields, "n_tokens long, n_known long, train_tokens long, base_score double, score double, _rare array<long>, _rare_n array<int>"])
    scored = staged(arrow_rows(docs, work, schema).withColumn("_row", F.monotonically_increasing_id()), "scored")

    rare = scored.select("_row", F.explode(F.arrays_zip("_rare", "_rare_n")).alias("r")).select("_row", F.col("r._rare").alias("key"), F.col("r._rare_n").alias("many"))
    met = rare.join(table.where("n > 0").select("key", "n"), "key")
    added = met.groupBy("_row").agg(F.sum("many").alias("_known"), F.sum(F.col("many") * F.log10(F.col("n") + 1.0)).alias("_log"))
    whole = scored.drop("_rare", "_rare_n").join(added, "_row", "left")
    log = F.coalesce("_log", F.lit(0.0))
    return whole.withColumns(
        {
            "n_known": F.col("n_known") + F.coalesce("_known", F.lit(0)),
            "base_score": F.col("base_score") + log,
            "score": F.col("score") + log,
        }
    ).select(*kept, *new)
