"""Hard negatives against brute force over all pairs of anchors and rows."""

import math

import numpy as np
import pytest
from check import compare, connect
from pyspark.sql import functions as F

from presswork.llm import hard_negatives as hn
from presswork.llm.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.01"


def brute(rows, anchor, low=30, high=90, positives=5, negatives=10):
    good = {(k, label, tuple(math.floor(256 * c) for c in v)) for k, label, v in rows if k is not None and label is not None and v and all(c is not None and math.isfinite(c) for c in v)}
    sizes = [len(v) for *_, v in good]
    usual = min(set(sizes), key=lambda s: (-sizes.count(s), s)) if sizes else 0
    good = [r for r in good if len(r[2]) == usual and sum(c * c for c in r[2]) < 2**62]
    out = []
    for key, label, v in good:
        if not anchor(key):
            continue
        met = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), other, tag == label) for other, tag, w in good if other != key)
        for s, p, _ in [m for m in met if m[2]][:positives]:
            fits = [(t, n) for t, n, same in met if not same and low * -s <= 100 * -t <= high * -s]
            out += [(key, p, i, n, -s, -t) for i, (t, n) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, anchor, **options):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    return sorted(map(tuple, hn.mine(df, anchor, **options).collect()))


def test_query_equals_sql(spark):
    got = QUERIES["op13_hard_negatives"](spark, FOLDER).toPandas()
    assert compare(got, connect(FOLDER).execute(ORACLE_SQL["op13_hard_negatives"]).df()).startswith("ok")


@pytest.fixture
def small_parts(monkeypatch):
    monkeypatch.setattr(hn, "TREE", 7)
    monkeypatch.setattr(hn, "CHUNK_BYTES", 7 * 8 * 6 * 3)
    monkeypatch.setattr(hn, "BLOCK", 16)


@pytest.mark.parametrize("kind", ["spread", "clusters", "copies"])
def test_trees_chunks_and_blocks(spark, small_parts, kind):
    rng = np.random.default_rng(4)
    n = 260
    x = rng.standard_normal((n, 6))
    if kind == "clusters":
        x = np.repeat(rng.standard_normal((13, 6)) * 3, 20, axis=0) + 0.05 * x
    if kind == "copies":
        x[rng.random(n) < 0.5] = x[0]
    rows = [(i, int(rng.integers(0, 4)), v.tolist()) for i, v in enumerate(x)]
    assert mined(spark, rows, F.col("id") % 5 == 0) == brute(rows, lambda i: i % 5 == 0)


HARD = [
    (0, 1, [1.0, 2.0]), (0, 1, [1.0, 2.0]), (1, 1, [1.0, 1.9]), (2, 2, [0.5, 1.0]), (3, 2, [0.5, 1.0]), (4, None, [1.0, 1.0]), (5, 2, None),
    (None, 2, [1.0, 1.0]), (6, 2, []), (7, 2, [1.0, None]), (8, 2, [float("nan"), 1.0]), (9, 2, [1.0, float("inf")]), (10, 2, [1.0]),
    (11, 1, [1e300, 1.0]), (12, 3, [0.0, 0.0]), (0, 2, [0.4, 0.9]), (20, 1, [-1.0, -1.0]), (30, 3, [0.6, 0.8]), (13, 1, [1e6, 1e6]),
]


def test_null_unusable_repeated_and_extra_columns(spark):
    expected = brute(HARD, lambda i: i % 10 == 0)
    assert expected
    assert mined(spark, HARD, F.col("id") % 10 == 0) == expected
    df = spark.createDataFrame(HARD, "vec_id long, label int, embedding array<double>").selectExpr("*", "1 AS x", "2 AS id", "'a' AS anchor", "3 AS rank")
    assert sorted(map(tuple, hn.mine(df, F.col("id") % 10 == 0).collect())) == expected
    words = df.withColumn("label", F.col("label").cast("string"))
    assert sorted(map(tuple, hn.mine(words, F.col("id") % 10 == 0).collect())) == expected


@pytest.mark.parametrize("rows", [[], [(0, 1, None)], [(0, 1, [1.0])], [(1, 1, [1.0]), (2, 2, [1.0])]])
def test_nothing_to_mine(spark, rows):
    assert mined(spark, rows, F.col("id") % 10 == 0) == []


def test_scores_beyond_floating_point(spark):
    rng = np.random.default_rng(2)
    rows = [(i, i % 2, (rng.standard_normal(3) * 2e6).tolist()) for i in range(60)]
    assert mined(spark, rows, F.col("id") % 10 == 0) == brute(rows, lambda i: i % 10 == 0)


def tree_of(x, labels, k=3, low=hn.NO_FLOOR, high=hn.NO_CEILING):
    parent, edge, depth = hn.spanning_tree(x)
    order = np.argsort(depth, kind="stable")
    node = np.empty(len(x), np.int64)
    node[order] = np.arange(len(x))
    at = np.searchsorted(depth[order], np.arange(depth.max() + 2))
    levels = [slice(int(a), int(b)) for a, b in zip(at, at[1:])]
    windows = [np.full((len(x), 1), v) for v in (low, high)]
    ids = np.arange(len(x))[order]
    tree = hn.Tree(x[order], np.linalg.norm(x[order].astype(float), axis=1), node[parent[order]], edge[order], levels, ids, ids, labels[order], *windows)
    return tree, hn.Best(tree, k)


def test_tree_is_minimal_and_bounds_spare_scores():
    rng = np.random.default_rng(6)
    centre = (rng.standard_normal((1, 16)) * 300).astype(np.int64)
    x = centre + rng.integers(-2, 3, (40, 16))
    parent, edge, depth = hn.spanning_tree(x)
    d = np.linalg.norm((x[:, None] - x[None]).astype(float), axis=2)
    joined, total = {0}, 0.0
    while len(joined) < len(x):
        i, j = min(((i, j) for i in joined for j in range(len(x)) if j not in joined), key=lambda p: d[p])
        total, joined = total + d[i, j], joined | {j}
    assert edge.sum() == pytest.approx(total) and (depth == 0).sum() == 1
    labels = np.zeros(len(x), int)
    tree, best = tree_of(x, labels)
    others = (rng.standard_normal((3000, 16)) * 300).astype(np.int64)
    ids = np.arange(1000, 4000)
    first = hn.scan_block(best, ids, np.zeros(3000, int), others, True)
    again = hn.scan_block(best, ids + 5000, np.zeros(3000, int), others - 1, True)
    assert again < 0.2 * len(x) * 3000 <= first
    scores = tree.x @ np.vstack([others, others - 1]).T
    for a in range(len(x)):
        want = sorted(zip(-scores[a], np.r_[ids, ids + 5000], strict=True))[:3]
        assert list(zip(*best.found[a, 0], strict=True)) == [(i, -s) for s, i in want]
