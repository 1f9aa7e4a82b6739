"""Nearest neighbours against brute force over all vectors."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from presswork.llm import neighbours as nn


def brute(rows, asks, k=10):
    """Every query's k nearest of all usable rows of the usual length."""
    good = [(i, np.asarray(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    sizes = [len(v) for _, v in good]
    usual = min(sizes, key=lambda n: (-sizes.count(n), n)) if sizes else 0
    good = [(i, v) for i, v in good if len(v) == usual]
    out = {}
    for q, v in good:
        if asks(q):
            found = sorted({(float(np.sqrt(((v - w) ** 2).sum())), i) for i, w in good if i != q})
            out[q] = [(i, d) for d, i in found[:k]]
    return out


def as_lists(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


@pytest.mark.parametrize("dimensions, bits", [(2, 3), (3, 2), (4, 2)])
def test_hilbert_curve_visits_every_cell_in_unit_steps(dimensions, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
    index = nn.hilbert_index(cells, bits)
    assert sorted(index.tolist()) == list(range(len(cells)))
    walk = cells[np.argsort(index)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_recall_on_random_directions(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    got = as_lists(nn.search(vectors, F.col("vec_id") % 100 == 0, least=50, block=256))
    expected = brute(rows, lambda i: i % 100 == 0)
    assert set(got) == set(expected) and all(len(v) == 10 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) for q in got)
    assert hits / sum(map(len, expected.values())) >= 0.9
    plain = {i: np.asarray(v, float) for i, v in rows}
    for q, found in got.items():
        assert all(abs(d - np.sqrt(((plain[q] - plain[i]) ** 2).sum())) < 1e-12 for i, d in found)


def test_copies_ties_and_unusable_vectors(spark):
    rows = [(i, [1.0, 0.0]) for i in range(40)] + [(100 + i, [0.0, float(i)]) for i in range(1, 30)]
    rows += [(200, None), (201, []), (202, [0.0, 0.0]), (203, [1.0, None]), (204, [float("nan"), 1.0]), (205, [float("inf"), 1.0])]
    rows += [(206, [1.0, 2.0, 3.0]), (None, [5.0, 5.0]), (0, [1.0, 0.0]), (210, [-0.0, 7.0])]
    vectors = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, score string, rank int")
    asks = F.col("vec_id") % 10 == 0
    got = as_lists(nn.search(vectors, asks, block=8))
    assert got == brute(rows, lambda i: i % 10 == 0)
    assert [i for i, _ in got[20]] == list(range(10)) and [i for i, _ in got[0]] == list(range(1, 11))


def test_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 2.0]), (2, [3.0, 2.5])], schema)
    assert as_lists(nn.search(few, F.col("vec_id") == 0)) == brute([(0, [1.0, 2.0]), (1, [2.0, 2.0]), (2, [3.0, 2.5])], lambda i: i == 0)
    assert nn.search(few.where("vec_id = 0"), F.lit(True)).count() == 0
    assert nn.search(few.where("false"), F.lit(True)).count() == 0
