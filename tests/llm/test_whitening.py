"""Whitening against a dense eigendecomposition of the covariance."""

import math

import numpy as np
import pytest

from presswork.llm import whitening as wh
from presswork.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def brute(rows, components=16):
    """(key, x) of usable rows, n, S, eigenvalues and eigenvectors of the distinct ones."""
    good = [(k, v) for k, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    sizes = [len(v) for _, v in good]
    usual = min(set(sizes), key=lambda s: (-sizes.count(s), s))
    good = [(k, [math.floor(64 * c) + 1_000_000 for c in v]) for k, v in good if len(v) == usual]
    fit = np.array(sorted({tuple(x) for _, x in good}), dtype=np.int64)
    n, sums = len(fit), fit.sum(axis=0)
    c = fit - sums / n
    values, q = np.linalg.eigh(c.T @ c / n)
    return good, n, sums, values[::-1][:components], q[:, ::-1][:, :components], values.sum()


def check(found, rows, components=16, tolerance=1e-8):
    good, n, sums, values, q, trace = brute(rows, components)
    kept = values > 1e-12 * values[0]
    values, q = values[kept], q[:, kept]
    k = len(values)
    expected = sorted((key, sum((n * a - int(s)) ** 2 for a, s in zip(x, sums, strict=True)), tuple(x)) for key, x in good)
    assert len(found) == len(expected) * k
    found = sorted(found, key=lambda r: (r.vec_id, r.deviation))
    x = np.array([e[2] for e in expected], dtype=float)
    z = (x - sums / n) @ (q / np.sqrt(values))
    by_row = [found[i : i + k] for i in range(0, len(found), k)]
    got = np.zeros((len(by_row), k))
    for i, (some, e) in enumerate(zip(by_row, expected, strict=True)):
        assert {(r.vec_id, r.deviation, r.n) for r in some} == {(e[0], e[1], n)}
        assert sorted(r.component for r in some) == list(range(1, k + 1))
        for r in some:
            got[i, r.component - 1] = r.whitened
            assert r.explained == pytest.approx(values[r.component - 1] / trace, rel=1e-9)
            assert r.identity_error < 1e-9
    signs = np.sign((got * z).sum(axis=0))
    assert np.abs(got - z * signs).max() < tolerance


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_query(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    check(QUERIES["op12_whitening"](spark, FOLDER).collect(), rows)


@pytest.mark.parametrize("spectrum", ["gaps", "flat", "steps", "thin"])
def test_spectra(spark, spectrum):
    rng = np.random.default_rng(3)
    d = 90
    scales = {
        "gaps": 2.0 ** -np.arange(d).clip(max=20) * 1e6,
        "flat": np.ones(d) * 50,
        "steps": np.repeat([300.0, 100.0, 30.0], 30),
        "thin": np.r_[np.full(5, 20.0), np.zeros(d - 5)],
    }[spectrum]
    turn, _ = np.linalg.qr(rng.standard_normal((d, d)))
    x = (rng.standard_normal((700, d)) * scales) @ turn
    rows = [(i, v.tolist()) for i, v in enumerate(x / 64 if spectrum != "thin" else x)]
    df = table(spark, rows)
    # the gaps of a thin spectrum are of 1e-9 of its first value, so both sides round
    check(wh.whiten(df, wh.fit(df)).collect(), rows, tolerance=1e-4 if spectrum == "thin" else 1e-6)


HARD = [
    (1, [0.5, -0.25, 2.0]), (1, [0.5, -0.25, 2.0]), (2, [0.5, -0.25, 2.0]), (3, [1e6, 3.0, -7.0]), (4, None), (5, []),
    (6, [1.0, None, 2.0]), (7, [1.0, float("nan"), 2.0]), (8, [1.0, float("inf"), 2.0]), (9, [1.0, 2.0]), (10, [0.0, 0.0, 0.0]),
    (11, [-1.0, 4.0, 0.01]), (12, [9.0, 4.0, 0.3]),
]


def test_null_unusable_repeated_and_extra_columns(spark):
    df = table(spark, HARD).selectExpr("*", "1 AS n", "2 AS component", "'x' AS whitened", "3 AS deviation")
    model = wh.fit(df)
    assert model.n == 5
    check(wh.whiten(df, model).collect(), HARD)
    nulls = table(spark, [(None, [1.0, 0.0]), (2, [0.0, 3.0]), (3, [2.0, 2.0])])
    assert sum(r.vec_id is None for r in wh.whiten(nulls, wh.fit(nulls)).collect()) == 2


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [2.0, 3.0])], [(1, [2.0, 3.0]), (2, [2.0, 3.0])]])
def test_nothing_to_whiten(spark, rows):
    df = table(spark, rows)
    out = wh.whiten(df, wh.fit(df))
    assert out.count() == 0 and out.columns[:3] == ["vec_id", "component", "n"]


def test_deviations_beyond_64_bits_are_null():
    x = np.array([[2**33, 0], [1, 1]], dtype=np.int64)
    got = wh.deviations(x, np.zeros(2, np.int64), np.array([1, 0]), 3).to_pylist()
    assert got == [None, 4 + 9]


def test_sums_in_lanes(spark, monkeypatch):
    monkeypatch.setattr(wh, "BLOCK", 40)
    monkeypatch.setattr(wh, "LANES", 2)
    rng = np.random.default_rng(1)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((400, 20)))]
    df = table(spark, rows)
    check(wh.whiten(df, wh.fit(df)).collect(), rows)


def test_filter_is_small_below_and_large_above():
    class Diagonal:
        d = 5

        def times(self, q):
            return np.diag([9.0, 5.0, 2.0, 1.0, 0.5]) @ q

    v, q = Diagonal(), np.eye(5)
    got = np.abs(np.diag(wh.filtered(v, q, v.times(q), 0.5, 2.0, 9.0, 8)))
    assert got[0] == pytest.approx(1.0) and 1e-4 < got[1] < 1 and got[2:].max() < 1e-6


def test_rotations_keep_small_eigenvalues():
    scales = np.array([1e8, 1e3, 1.0, 1e-4])
    rng = np.random.default_rng(2)
    near = np.eye(4) + 0.3 * (lambda a: a + a.T)(np.triu(rng.random((4, 4)), 1))
    h = np.sqrt(scales)[:, None] * near * np.sqrt(scales)
    turn = wh.jacobi(h)
    rest = turn.T @ h @ turn
    assert np.abs(turn.T @ turn - np.eye(4)).max() < 1e-12
    assert np.linalg.det(near) * scales.prod() == pytest.approx(np.diag(rest).prod(), rel=1e-9)
