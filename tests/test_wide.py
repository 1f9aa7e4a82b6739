"""Models on more features than rows: against the fits of ``linear``, and with no weights on the driver."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from presswork.operators import linear as lm
from presswork.operators import wide as wd
from presswork.plans import sums

N, WIDTH = 40, 600


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    made = []
    for i in range(N):
        at = [] if i == 7 else sorted(rng.choice(WIDTH - 1, 30, replace=False).tolist())
        made.append((i // 2, i % 3, i % 4, at, rng.standard_normal(len(at)).tolist()))  # keys repeat
    return spark.createDataFrame(made, "doc_id long, label int, fold int, indices array<int>, values array<double>").repartition(3).persist()


MASK = {"half": (np.arange(WIDTH) % 2).astype(float)}
ALL = [lm.Problem(k, loss, c=c, tolerances=(1e-6,), held=h, mask=m) for k, loss, c, h, m in [
    (0, "logistic", 1.0, -1, None), (1, "squared_hinge", 5.0, 2, None), (2, "squared_hinge", 0.1, -1, "half")]]


def test_same_weights_as_by_features(rows, monkeypatch):
    monkeypatch.setattr(wd, "GROUP_BYTES", 8 * N * wd.VECTORS * 2)  # two groups
    fits = wd.fit_wide(rows, WIDTH, ALL, MASK)
    want = lm.fit_many(rows, WIDTH, ALL, MASK)
    got = np.zeros((WIDTH, len(ALL)))
    for r in fits.table.collect():
        got[r.position] = r.w
    assert max(fits.reached) <= 1e-6 and fits.table.where("position = 599").count() == 0
    for i, fit in enumerate(want):
        assert np.abs(got[:, i] - fit.weights[-1][:-1]).max() < 1e-4 and fits.biases[i] == pytest.approx(fit.weights[-1][-1], abs=1e-4)
    assert not got[::2, 2].any()
    keys = ["class_id", "doc_id", "y", "score"]
    a = wd.scored(rows, fits).toPandas().sort_values(keys).reset_index(drop=True)
    b = lm.scored(rows, WIDTH, want).toPandas().sort_values(keys).reset_index(drop=True)
    assert len(a) == N * len(ALL) and np.allclose(a.score, b.score, atol=1e-4) and (a[["doc_id", "class_id", "y", "pred"]] == b[["doc_id", "class_id", "y", "pred"]]).all(axis=None)
    top = [(r.class_id, r.position, r["rank"]) for r in wd.strongest(fits, 5).orderBy("class_id", "rank").collect()]
    assert top == [(c, p, r) for c, p, _, r in lm.strongest(want, 5)]


def test_without_rows_the_weights_are_0(rows):
    fits = wd.fit_wide(rows.limit(0), WIDTH, ALL[:2])
    assert fits.table.count() == 0 and fits.biases == [0.0, 0.0]
    with pytest.raises(ValueError):
        wd.fit_wide(rows, WIDTH, [lm.Problem(0, l1=True)])


def test_nothing_as_long_as_the_weights_reaches_the_driver(rows, monkeypatch):
    sizes = []
    monkeypatch.setattr(wd, "array_sums", lambda df, work, size, tasks: sizes.append(size / (N + tasks)) or sums.array_sums(df, work, size, tasks))
    wd.fit_wide(rows, WIDTH, ALL[:2], max_passes=5)
    assert sizes and max(sizes) <= 2  # numbers for each row, not for each feature


def test_large_sums_reach_the_driver_once(spark, monkeypatch):
    monkeypatch.setattr(sums, "DIRECT", 100)
    monkeypatch.setattr(sums, "PART", 7)
    got = []
    real = type(spark.range(1)).toArrow
    monkeypatch.setattr(type(spark.range(1)), "toArrow", lambda df: got.append(real(df)) or got[-1])

    def work(batches):
        for batch in batches:
            yield np.full(20, float(sum(batch.column("id").to_pylist())))

    total = sums.array_sums(spark.range(0, 100, numPartitions=24).select(F.col("id")), work, 20, 24)
    assert total.tolist() == [4950.0] * 20 and got[-1].num_rows == 3
