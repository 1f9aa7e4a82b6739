"""NumPy's files through Spark: NumPy reads what is written, and the other way round."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from presswork.sources import numpy_files as nf


def rows_of(df):
    return sorted((r.key, tuple(r.vector)) for r in df.collect())


def test_round_trip_and_numpy_reads_the_archives(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(0)
    made = [(int(i), rng.standard_normal(5).tolist()) for i in rng.permutation(500)]
    df = spark.createDataFrame(made, "id long, v array<double>").repartition(3)
    path = str(tmp_path / "vectors")
    nf.save_numpy(df, path, "id", "v")
    want = sorted((k, tuple(v)) for k, v in made)
    assert rows_of(nf.load_numpy(spark, path)) == want
    assert rows_of(nf.load_numpy(spark, path, range_bytes=400)) == want
    files = json.loads((tmp_path / "vectors" / nf.LISTED).read_text())
    read = []
    for f in files:
        with np.load(tmp_path / "vectors" / f["name"]) as one:
            read += [(int(k), tuple(v)) for k, v in zip(one["keys"], one["vectors"], strict=True)]
    assert sorted(read) == want
    # a file that no task committed is not read; written again, only the new rows are there
    np.savez(tmp_path / "vectors" / "part-stray.npz", keys=np.array([1]), vectors=np.zeros((1, 5)))
    assert nf.load_numpy(spark, path).count() == 500
    nf.save_numpy(df.where("id < 10"), path, "id", "v")
    assert nf.load_numpy(spark, path).count() == 10
    nf.save_numpy(df.where("id >= 490"), path, "id", "v", overwrite=False)
    assert rows_of(nf.load_numpy(spark, path)) == [w for w in want if w[0] < 10 or w[0] >= 490]


@pytest.mark.parametrize("kind", ["<f4", "<f8", ">f4", "<i2"])
def test_files_that_numpy_wrote(spark, tmp_path, kind):
    x = (np.arange(700 * 3).reshape(700, 3) / 7).astype(kind)
    np.save(tmp_path / "x.npy", x)
    want = sorted((i, tuple(v)) for i, v in enumerate(x.astype(float).tolist()))
    assert rows_of(nf.load_numpy(spark, str(tmp_path / "x.npy"), range_bytes=1000)) == want
    assert nf.load_numpy(spark, str(tmp_path / "x.npy"), range_bytes=1000).select(F.spark_partition_id().alias("p")).distinct().count() > 1
    for save in (np.savez, np.savez_compressed):
        save(tmp_path / "x.npz", vectors=x, keys=np.arange(700) + 5)
        assert rows_of(nf.load_numpy(spark, str(tmp_path / "x.npz"), range_bytes=1000)) == [(i + 5, v) for i, v in want]


def test_odd_arrays(spark, tmp_path):
    np.save(tmp_path / "line.npy", np.array([1.5, 2.5]))
    assert rows_of(nf.load_numpy(spark, str(tmp_path / "line.npy"))) == [(0, (1.5,)), (1, (2.5,))]
    np.save(tmp_path / "none.npy", np.empty((0, 4)))
    assert nf.load_numpy(spark, str(tmp_path / "none.npy")).count() == 0
    empty = spark.createDataFrame([], "id long, v array<double>")
    nf.save_numpy(empty, str(tmp_path / "empty"), "id", "v")
    assert nf.load_numpy(spark, str(tmp_path / "empty")).count() == 0
    np.save(tmp_path / "turned.npy", np.asfortranarray(np.zeros((3, 2))))
    with pytest.raises(Exception, match="rows first"):
        nf.load_numpy(spark, str(tmp_path / "turned.npy")).count()


@pytest.mark.parametrize("rows", [[(None, [1.0])], [(1, None)], [(1, [None])], [(1, [1.0]), (2, [1.0, 2.0])]])
def test_rows_that_no_matrix_holds(spark, tmp_path, rows):
    with pytest.raises(Exception, match="null|length"):
        nf.save_numpy(spark.createDataFrame(rows, "id long, v array<double>"), str(tmp_path / "bad"), "id", "v")
