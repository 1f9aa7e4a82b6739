import random

import pytest
from pyspark.sql import functions as F

from presswork.operators import sampling as sm
from presswork.plans import global_rank, lookup_join, running_sums, staged
from presswork.plans.lookup import fits_broadcast


def test_global_rank_over_many_partitions(spark):
    values = [(i, (i * 37) % 101) for i in range(1000)]
    df = spark.createDataFrame(values, "id int, v int").repartition(13)
    ranked = {r.id: (r["rank"], r.total) for r in global_rank(df, [F.desc("v"), "id"], total="total").collect()}
    expected = sorted(values, key=lambda t: (-t[1], t[0]))
    assert all(ranked[row[0]] == (i, 1000) for i, row in enumerate(expected, start=1))


@pytest.mark.parametrize("by", [None, "g"])
def test_running_sums(spark, by):
    random.seed(1)
    values = [(i, random.choice("ab"), random.randint(0, 5)) for i in range(500)]
    df = spark.createDataFrame(values, "id int, g string, v int").repartition(7)
    got = {r.id: r.s for r in running_sums(df, ["id"], {"s": "v"}, by=by).collect()}
    total = {}
    for i, g, v in values:
        key = g if by else None
        total[key] = total.get(key, 0) + v
        assert got[i] == total[key]


@pytest.mark.parametrize("limits", [{}, {"broadcast_rows": 2}, {"broadcast_rows": 2, "heavy_keys": 1, "part_rows": 9}])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_lookup_join_paths_agree(spark, limits, how):
    big = spark.createDataFrame([(i, "hot" if i % 3 == 0 else f"k{i % 7}") for i in range(90)], "id int, k string")
    keyed = staged(spark.createDataFrame([("hot", 30)] + [(f"k{i}", 9) for i in range(5)], "k string, w int"))
    got = lookup_join(big, keyed, "k", how, weight="w", **limits)
    expected = big.join(keyed, "k", how)
    assert sorted(map(tuple, got.select(*expected.columns).collect()), key=str) == sorted(
        map(tuple, expected.collect()), key=str
    )


def test_a_word_of_every_row_is_split(spark):
    big = spark.range(1000).select("id", F.lit("the").alias("k"))
    keyed = staged(spark.createDataFrame([("the", 1000), ("rare", 1)], "k string, w int"))
    joined = lookup_join(big, keyed, "k", weight="w", broadcast_rows=0, part_rows=100)
    plan = joined._jdf.queryExecution().toString()
    assert "_part" in plan and joined.count() == 1000
    parts = joined.groupBy(F.pmod(F.xxhash64("id", "k"), F.lit(10))).count().collect()
    assert len(parts) == 10


def test_wide_rows_are_not_broadcast(spark):
    keyed = staged(spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("text")))
    assert fits_broadcast(keyed) and not fits_broadcast(keyed, size=50_000) and not fits_broadcast(keyed, rows=99)


@pytest.mark.parametrize("n, sizes", [(12, [3, 3, 2, 2, 2]), (10, [2] * 5), (3, [1, 1, 1])])
def test_fold_sizes(spark, n, sizes):
    df = spark.range(n).withColumnRenamed("id", "doc_id")
    rows = sm.assign_folds(df, 5).orderBy("doc_id").collect()
    assert [r.fold for r in rows] == [f for f, size in enumerate(sizes) for _ in range(size)]


def test_sample_is_seeded_and_without_replacement(spark):
    df = spark.range(100).withColumnRenamed("id", "doc_id")
    first = [r.doc_id for r in sm.sample_n(df, 10, 123).collect()]
    assert first == [r.doc_id for r in sm.sample_n(df.repartition(5), 10, 123).collect()]
    assert len(set(first)) == 10
    assert set(first) != {r.doc_id for r in sm.sample_n(df, 10, 1).collect()}
