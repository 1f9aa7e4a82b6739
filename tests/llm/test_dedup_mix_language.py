"""Exact dedup, mixing and language ID on odd rows, and against SQL on the given tables."""

import hashlib

import pytest
from check import compare, connect
from pyspark.sql import functions as F

from presswork.llm import exact_dedup, language_id, mixing
from presswork.llm.queries import ORACLE_SQL, QUERIES
from presswork.llm.shared import remainder

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, size string"
LONG = "mot été " * 50_000
ROWS = [
    (1, "same", "en", "a", None), (2, "same", None, "b", None), (3, None, "en", None, None), (4, "", "fr", "", None), (5, "Same", "en", "a", None),
    (6, LONG, "fr", "a", None), (7, LONG, "fr", "b", None), (8, "x y", "en", "b", None), (8, "x y", "en", "b", None), (None, "same", "en", "a", None), (9, "123 !!", "en", "a", None),
]


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_equal_sql(spark, con, name):
    verdict = compare(QUERIES[name](spark, FOLDER).toPandas(), con.execute(ORACLE_SQL[name]).df())
    assert verdict.startswith("ok"), verdict


@pytest.mark.parametrize("hashed", [exact_dedup.text_hash, lambda t: F.unhex(F.lpad(F.hex(F.length(t) % 3), 4, "0"))])
def test_exact_groups_whatever_the_hash(spark, hashed):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = exact_dedup.exact_groups(docs, hashed=hashed).collect()
    assert len(got) == len(ROWS)
    by_text = {}
    for key, text, *_ in ROWS:
        by_text.setdefault(text or "", []).append(key)
    for r in got:
        text = next(t or "" for t in by_text if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        keys = by_text[text]
        assert r.group_size == len(keys) and r.keep_id == max(k for k in keys if k is not None) and r.doc_id in keys
    assert sum(r.kept for r in got) == len(by_text)
    assert [sorted(r.kept for r in got if r.doc_id == i) for i in (8, 7, 6, None)] == [[False, True], [True], [False], [False]]
    assert exact_dedup.exact_groups(docs.where("false")).count() == 0
    left = exact_dedup.drop_copies(docs.where("doc_id < 8"))
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [2, 4, 5, 7]


def test_one_row_of_each_text_stays(spark):
    again = [(8, "x y", "en", "c", "other source"), (8, "another text", "en", "c", None), (None, "only null", "en", "a", None), (None, "only null", "en", "a", None)]
    docs = spark.createDataFrame([*ROWS, *again, (2, "x y", "en", "b", None)], SCHEMA)
    left = exact_dedup.drop_copies(docs)
    got = left.collect()
    assert left.columns == docs.columns and {tuple(r) for r in got} <= {tuple(r) for r in docs.collect()}
    keys = {"same": 2, "": 4, "Same": 5, LONG: 7, "x y": 8, "123 !!": 9, "another text": 8, "only null": None}
    assert sorted((r.text or "", str(r.doc_id)) for r in got) == sorted((t, str(k)) for t, k in keys.items())


def test_mixture_on_odd_rows(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = mixing.mixture(docs).collect()
    assert len(got) == len(ROWS)
    assert [r.taken for r in got if r.doc_id in (3, 4)] == [0, 0]
    assert all(r.taken in (0, r.size, 2 * r.size) and r.target <= 2 * r.source_size for r in got)
    again = mixing.mixture(docs.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.mixture(docs.where("false")).count() == 0
    assert mixing.mixture(docs.where("doc_id in (3, 4)")).agg(F.sum("taken")).first()[0] == 0
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.taken // r.size for r in got if r.size)


def test_mix_carries_columns_of_any_name(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    plain = sorted(str(tuple(r)) for r in mixing.mix(docs).collect())
    names = ["target", "n", "last", "epochs", "_size", "_copies", "_src", "_key", "source_size", "row", "_row", "id", "col", "_copy"]
    odd = docs.select("*", *[F.lit(f"own {c}").alias(c) for c in names if c not in docs.columns])
    found = mixing.mix(odd)
    assert found.columns == odd.columns
    assert sorted(str(tuple(r)) for r in found.select(docs.columns).collect()) == plain
    for c in set(names) - set(docs.columns):
        assert {r[0] for r in found.select(c).distinct().collect()} == {f"own {c}"}


def test_mixture_meets_its_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sums = mixing.mixture(docs).join(docs.select("doc_id", "source"), "doc_id").groupBy("source")
    for r in sums.agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("size").alias("most")).collect():
        assert abs(r.taken - r.target) <= r.most / 2 + 1


def test_heavier_documents_are_drawn_more_often(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "plain word here").otherwise("# # # # # # word").alias("text"), F.lit("s").alias("source"))
    more = [docs.withColumn("doc_id", F.col("doc_id") + 10_000 * i).withColumn("source", F.lit(s)) for i, s in ((1, "t"), (2, "u"))]
    docs = docs.unionByName(more[0]).unionByName(more[1])
    quality = lambda text: F.when(text.startswith("#"), 0.2).otherwise(1.0)
    # of the last source, two thirds are taken twice
    got = mixing.mixture(docs, quality=quality).where("taken > size and doc_id >= 20000").join(docs, "doc_id").groupBy(F.col("text").startswith("#").alias("bad")).count()
    counts = {r.bad: r["count"] for r in got.collect()}
    assert counts.get(False, 0) > 1.3 * counts.get(True, 0)


def test_language_against_plain_naive_bayes(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = language_id.train(docs, remainder("doc_id", 3) != 1)
    held = language_id.predict(docs.where(remainder("doc_id", 3) == 1), model).collect()
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.95
    # the score is the posterior of the matrix, one n-gram after the other
    import numpy as np
    import pyarrow as pa

    for r in held[:10]:
        points, bounds = language_id.characters(pa.array([r.text]))
        total = model.prior.copy()
        for hashed, crossing in language_id.grams(points, bounds):
            for at in set(range(len(hashed))) - set(crossing.tolist()):
                total += model.log_prob[:, hashed[at]]
        p = np.exp(total - total.max())
        assert r.lang_pred == model.languages[int(total.argmax())] and abs(r.score - p.max() / p.sum()) < 1e-3


def test_language_on_odd_rows(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).withColumnRenamed("size", "n_grams")
    model = language_id.train(docs, F.lit(True))
    got = language_id.predict(docs, model).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    assert [r.lang_pred for r in got if r.doc_id in (3, 4, 9)] == ["und"] * 3
    nothing = language_id.train(docs.where("false"), F.lit(True))
    assert {r.lang_pred for r in language_id.predict(docs, nothing).collect()} == {"und"}
    with pytest.raises(ValueError):
        language_id.predict(docs.withColumnRenamed("n_grams", "SCORE"), model)
