import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from presswork.functions import text as tx
from presswork.operators import selection as sel
from presswork.operators import tables as tb
from presswork.operators import terms as tm
from presswork.plans import staged

TEXTS = ["oil price oil", "oil market", "game team price", "team team", "", "market price game"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, 1 + i % 2, t) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id bigint, category int, text string")


def test_tfidf_against_the_formula(docs):
    words = tx.word_tokens(F.col("text"))
    vocabulary = tm.fit_vocabulary(docs, words, 2)
    got = {(r.doc_id, r.term): r.tfidf for r in tm.tfidf(docs, words, vocabulary, len(TEXTS), digits=None).collect()}
    bags = [Counter(t.split()) for t in TEXTS]
    df = Counter(w for b in bags for w in b)
    expected = {}
    for i, b in enumerate(bags):
        raw = {w: (1 + math.log(n)) * (math.log((1 + len(TEXTS)) / (1 + df[w])) + 1) for w, n in b.items() if df[w] >= 2}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        expected.update({(i, w): v / norm for w, v in raw.items()})
    assert got.keys() == expected.keys()
    assert all(abs(got[k] - expected[k]) < 1e-12 for k in got)


def test_word_ids_by_count_then_first_seen(docs):
    rows = tm.build_word_ids(docs, tx.sequence_tokens(F.col("text"))).orderBy("word_id").collect()
    assert [r.word for r in rows] == ["oil", "price", "team", "market", "game"]


def test_anova_matches_direct_formula_and_edge_cases(spark):
    cells = [(d, 1 + d % 2, "same", 1) for d in range(6)]
    cells += [(d, 1 + d % 2, "perfect", 2) for d in range(0, 6, 2)]
    cells += [(d, 1 + d % 2, "some", n) for d, n in ((0, 3), (1, 1), (2, 1))]
    table = spark.createDataFrame(cells, "doc_id bigint, category int, term string, n bigint")
    got = {r.term: r.f_score for r in sel.anova_f(table, {1: 3, 2: 3}).collect()}
    assert got["same"] is None
    assert got["perfect"] == float("inf")
    groups = [[3, 1, 0], [1, 0, 0]]
    mean = sum(map(sum, groups)) / 6
    between = sum(3 * (sum(g) / 3 - mean) ** 2 for g in groups)
    within = sum((x - sum(g) / 3) ** 2 for g in groups for x in g)
    assert got["some"] == pytest.approx(between / (within / 4))
    kept = sel.select_percentiles(sel.anova_f(table, {1: 3, 2: 3}), [34, 67]).collect()
    assert sorted((r.percent, r.term) for r in kept) == [(34, "perfect"), (67, "perfect"), (67, "some")]


def test_describe_by_takes_smallest_of_equal_tops(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (2, "z"), (2, "z")], "category int, t string")
    rows = {r.category: tuple(r)[2:] for r in tb.describe_by(df, "category", ["t"]).collect()}
    assert rows == {1: (2, 2, "a", 1), 2: (2, 1, "z", 2)}


def test_encoded_words_keep_texts_in_their_slices(spark, monkeypatch):
    monkeypatch.setattr(tm, "WORDS_AT_ONCE", 3)
    rows = [(1, ["a", "b", "a", "x"]), (2, []), (3, None), (None, ["a"]), (4, ["b", None, "c"]), (5, ["c"]), (5, ["b", "a"]), (6, ["x"])]
    docs = spark.createDataFrame(rows, "doc_id bigint, words array<string>").repartition(2, "words")
    ids = spark.createDataFrame([("a", 4, 1), ("b", 3, 2), ("c", 2, 3)], "word string, n bigint, word_id bigint")
    made = []
    monkeypatch.setattr(tm, "lookup_join", lambda big, *a, f=tm.lookup_join, **b: (made.append(big.columns), f(big, *a, **b))[1])
    got = sorted((r.doc_id or 0, r.word_ids) for r in tm.encode_words(docs, F.col("words"), staged(ids, "ids")).collect())
    assert got == [(0, []), (1, [1, 2, 1]), (2, []), (3, []), (4, [2, 3]), (5, [2, 3, 1]), (5, [2, 3, 1]), (6, [])]
    # a row for each word of a slice moves; a row for each place only where rows share a key
    assert made == [["of", "at", "word"], ["doc_id", "pos", "word"]]
