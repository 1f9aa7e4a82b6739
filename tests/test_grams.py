"""Runs counted inside rows against the columns of all runs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from presswork.functions import text as tx
from presswork.operators import grams as gr
from presswork.operators import terms as tm

TEXTS = ["oil price oil price oil", "Oil  \n price", "game team price oil price", "team", "", None, "a", "ab\x00c\x00c ab\x00c", "h\U0001f600h\U0001f600h", "team game oil", "price oil price"]
TEXTS += ["é È  é è price oil"]


def chars(low=2, high=3):
    return gr.CharGrams(F.col("text"), low, high)


def words(low=2, high=3):
    return gr.WordGrams(tx.word_tokens(F.col("text")), low, high)


KINDS = [(chars, 2, 3, 7), (words, 1, 4, 1 << 18)]


@pytest.fixture(scope="module")
def docs(spark):
    # 30 and the null key are shared: their rows count as one document
    rows = [(i, i % 2, t) for i, t in enumerate(TEXTS)] + [(30, 0, TEXTS[0]), (30, 0, TEXTS[2]), (30, 1, TEXTS[0]), (None, 0, TEXTS[0]), (None, 0, TEXTS[2]), (31, None, TEXTS[2])]
    return spark.createDataFrame(rows, "doc_id bigint, part int, text string")


def _same(new, old):
    assert new.columns == old.columns
    key = lambda r: tuple(round(v, 12) if isinstance(v, float) else str(v) for v in r)
    got, expected = sorted(map(key, new.collect()), key=str), sorted(map(key, old.collect()), key=str)
    assert got == expected and got


@pytest.mark.parametrize("kind", KINDS)
def test_counts_frequencies_and_weights_of_the_columns(docs, kind, monkeypatch):
    make, low, high, at_once = kind
    grams = make(low, high)
    monkeypatch.setattr(gr, "AT_ONCE", at_once)
    _same(tm.term_counts(docs, grams, ("part",)), tm.term_counts(docs, grams.column, ("part",)))
    _same(tm.document_frequencies(docs, grams, 2), tm.document_frequencies(docs, grams.column, 2))
    _same(tm.term_totals(docs, grams), tm.term_totals(docs, grams.column))
    known = tm.fit_vocabulary(docs, grams, 2)
    _same(tm.count_vectorize(docs, grams, known, ("part",)), tm.count_vectorize(docs, grams.column, known, ("part",)))
    _same(tm.tfidf(docs, grams, known, 9, ("part",), None), tm.tfidf(docs, grams.column, known, 9, ("part",), None))


def test_a_vocabulary_too_large_to_send(docs, monkeypatch):
    grams = words()
    known = tm.fit_vocabulary(docs, grams, 2)
    monkeypatch.setattr(tm, "fits_broadcast", lambda vocabulary: False)
    _same(tm.tfidf(docs, grams, known, 9, ("part",)), tm.tfidf(docs, grams.column, known, 9, ("part",)))


def test_no_occurrence_is_hashed_or_moved(docs):
    """One row a document and run leaves the task; nothing is exploded, grouped or windowed by document."""
    single = docs.where("doc_id < 30")
    known = tm.fit_vocabulary(single, chars(), 2)
    plan = tm.tfidf(single, chars(), known, 9)._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in ("Generate", "Window", "Exchange", "Aggregate") if word in plan]


def test_rows_of_more_symbols_than_a_number_holds():
    codes = np.array([0, 1, 2, 0, 1, 2, 9, 9])
    for size in (10, 3_000_000):
        row, run, n = gr._runs(codes, np.array([6, 2]), size, 2, 3)
        found = sorted((r, tuple(x for x in line if x < size), c) for r, line, c in zip(row.tolist(), run.tolist(), n.tolist()))
        assert found == [(0, (0, 1), 2), (0, (0, 1, 2), 2), (0, (1, 2), 2), (0, (1, 2, 0), 1), (0, (2, 0), 1), (0, (2, 0, 1), 1), (1, (9, 9), 1)]
