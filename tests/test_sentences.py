"""Abbreviations and sentences on texts made by hand."""

import math

from presswork.operators import sentences as st
from presswork.plans import staged


def made(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


TEXTS = [
    "Mr. Smith met Mr. Jones of Acme Corp. in Rome. They spoke.",
    "Mr. Brown of Acme Corp. Berlin went home. He was late!",
    "The home of Mr. Green is old. Was it sold? It was.",
    "They met in Rome and spoke. J. Doe paid 3.50 dollars.",
    None,
    "",
    " \n ",
    "An old home of the old town was sold, not spoke of, and was old",
]


def test_scores_by_the_formula(spark):
    docs = made(spark, TEXTS * 20)
    got = {r.word: r for r in st.abbreviation_scores(docs).collect()}
    tokens = [t for text in TEXTS * 20 for t in (text or "").split()]
    periods = sum(t.endswith(".") for t in tokens)
    for word, r in got.items():
        both = sum(t.lower() == word + "." for t in tokens)
        alone = sum(t.lower() == word for t in tokens)
        assert (r.with_period, r.without_period) == (both, alone) and both > 0
        p = periods / len(tokens)
        ratio = -2 * (both * math.log(p) + alone * math.log(1 - p) - both * math.log(0.99) - alone * math.log(0.01))
        letters = len(word.replace(".", ""))
        assert math.isclose(r.score, ratio * math.exp(-letters) * (word.count(".") + 1) * float(letters) ** -alone, rel_tol=1e-9, abs_tol=1e-300)
    assert got["mr"].score > st.LEAST_SCORE and got["corp"].score > st.LEAST_SCORE
    assert got["home"].score < st.LEAST_SCORE and got["rome"].score < st.LEAST_SCORE


def test_abbreviations_inside_texts_end_no_sentence(spark):
    docs = made(spark, TEXTS * 20)
    scores = staged(st.abbreviation_scores(docs), "scores")
    rows = st.split_sentences(docs.where("doc_id < 7"), scores).orderBy("doc_id").collect()
    assert [r.sentences for r in rows] == [
        ["Mr. Smith met Mr. Jones of Acme Corp. in Rome.", "They spoke."],
        ["Mr. Brown of Acme Corp. Berlin went home.", "He was late!"],
        ["The home of Mr. Green is old.", "Was it sold?", "It was."],
        ["They met in Rome and spoke.", "J. Doe paid 3.50 dollars."],
        [],
        [],
        [],
    ]


def test_nothing_and_repeated_keys(spark):
    docs = made(spark, TEXTS).limit(0)
    assert st.abbreviation_scores(docs).count() == 0
    scores = staged(st.abbreviation_scores(docs), "scores")
    assert st.split_sentences(docs, scores).count() == 0
    twice = spark.createDataFrame([(1, "One. Two."), (1, "Three. Four."), (None, "Five")], "doc_id long, text string")
    found = sorted(map(str, (r.sentences for r in st.split_sentences(twice, scores).collect())))
    assert found == ["['Five']", "['One.', 'Two.']", "['Three.', 'Four.']"]
