"""Forced-boundary encoding against the tokenizers library, and the merges against plain scans."""

import hashlib
import random
from array import array

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from presswork.llm import forced_bpe as fb
from presswork.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
MINE = fb.Encoder(PATH)
FOLDER = "/root/testdata/sf0.001"


def expected(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def mine(text):
    return array("i", MINE.ids(text)).tolist()


@settings(max_examples=500, deadline=None)
@given(st.text(max_size=40))
def test_any_text(text):
    assert mine(text) == expected(text)


PARTS = [*"aAbjJhtTsSdDiIKé̱̌̇́ßİıΣςσ漢🙂👍🏽‍0½٣.,!?'-#", " ", "\t", "\n", "\xa0", "\x85", "\x1c", "\x00", " ", "ﬁ", "が", "が", "K",
         "'ll", "don't", "'tis", "<|endoftext|>", "<|EndOfText|>", "<|startoftext|", "qzx", "été.", "end.,"]


def test_hard_mixtures():
    rng = random.Random(5)
    for _ in range(20000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 9)))
        assert mine(text) == expected(text), repr(text)


@pytest.mark.parametrize("text", ["a" * 30000, "the" * 9000 + "ing", "é" * 4000, "?!" * 5000, "zq" * 5000, "hello " * 5000, "a b" * 3 + "́" * 500])
def test_long_words(text):
    assert mine(text) == expected(text)


def test_a_cut_is_never_inside_a_token():
    vocabulary = LIBRARY.get_vocab(with_added_tokens=False)
    inner, final = fb.pairs_inside(vocabulary, "</w>")
    for token in vocabulary:
        ends = token.endswith("</w>") and token != "</w>"
        letters = token.removesuffix("</w>") if ends else token
        pairs = [letters[i : i + 2] for i in range(len(letters) - 1)]
        assert all(p in inner for p in (pairs[:-1] if ends else pairs))
        assert not (ends and pairs) or pairs[-1] in final
    assert len(inner) < 256 * 256 / 10  # most pairs are certain cuts


def test_fragments_of_words_without_an_ending_use_the_same_merges():
    rng = random.Random(3)
    for _ in range(300):
        letters = [MINE.vocabulary[rng.choice("abcdeinorst")] for _ in range(rng.randint(0, 80))]
        assert fb.merge_queued(list(letters), MINE.merges) == fb.merge_scanned(list(letters), MINE.merges)


ROWS = [(1, "Hello, World!"), (2, None), (3, ""), (3, "x" * 5000), (None, "null key"), (5, "same"), (5, "same"), (6, "<|endoftext|> été")]


def test_null_empty_repeated_and_extra_columns(spark):
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(ROWS)], "doc_id long, text string, added long")
    found = fb.decode(fb.encode(docs, PATH), PATH).orderBy("added").collect()
    again = fb.round_trip(docs, PATH).orderBy("added").collect()
    assert found == again
    for row, (key, text) in zip(found, ROWS, strict=True):
        ids = expected(text or "")
        assert (row.doc_id, row.text, row.ids) == (key, text, ids)
        assert row.decoded == LIBRARY.decode(ids, skip_special_tokens=False)
    with pytest.raises(ValueError, match="ids"):
        fb.encode(docs.withColumnRenamed("added", "IDS"), PATH)
    empty = fb.round_trip(docs.limit(0), PATH)
    assert empty.count() == 0 and empty.columns == ["doc_id", "text", "added", "ids", "decoded"]


def test_decode_of_null_and_unknown_ids(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [None, 320, 10**6])], "k int, ids array<int>")
    found = {r.k: r.decoded for r in fb.decode(rows, PATH).collect()}
    assert found == {1: "", 2: "", 3: LIBRARY.decode([320], skip_special_tokens=False)}


def test_query_against_the_library(spark):
    rows = {r.doc_id: r for r in QUERIES["op11_forced_bpe"](spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    assert len(rows) == len(docs)
    for doc in docs:
        ids = expected(doc.text)
        row = rows[doc.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()
