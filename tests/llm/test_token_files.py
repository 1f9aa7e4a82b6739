"""Token files against the tokenizer itself, document by document and sequence by sequence."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pyspark.sql import functions as F

from presswork.llm import token_files as tf

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
ENCODER = tf.WordEncoder(PATH)
FOLDER = "/root/testdata/sf0.001"


def plain(text):
    return np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def ids(text):
    return np.frombuffer(ENCODER.ids(text), ENCODER.kind).tolist()


@settings(max_examples=400, deadline=None)
@given(
    st.text(st.characters(exclude_categories=["Cs"]), max_size=40)
    | st.text("aAéÉIİßΣσς ,.'\t\ń̇‍\x1c\x85 KªſŉDž<|endoftext>", max_size=30)
    | st.lists(st.sampled_from(["<|endoftext|>", "<|ENDOFTEXT|>", "don't", "we'll", "naïve,", "x.", ".", "12,5", " "]), max_size=8).map("".join)
)
def test_word_encoder_equals_tokenizer(text):
    assert ids(text) == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(tf, "KEPT_WORDS", 3)
    text = "many words, more words. and many more words"
    assert np.frombuffer(tf.WordEncoder(PATH).ids(text), "<u2").tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


def expected(rows):
    out, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        one = plain(text)
        out.append((key, start, len(one), zlib.crc32(one.tobytes())))
        start += len(one)
    return out


@pytest.mark.parametrize("length", [7, 2048])
def test_documents(spark, length):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").repartition(5)
    files = tf.write_token_files(docs, PATH, 1, length=length)
    got = [tuple(r) for r in tf.read_documents(files).orderBy("doc_id").collect()]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got == expected(rows)

    # every sequence but the last of a file is full, and they hold the stream of ids in order
    stream = np.concatenate([plain(t) for _, t in sorted(rows)])
    for row in files.orderBy("part").collect():
        file = tf.TokenFile(row.tokens)
        assert file.length == length
        views = [file.sequence(i) for i in random.Random(1).sample(range(int(file.starts[-1])), int(file.starts[-1]))]
        assert all(v.base is not None and m.buffers()[1].size >= length // 8 for v, m in views)
        assert sum(m.true_count for _, m in views) == row.n_tokens
        for i in (0, int(file.starts[-1]) // 2, int(file.starts[-1]) - 1):
            values, mask = file.sequence(i)
            mask = mask.to_numpy(zero_copy_only=False)
            assert np.array_equal(values[mask], stream[row.start + i * length :][: int(mask.sum())])
            assert mask.all() or i == file.starts[-1] - 1
        file.close()
    tf.remove(files)


def test_odd_rows(spark):
    rows = [(None, "no key", 1), (5, None, 1), (3, "", 2), (4, "word " * 60_000, 3), (9, "<|endoftext|>", None), (-1, "dash -- x", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int")
    got = [tuple(r) for r in tf.read_documents(tf.write_token_files(docs, PATH, 1, length=100)).orderBy("start").collect()]
    assert got == expected([r[:2] for r in rows])
    twice = tf.read_documents(tf.write_token_files(docs.unionByName(docs), PATH, 1)).collect()
    assert len(twice) == 12 and sorted(r.n_tokens for r in twice) == sorted([r[2] for r in got] * 2)
    assert tf.read_documents(tf.write_token_files(docs.where("false"), PATH, 1)).count() == 0


def test_capitals_before_joining_marks():
    for text in ("J\u030c", "Aj\u030c H\u0331 T\u0308x", "J\u030c, and Plain Words"):
        assert ids(text) == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_one_key_fills_many_files(spark, monkeypatch):
    monkeypatch.setattr(tf, "PART_BYTES", 2000)
    docs = spark.range(300).select(F.when(F.col("id") > 20, F.lit(7)).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("text number "), "id").alias("text"))
    files = tf.write_token_files(docs, PATH, 1)
    assert files.count() > 1
    got = tf.read_documents(files).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted([r.doc_id for r in docs.collect()])
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([r.n_tokens for r in got])])[:-1].tolist()
