"""The registered queries: keys, columns, types and held-out flags over the whole smallest tables."""

import zlib

import pytest

from presswork.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
HELD = {"op1_toxicity": (3, 1), "op2_language_id": (3, 1), "op4_lm_scoring": (7, 2)}
COLUMNS = {
    "op1_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op2_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op3_exact_dedup": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
    "op4_lm_scoring": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"},
    "op5_sentencepiece": {"doc_id": "bigint"},
    "op7_token_output": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op9_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op10_minhash": {"doc_id": "bigint", "class_id": "bigint"},
    "op11_forced_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
}


@pytest.mark.parametrize("name", COLUMNS)
def test_every_document_with_the_columns_of_its_contract(spark, name):
    found = QUERIES[name](spark, FOLDER)
    kinds = dict(found.dtypes)
    assert {c: kinds.get(c) for c in COLUMNS[name]} == COLUMNS[name]
    rows = found.collect()
    keys = [r.doc_id for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert sorted(r.doc_id for r in rows) == sorted(keys)
    if name in HELD:
        by, rest = HELD[name]
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % by == rest) for r in rows)
    if name == "op1_toxicity":
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_vectors_and_pages(spark):
    pages = {r.page_id for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    assert sorted(r.page_id for r in QUERIES["op6_warc"](spark, FOLDER).collect()) == sorted(pages)
    ids = [r.vec_id for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    found = QUERIES["op8_nearest_neighbours"](spark, FOLDER)
    assert dict(found.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}
    per = found.groupBy("query_id").count().collect()
    assert sorted(r.query_id for r in per) == sorted(i for i in ids if i % 100 == 0) and {r["count"] for r in per} == {10}
    assert dict(QUERIES["op12_whitening"](spark, FOLDER).dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"
    }
    assert dict(QUERIES["op13_hard_negatives"](spark, FOLDER).dtypes) == {
        "anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"
    }
