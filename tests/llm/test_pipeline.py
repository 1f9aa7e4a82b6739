"""Every stage of the pipeline against plain Python on what the stage before it kept."""

import collections
import zlib

import public_tokenizers

import corpus_pipeline
from presswork.llm import mixing
from tests.llm.test_minhash import brute_classes

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame(
        [(9001, None, "en", "src0", 0), (9002, " 12 %%", None, None, 6), (9003, "only a few words", None, None, 16), (9004, "only a few words", "en", "z", 16)],
        docs.schema,
    )
    docs = docs.unionByName(odd)
    kept = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, kept[-1], FOLDER).write.parquet(f"{tmp_path}/{i}")
        kept.append(spark.read.parquet(f"{tmp_path}/{i}"))
    assert all(k.columns == docs.columns for k in kept[:-1])
    rows = [[r.asDict() for r in k.collect()] for k in kept]
    ids = [[r["doc_id"] for r in one] for one in rows]

    assert sorted(ids[1]) == sorted(set(ids[0]) - {9001, 9002})
    last = {}
    for r in rows[1]:
        last[r["text"]] = max(last.get(r["text"], -1), r["doc_id"])
    assert sorted(ids[2]) == sorted(last.values())
    classes = brute_classes([(r["doc_id"], r["text"]) for r in rows[2]])
    assert sorted(ids[3]) == sorted(set(classes.values()))
    taken = {r.doc_id: r.taken // r.size if r.size else 0 for r in mixing.mixture(kept[3]).collect()}
    assert collections.Counter(ids[4]) == collections.Counter({i: n for i, n in taken.items() if n})
    texts = {r["doc_id"]: r["text"] for r in rows[0]}
    assert all(r["text"] == texts[r["doc_id"]] for one in rows[1:5] for r in one)
    assert sorted(ids[5]) == sorted(ids[4]) and all(r["lossless"] for r in rows[5])
    assert {r["n_pieces"] > 0 for r in rows[5]} == {True}
    assert zlib.crc32(b"") not in {r["pieces_crc32"] for r in rows[5]} and public_tokenizers.path("piece_bpe_32k.model")


def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    assert {"doc_id", "n_pieces", "pieces_crc32", "lossless"} <= set(got.columns) and got.count() > 0
