"""The numbered operators as named queries over their whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm import exact_dedup, forced_bpe, hard_negatives, language_id, maxent_lm, minhash, mixing, neighbours, sentencepiece_codec, token_files, toxicity, warc, whitening
from presswork.llm.shared import remainder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(run):
        QUERIES[run.__name__] = run
        if sql:
            ORACLE_SQL[run.__name__] = sql
        return run

    return register


@query()
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document; learns where crc32(doc_id) mod 3 is not 1."""
    docs = table(spark, folder, "documents")
    model = toxicity.train(docs, table(spark, folder, "labels"), remainder("doc_id", 3) != 1)
    held_out = (remainder("doc_id", 3) == 1).alias("held_out")
    return toxicity.score(docs.select("doc_id", held_out, "text"), model).drop("text")


@query()
def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of every document; learns where crc32(doc_id) mod 3 is not 1."""
    docs = table(spark, folder, "documents")
    model = language_id.train(docs, remainder("doc_id", 3) != 1)
    held_out = (remainder("doc_id", 3) == 1).alias("held_out")
    return language_id.predict(docs.select("doc_id", held_out, "text"), model).drop("text")


@query(
    """SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
      doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""
)
def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of equal texts over all documents; the largest doc_id of each stays."""
    return exact_dedup.exact_groups(table(spark, folder, "documents"))


@query(
    """WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
    d AS (SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha256(body) AS payload_digest,
      min(page_id) OVER (PARTITION BY sha256(body)) AS head FROM p)
    SELECT page_id, payload_bytes, payload_digest,
      CASE WHEN payload_bytes >= 100 AND head <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN payload_bytes >= 100 AND head <> page_id THEN head END AS refers_to
    FROM d"""
)
def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages as WARC records, written and read back."""
    archives = warc.write_archives(table(spark, folder, "pages"))
    page, refers = F.col("page").cast("long").alias("page_id"), F.col("refers_to").cast("long").alias("refers_to")
    return warc.read_archives(archives, with_payload=False).select(page, "payload_bytes", "payload_digest", "record_type", refers)


WORDS = public_tokenizers.path("word_bpe_49k.json")
END = 1


@query()
def op7_token_output(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of all documents, written in ascending doc_id order and read back."""
    files = token_files.write_token_files(table(spark, folder, "documents"), WORDS, END)
    return token_files.read_documents(files)


@query()
def op8_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 nearest vectors found for every 100th vector."""
    return neighbours.search(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@query(
    r"""WITH sized AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
      -ln((CAST('0x' || md5(CAST(doc_id AS VARCHAR))[1:13] AS BIGINT) + 0.5) / 4503599627370496.0)
        / (100.0 / (100 + len(regexp_extract_all(coalesce(text, ''), '[#$%&*<>=|{}\[\]\\^~_]+')))) AS k
      FROM documents),
    sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS s FROM sized GROUP BY source),
    weighed AS (SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM sums),
    filled AS (SELECT *, sum(s) OVER up AS below, sum(w) OVER up AS lighter, sum(s) OVER () AS total, sum(w) OVER () AS weight
      FROM weighed WINDOW up AS (ORDER BY s * (6 // w), source NULLS LAST)),
    marked AS (SELECT *, 4 * (w * below + s * (weight - lighter)) <= 3 * w * total AS capped FROM filled),
    level AS (SELECT (max(total) * 3 / 2.0 - 2 * coalesce(sum(s) FILTER (capped), 0))::DOUBLE
      / (max(weight) - coalesce(sum(w) FILTER (capped), 0))::DOUBLE AS l FROM marked),
    targets AS (SELECT source, s, CASE WHEN capped THEN (2 * s)::DOUBLE ELSE l * w END AS target FROM marked, level),
    placed AS (SELECT d.*, s, target, CASE WHEN s = 0 THEN 0 ELSE CAST(floor(target / s) AS BIGINT) END AS epochs,
      sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id ROWS UNBOUNDED PRECEDING) AS until
      FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, s AS source_size, round(target, 6) AS target,
      CAST(size * (epochs + CASE WHEN until - size / 2.0 <= target - epochs * s THEN 1 ELSE 0 END) AS BIGINT) AS taken
    FROM placed"""
)
def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of each document a mix of all sources takes."""
    return mixing.mixture(table(spark, folder, "documents"))


@query()
def op4_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Model and base log10 probability of every document; learns where crc32(doc_id) mod 7 is not 2."""
    docs = table(spark, folder, "documents")
    model, counts = maxent_lm.train(docs, remainder("doc_id", 7) != 2)
    held_out = (remainder("doc_id", 7) == 2).alias("held_out")
    return maxent_lm.score(docs.select("doc_id", held_out, "text"), model, counts)


PIECES = public_tokenizers.path("piece_bpe_32k.model")


@query()
def op5_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Sampled pieces of every document, told by their number and checksum, and decoded again."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return sentencepiece_codec.round_trip(docs, PIECES).drop("text")


@query()
def op10_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Class of near-duplicates of every document; the smallest doc_id of each stays."""
    return minhash.near_duplicates(table(spark, folder, "documents"))


@query()
def op11_forced_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document by forced-boundary byte-pair encoding, and their decoding, as digests."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return forced_bpe.digests(forced_bpe.round_trip(docs, WORDS))


@query()
def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Whitened components of every usable vector."""
    vectors = table(spark, folder, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))


@query(
    """WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
      [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    met AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
      FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
    positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM met WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score, CAST(row_number() OVER
      (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM positives p JOIN met m ON p.anchor_id = m.anchor_id AND NOT same AND 30 * positive_score <= 100 * score
      AND 100 * score <= 90 * positive_score QUALIFY rank <= 10"""
)
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every 100th vector and its five positives."""
    vectors = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", label), F.col("id") % 100 == 0)
