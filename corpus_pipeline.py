"""A corpus from raw documents to sampled token sequences, stage by stage.

Each stage reads what the one before it wrote, works on all of it, and hands on the columns of
documents; the last returns one row per mixed document with the digest of its pieces.

All stages read a null text as empty and carry columns of other names as they are; null keys and
sources are values like others, and an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm import exact_dedup, language_id, minhash, mixing, sentencepiece_codec
from presswork.llm.queries import PIECES
from presswork.llm.shared import remainder
from presswork.plans.stage import staged


def keep_known_languages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose language can be told go on; null texts and texts without a letter leave.

    Repeated rows are judged one by one and alike. A null lang teaches nothing. Columns named _lang
    or _sure raise ``ValueError``.
    """
    model = language_id.train(docs, remainder("doc_id", 3) != 1)
    told = language_id.predict(docs, model, names=("_lang", "_sure"))
    return told.where(F.col("_lang") != language_id.UNDETERMINED).drop("_lang", "_sure")


def drop_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of documents with the same text, the one with the largest doc_id goes on, null keys last.

    Of rows that share key and text one stays, the first by its columns as text; rows that share a
    key but no text are judged apart.
    """
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of near-duplicates (shingles of five words, similarity 0.8), the one with the smallest doc_id goes on.

    Texts of fewer than five words are alike only if they are equal in words. Rows that share key and
    text count as copies; of them one stays, the first by its columns as text.
    """
    return minhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as the mix takes them: its second epoch repeats rows.

    Texts without a word are never taken. The draw depends on the key, ties on the key's order, so
    rows that share key and source are taken alike.
    """
    return mixing.mix(docs)


def sample_pieces(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Number and checksum of each document's sampled pieces, and whether they decode to its text.

    The sample depends on key and text, so copies in the mix have the same pieces.
    """
    pieces = sentencepiece_codec.round_trip(docs.select("doc_id", "lang", "source", "text"), PIECES)
    return pieces.drop("text")


STAGES = [
    ("language ID", keep_known_languages),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("SentencePiece", sample_pieces),
]

ORACLE_SQL = None  # language ID, near-duplicates and sampled pieces have no SQL form


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, folder), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, folder)
