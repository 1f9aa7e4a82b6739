"""Registration of queries, and the input tables they share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    covers: tuple[str, ...]
    sql: str | None


CATALOG: dict[str, Query] = {}


def query(covers: str, sql: str | None = None):
    """Register a function under its own name; ``covers`` lists inventory ids."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        CATALOG[run.__name__] = Query(run.__name__, run, tuple(covers.split()), sql)
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for costly row work on a table that came in very few files.

    A table with enough splits is left alone, so on large inputs nothing moves.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents"))


LANGUAGES = {"en": 1, "fr": 2, "de": 3, "es": 4}
CLASSES = [1, 2, 3, 4]

# openings that give each document the parts the cleaning rules look for
OPENINGS = [
    "NEW YORK (Reuters) - ",
    "AP - ",
    "London, UK (AFP) -- ",
    "12 May 2004, ",
    "AP - 3 March ",
    "<FONT size=2>Update</FONT> ",
    "Q&amp;A (Web) ",
]


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    """documents as a news corpus: doc_id, category, headline, content, split."""
    opening = F.element_at(F.array(*[F.lit(o) for o in OPENINGS]), (F.col("doc_id") % len(OPENINGS) + 1).cast("int"))
    category = F.lit(None).cast("int")
    for lang, number in LANGUAGES.items():
        category = F.when(F.col("lang") == lang, number).otherwise(category)
    split = F.when(F.col("doc_id") % 5 == 0, "test").otherwise("train")
    return documents(spark, folder).select(
        "doc_id",
        category.cast("int").alias("category"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("headline"),
        F.concat(opening, F.col("text")).alias("content"),
        "text",
        split.alias("split"),
    )


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


CORPUS_SQL = f"""corpus AS (
  SELECT doc_id,
    CAST(CASE lang {" ".join(f"WHEN '{k}' THEN {v}" for k, v in LANGUAGES.items())} END AS INTEGER) AS category,
    split_part(text, chr(10), 1) AS headline,
    concat(([{", ".join(quoted(o) for o in OPENINGS)}])[doc_id % {len(OPENINGS)} + 1], text) AS content,
    text,
    CASE WHEN doc_id % 5 = 0 THEN 'test' ELSE 'train' END AS split
  FROM documents)"""
