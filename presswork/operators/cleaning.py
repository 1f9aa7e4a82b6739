"""Corpus cleaning: markup, dates, news sources, stop words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.functions import text as tx
from presswork.sources.tables import number_sources

# sources one replacement step may hold; longer lists run as several steps in order
SOURCES_PER_STEP = 5_000


def extract_sources(df: DataFrame, column: str = "content_cleaned") -> DataFrame:
    """Distinct news sources that open a text.

    Taken as a list of zero or one match, so that the pattern runs once per
    row: a filter on the extracted text would be evaluated again in the scan.
    """
    start = F.substring(F.col(column), 1, tx.DATELINE_CHARS)
    found = F.regexp_extract_all(start, F.lit(tx.DATELINE), F.lit(0))
    return df.select(F.explode(found).alias("source")).distinct()


def merge_sources(first: DataFrame, second: DataFrame) -> DataFrame:
    """Distinct union of two source lists."""
    return first.union(second).distinct()


def review_sources(candidates: DataFrame, rejected: DataFrame) -> DataFrame:
    """Drop the candidates a reviewer rejected."""
    return candidates.join(rejected, "source", "left_anti")


def remove_sources(
    df: DataFrame,
    sources: DataFrame,
    column: str = "content_cleaned",
    out: str = "content_nosources",
    per_step: int = SOURCES_PER_STEP,
) -> DataFrame:
    """Replace every listed source by one space, in list order.

    ``sources`` is (seq, source). Each step carries at most ``per_step`` of them
    as one array value; since the replacements happen in sequence anyway,
    splitting a long list into steps gives the same text.
    """
    total = sources.agg(F.max("seq")).first()[0] or 0
    text: Column = F.coalesce(F.col(column), F.lit(""))
    df = df.withColumn(out, text)
    for start in range(0, total, per_step):
        step = sources.where(F.col("seq").between(start + 1, start + per_step))
        pairs = F.array_sort(F.collect_list(F.struct("seq", "source")))
        listed = step.agg(F.transform(pairs, lambda p: p["source"]).alias("list")).scalar()
        replaced = F.aggregate("_listed", F.col(out), lambda text, source: F.replace(text, source, F.lit(" ")))
        df = df.withColumn("_listed", listed).withColumn(out, replaced).drop("_listed")
    return df


def clean_corpus(docs: DataFrame, rejected: DataFrame | None = None, font: bool = False) -> DataFrame:
    """Headline and content cleaned; content loses dates and news sources first.

    One distinct over the found sources is the only shuffle; all else is a
    projection over the scan.
    """
    dated = docs.withColumn("content_cleaned", tx.strip_dates(F.coalesce(F.col("content"), F.lit(""))))
    sources = extract_sources(dated)
    if rejected is not None:
        sources = review_sources(sources, rejected)
    bare = remove_sources(dated, number_sources(sources))
    return bare.withColumn("headline_cleaned", tx.clean_text(F.col("headline"), font=font)).withColumn(
        "content_cleaned", tx.clean_text(F.col("content_nosources"), font=font)
    )


def reclean(docs: DataFrame) -> DataFrame:
    """Second cleaning pass from ``content_nosources``, now also without FONT parts."""
    return docs.withColumn("content_cleaned", tx.clean_text(F.col("content_nosources"), font=True))
