"""Projection, joins, grouping and set operators on the corpus tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.toDF(*names)


def preview(df: DataFrame, n: int, key: str = "doc_id") -> DataFrame:
    """First ``n`` rows by key (top-n per partition, no full sort)."""
    return df.orderBy(key).limit(n)


def shape(terms: DataFrame) -> DataFrame:
    """Observations and features of a long term table, plus its filled cells.

    Terms and documents are reduced to distinct keys in two small steps.
    """
    docs = terms.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    sizes = docs.agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n_cells"))
    vocabulary = terms.select("term").distinct().agg(F.count(F.lit(1)).alias("n_terms"))
    return sizes.select("n_docs", vocabulary.scalar().alias("n_terms"), "n_cells")


def at_key(df: DataFrame, value: int, key: str = "doc_id") -> DataFrame:
    """One document, by key (the filter is pushed into the scan)."""
    return df.where(F.col(key) == value)


def category_counts(df: DataFrame, column: str = "headline") -> DataFrame:
    return df.groupBy("category").agg(F.count(column).alias("n"))


def filled_counts(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Non-null values of every column per key."""
    return df.groupBy(key).agg(*[F.count(c).alias(f"n_{c}") for c in columns])


def describe_by(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Per key and text column: count, unique, most frequent value and its count.

    Equal values are counted first, so a hot key is spread over its values; the
    second step then only merges one partial result per task and key. The
    smallest value wins a tie.
    """

    def one(column: str) -> DataFrame:
        values = df.where(F.col(column).isNotNull()).groupBy(key, F.col(column).alias("value"))
        counted = values.agg(F.count(F.lit(1)).alias("n"))
        best = F.min(F.struct((-F.col("n")).alias("m"), F.col("value")))
        return counted.groupBy(key).agg(
            F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_unique"), best.alias("best")
        ).select(
            key,
            F.lit(column).alias("field"),
            "n",
            "n_unique",
            F.col("best.value").alias("top"),
            (-F.col("best.m")).alias("freq"),
        )

    return reduce(DataFrame.unionByName, [one(c) for c in columns])


def attach_predictions(docs: DataFrame, predictions: DataFrame) -> DataFrame:
    """Left join by key: rows without a prediction stay."""
    return docs.join(predictions, "doc_id", "left")


def attach_clusters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents with their cluster label, matched by key."""
    return docs.join(labels, "doc_id")


def class_names(df: DataFrame, classes: DataFrame, category: str = "category") -> DataFrame:
    """Add ``class_name``; a class list is a handful of rows."""
    named = classes.withColumnRenamed("category", category)
    return df.join(F.broadcast(named), category, "left")


def append_results(*tables: DataFrame) -> DataFrame:
    """Stack result tables by column name."""
    return reduce(DataFrame.unionByName, tables)


def metric_rows(results: DataFrame, metric: str, fold: int | None = None) -> DataFrame:
    rows = results.where(F.col("metric") == metric)
    return rows if fold is None else rows.where(F.col("cv_fold") == fold)


def metric_names(results: DataFrame) -> DataFrame:
    return results.select("metric").distinct().orderBy("metric")


def cv_box_stats(results: DataFrame) -> DataFrame:
    """Five-number summary of every metric per algorithm."""
    quarters = [F.percentile("value", F.lit(q)).alias(name) for q, name in [(0.25, "q1"), (0.5, "median"), (0.75, "q3")]]
    return results.groupBy("algo", "metric").agg(
        F.min("value").alias("low"), *quarters, F.max("value").alias("high")
    )


def binarize_labels(df: DataFrame, classes: Sequence[int], category: str = "category") -> DataFrame:
    """Long 0/1 label table (key columns, class_id 0.., y): one row per class."""
    values = F.array(*[F.lit(c) for c in classes])
    exploded = df.select("*", F.posexplode(values).alias("class_id", "_value"))
    return exploded.withColumn("y", (F.col(category) == F.col("_value")).cast("int")).drop("_value")


def label_array(category, classes: Sequence[int]):
    """The same labels as one array column."""
    return F.array(*[(category == F.lit(c)).cast("int") for c in classes])
