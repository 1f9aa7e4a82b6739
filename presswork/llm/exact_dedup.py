"""Exact dedup: one narrow row per document, grouped by a 128-bit hash of its text.

The texts themselves move only where a hash repeats. There the smallest and the largest text of
a group are compared (their partial results have one row per task and group, so a group of any
size stays spread out); where they differ, the hash collided and SHA-256 joins it in the grouping key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.llm.shared import BROADCAST_ROWS, kept_rows, names_of, whole_text
from presswork.plans.lookup import lookup_join
from presswork.plans.stage import staged


def text_hash(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", hashed=text_hash) -> DataFrame:
    """Group rows whose texts are equal byte for byte.

    Returns one row per input row: ``key``, ``keep_id`` (largest key of the group), ``group_size``,
    ``kept``, ``text_sha256``. A null text counts as empty. Rows repeated in full, or that share a
    key, are counted one by one and exactly one of them is kept. A null key is smaller than any
    other. Other columns of ``docs`` are ignored; an empty table gives no rows.
    ``hashed`` is the hash that groups; any function of the text gives the same result.
    """
    names_of(docs, [key, text])
    rows = docs.select(F.col(key).alias("key"), whole_text(text).alias("whole")).select(
        "key", "whole", hashed(F.col("whole")).alias("print")
    )
    prints = staged(
        rows.select(
            "key",
            "print",
            F.sha2(F.col("whole").cast("binary"), 256).alias("sha"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "prints",
    )
    size, keep = F.count(F.lit(1)).alias("size"), F.max(F.struct("key", "row")).alias("keep")
    groups = staged(prints.groupBy("print").agg(size, keep).where("size > 1"), "groups")

    # bytes of the groups: equal if the smallest text is the largest
    repeated = groups.select("print")
    if groups.count() <= BROADCAST_ROWS:
        repeated = F.broadcast(repeated)
    inside = rows.join(repeated, "print", "left_semi")
    compared = inside.groupBy("print").agg((F.min("whole") == F.max("whole")).alias("same"))
    collided = staged(compared.where(~F.col("same")).select("print"), "collided")
    by = ["print"]
    if not collided.isEmpty():
        prints = prints.join(collided.withColumn("split", F.lit(True)), "print", "left").withColumn(
            "print", F.when(F.col("split"), F.concat("print", F.unhex("sha"))).otherwise(F.col("print"))
        )
        prints = staged(prints.drop("split"), "prints")
        groups = staged(prints.groupBy("print").agg(size, keep).where("size > 1"), "groups")

    placed = lookup_join(prints, groups, by[0], "left", weight="size", broadcast_rows=BROADCAST_ROWS)
    alone = F.col("size").isNull()
    return placed.select(
        F.col("key").alias(key),
        F.when(alone, F.col("key")).otherwise(F.col("keep.key")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("keep.row") == F.col("row"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, that with the largest key; columns as given.

    Keys may repeat or be null: a null key is smaller than any other, and of rows with the same key
    and text one stays.
    """
    groups = exact_groups(docs, key, text).where("group_size > 1")
    decided = groups.select(F.col(key).alias("key"), F.col("text_sha256").alias("print"), "kept")
    return kept_rows(docs, decided, key, F.sha2(whole_text(text).cast("binary"), 256))
