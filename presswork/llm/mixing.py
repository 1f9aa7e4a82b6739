"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws an exponential key, divided by its quality weight. Within a source, documents
are taken in ascending key order until the source's token budget is met: the keys are range-sorted
over all tasks and summed with one offset per task, so a source with most of the rows is no
bottleneck. What a source takes is then told by a cut in (key, id), so texts never move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.llm.shared import BROADCAST_ROWS, names_of, whole_text
from presswork.plans.lookup import lookup_join
from presswork.plans.ordering import global_rank, running_sums
from presswork.plans.stage import staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = (3, 2)  # 150 % of all sizes, as a fraction
MOST_EPOCHS = 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """1 for plain prose, less the more runs of symbols there are: 100 / (100 + runs)."""
    return 100.0 / (100 + F.coalesce(F.regexp_count(text, F.lit(r"[#$%&*<>=|{}\[\]\\^~_]+")), F.lit(0)))


def uniform(key: Column) -> Column:
    """A number in (0, 1) that depends on the key alone."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def measured(key: str, text: str, source: str, quality) -> list[Column]:
    """id, _src (source as a sortable text, null last), _size and _key of a row."""
    src = F.when(F.col(source).isNull(), F.lit("t")).otherwise(F.concat(F.lit("s"), F.col(source).cast("string")))
    drawn = -F.ln(uniform(F.col(key))) / quality(whole_text(text))
    return [F.col(key).alias("id"), src.alias("_src"), word_count(F.col(text)).alias("_size"), drawn.alias("_key")]


def allot(sources: DataFrame, weights=WEIGHTS, share=SHARE, most: int = MOST_EPOCHS) -> DataFrame:
    """Targets of sources (_src, source_size): a share of all sizes by weight, never above ``most`` sizes.

    Sources in ascending order of _src weigh ``weights``, repeating. The excess of capped sources
    goes to the others by weight: with all filled to the same level per weight, those whose cap
    lies below the level are capped. Sorting by cap per weight and two running sums find the level.
    """
    ranked = global_rank(sources, ["_src"], "rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = ranked.withColumn("weight", weight.cast("long"))
    common = 1
    for w in set(weights):
        common *= w
    filled = running_sums(
        weighed, [F.col("source_size") * (F.lit(common) / F.col("weight")).cast("long"), "_src"], {"sizes": "source_size", "weights": "weight"}
    )
    total = filled.agg(F.sum("source_size").alias("all_size"), F.sum("weight").alias("all_weight"))
    over, under = share
    # level at this source's own cap: most * sizes + (most * source_size / weight) * (weights above) <= share * all
    capped = (
        under * most * (F.col("weight") * F.col("sizes") + F.col("source_size") * (F.col("all_weight") - F.col("weights")))
        <= over * F.col("weight") * F.col("all_size")
    )
    marked = filled.join(F.broadcast(total), how="cross").withColumn("capped", capped)
    taken = marked.agg(
        F.coalesce(F.sum(F.when(F.col("capped"), F.col("source_size"))), F.lit(0)).alias("capped_size"),
        F.coalesce(F.sum(F.when(F.col("capped"), F.col("weight"))), F.lit(0)).alias("capped_weight"),
    )
    level = (F.col("all_size") * over / under - most * F.col("capped_size")) / F.nullif(F.col("all_weight") - F.col("capped_weight"), F.lit(0))
    target = F.when(F.col("capped"), (most * F.col("source_size")).cast("double")).otherwise(level * F.col("weight"))
    return marked.join(F.broadcast(taken), how="cross").select("_src", "source_size", target.alias("target"))


def cuts(rows: DataFrame) -> DataFrame:
    """For each _src: source_size, target, whole epochs and the last (key, id) of the epoch begun.

    ``rows`` has id, _src, _size and _key. A document belongs to the begun epoch if the middle of
    its words lies within what is left of the target, so a source misses it by half a document.
    """
    sources = staged(rows.groupBy("_src").agg(F.sum("_size").alias("source_size")), "sources")
    targets = staged(allot(sources), "targets")
    whole = F.when(F.col("source_size") == 0, 0).otherwise(F.floor(F.col("target") / F.col("source_size"))).cast("long")
    targets = targets.withColumn("epochs", whole)
    summed = running_sums(rows, ["_key", "id"], {"_until": "_size"}, by="_src")
    counted = rows.groupBy("_src").agg(F.count(F.lit(1)).alias("n")).join(targets, "_src")
    counted = staged(counted, "counted")
    placed = lookup_join(summed, counted, "_src", weight="n", broadcast_rows=BROADCAST_ROWS)
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    inside = placed.where(F.col("_until") - F.col("_size") / 2 <= rest)
    last = inside.groupBy("_src").agg(F.max(F.struct("_key", "id")).alias("last"))
    return staged(counted.join(last, "_src", "left"), "cuts")


def with_copies(rows: DataFrame, cut: DataFrame) -> DataFrame:
    """``rows`` with _copies, how often the mix takes each, beside the columns of its cut."""
    placed = lookup_join(rows, cut, "_src", weight="n", broadcast_rows=BROADCAST_ROWS)
    begun = F.coalesce(F.struct("_key", "id") <= F.col("last"), F.lit(False))
    return placed.withColumn("_copies", F.when(F.col("_size") == 0, 0).otherwise(F.col("epochs") + begun.cast("long")))


def mixture(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", quality=quality_weight
) -> DataFrame:
    """One row per document: key, size, source_size, target (its source's), taken (words the mix takes).

    A null text or one without words has size 0 and is never taken; a null source is a source of
    its own, the last. Rows that share key and source share the decision where their weights agree.
    The draw depends on the key alone, so reruns agree. An empty table gives no rows.
    """
    names_of(docs, [key, text, source])
    rows = staged(docs.select(*measured(key, text, source, quality)), "sizes")
    mixed = with_copies(rows, cuts(rows))
    return mixed.select(
        F.col("id").alias(key),
        F.col("_size").alias("size"),
        "source_size",
        F.round("target", 6).alias("target"),
        (F.col("_size") * F.col("_copies")).alias("taken"),
    )


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", quality=quality_weight) -> DataFrame:
    """The mixed documents themselves: each row as often as the mix takes it, columns as given.

    Rows that the mix does not take, those without a word among them, are left out; the rest is as
    in ``mixture``. Other columns are carried whole, whatever their names.
    """
    names_of(docs, [key, text, source])
    columns = measured(key, text, source, quality)
    narrow = staged(docs.select(*columns), "sizes")
    mixed = with_copies(docs.select(F.struct("*").alias("_row"), *columns), cuts(narrow)).where("_copies > 0")
    return mixed.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select("_row.*")
