"""Near-duplicate detection: BagMinHash signatures of word shingles, banding, exact verification.

A document is the multiset of its shingles of five words (a shorter one is a single shingle).
Weights are discretised to whole occurrences. Occurrence 0, occurrence 1, occurrences 2-3, 4-7, ...
of a shingle are intervals with a Poisson process each, at a rate in proportion to the interval's
length; a point of an interval that the weight covers only in part carries a level, and counts if
the weight reaches it. A point's time, register and level depend on shingle, interval and number
alone. A register keeps its earliest point, so two documents agree in a register with a
probability of exactly their weighted Jaccard similarity. Points are drawn in order of time, and
only up to the time by which all registers are full, so the work is linear in the shingles plus
about m ln m.

Candidates share all registers of a band. Copies are one node. A bucket of candidates compares all
members with a single pivot first; then only those outside its largest component so far with the
others, block by block. So no pair of a bucket whose link could matter is left out, and no group
is expanded into all its pairs. Each comparison counts the overlap of the multisets exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.llm.components import components
from presswork.llm.shared import BROADCAST_ROWS, add_columns, kept_rows, mix64, names_of, pieces, whole_text
from presswork.llm.words import Sums, Words
from presswork.plans.lookup import lookup_join
from presswork.plans.stage import staged

SHINGLE = 5
SIMILARITY = 0.8
# 26 bands of 5 registers: a pair at 0.8 shares a band with a probability of 0.99997
BANDS, ROWS = 26, 5
# rows of a block of comparisons, on either side
BLOCK = 256
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1B54A32D192ED03)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingles(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the shingles of lower-cased words, repeats included, and each text's bounds in them."""
    words = Words(column)
    count = np.diff(words.rows)
    per_text = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    bounds = np.concatenate([[0], np.cumsum(per_text)])
    start = np.arange(bounds[-1]) - np.repeat(bounds[:-1] - words.rows[:-1], per_text)
    end = start + np.repeat(np.minimum(count, size), per_text)
    return Sums(words.keys()).keys(start, end), bounds


def counted(keys: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys of each text with their number, in no order: text, key, number."""
    of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    if not len(keys):
        return of, keys, np.empty(0, np.int64)
    order = np.argsort(mix64(keys + of.astype(np.uint64) * _GOLD))
    keys, of = keys[order], of[order]
    first = np.ones(len(keys), dtype=bool)
    first[1:] = (keys[1:] != keys[:-1]) | (of[1:] != of[:-1])
    at = np.flatnonzero(first)
    return of[at], keys[at], np.diff(np.append(at, len(keys)))


def signatures(of: np.ndarray, keys: np.ndarray, number: np.ndarray, texts: int, registers: int) -> np.ndarray:
    """BagMinHash: for each text and register the earliest point, as (time bits << 32 | identity).

    Texts without shingles keep empty registers.
    """
    total = np.bincount(of, weights=number, minlength=texts)
    kept = np.full(texts * registers, _EMPTY, dtype=np.uint64)
    limit = np.divide(np.log(registers) + 4.0, total, out=np.zeros(texts), where=total > 0)
    todo = np.ones(len(keys), dtype=bool)
    while True:
        _draw(kept, of[todo], keys[todo], number[todo], limit, registers)
        unfilled = ((kept.reshape(texts, registers) == _EMPTY).any(axis=1)) & (total > 0)
        if not unfilled.any():
            return kept.reshape(texts, registers)
        limit[unfilled] *= 2
        todo = unfilled[of]


def _draw(kept, of, keys, number, limit, registers):
    interval = 0
    while len(keys):
        # interval 0 is occurrence 0, interval i > 0 has the occurrences from 2^(i-1) to 2^i - 1
        low = 0 if interval == 0 else 1 << (interval - 1)
        length = max(1, low)
        reached = number > low
        of, keys, number = of[reached], keys[reached], number[reached]
        step = np.uint64((interval + 1) * int(_STEP) % (1 << 64))
        state, text, weight = mix64(keys + step), of, number
        time = np.zeros(len(state))
        rate = float(registers * length)
        while len(state):
            state = state + _GOLD
            drawn = mix64(state)
            time = time - np.log(((drawn >> np.uint64(24)).astype(np.float64) + 0.5) * 2.0**-40) / rate
            soon = time < limit[text]
            state, time, text, weight, drawn = state[soon], time[soon], text[soon], weight[soon], drawn[soon]
            register = (drawn & np.uint64(0xFFFFFF)).astype(np.int64) % registers
            identity = mix64(drawn ^ _STEP)
            point = (time.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)) | (identity >> np.uint64(32))
            place = text * registers + register
            if length > 1:
                level = low + (identity & np.uint64(0xFFFFFFFF)).astype(np.int64) % length
                inside = level < weight
                place, point = place[inside], point[inside]
            np.minimum.at(kept, place, point)
        interval += 1


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each text and band."""
    parts = (signature & np.uint64(0xFFFFFFFF)).reshape(len(signature), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _STEP, parts.shape[:2]).copy()
    for r in range(rows):
        key = mix64(key + parts[:, :, r] * _GOLD)
    return key.view(np.int64)


def with_bands(docs: DataFrame, text: str, size: int, bands: int, rows: int) -> DataFrame:
    """Adds n_shingles and the keys of the bands; no keys where a text has no word."""

    def run(batches):
        for batch in batches:
            numbers, keys = np.zeros(len(batch), np.int64), []
            for first, part in pieces(batch, text):
                found, bounds = shingles(part, size)
                numbers[first : first + len(part)] = np.diff(bounds)
                of, distinct, number = counted(found, bounds)
                keys.append(band_keys(signatures(of, distinct, number, len(part), bands * rows), bands, rows))
            kept = np.repeat(numbers > 0, bands)
            flat = pa.array(np.concatenate(keys).reshape(-1)[kept] if keys else np.empty(0, np.int64))
            ends = np.concatenate([[0], np.cumsum(np.where(numbers > 0, bands, 0))]).astype(np.int32)
            yield {"n_shingles": numbers, "bands": pa.ListArray.from_arrays(pa.array(ends), flat)}

    return add_columns(docs, run, "n_shingles long, bands array<long>")


def links(rows: DataFrame, group: list[str], similarity: float, size: int) -> DataFrame:
    """Similar pairs (a, b) between the asking and the asked rows of each group.

    ``rows`` has the ``group`` columns, print, text and asks (does it ask, or is it asked).
    A group is a block of bounded size. Overlaps come from an inverted index of the asked rows.
    """
    bound = Fraction(str(similarity))

    def compare(one: pa.Table) -> pa.Table:
        column = one.column("text").combine_chunks()
        column = column if isinstance(column, pa.Array) else column.chunk(0)
        prints, asks = one.column("print").to_pylist(), np.array(one.column("asks").to_pylist(), dtype=bool)
        of, keys, number = counted(*shingles(column, size))
        order = np.argsort(of, kind="stable")
        of, keys, number = of[order], keys[order], number[order]
        total = np.bincount(of, weights=number, minlength=len(prints)).astype(np.int64)
        mine = asks[of]
        order = np.argsort(keys[~mine], kind="stable")
        held, owner, many = keys[~mine][order], of[~mine][order], number[~mine][order]
        starts = np.searchsorted(of, np.arange(len(prints) + 1))
        a, b = [], []
        for row in np.flatnonzero(asks):
            span = slice(starts[row], starts[row + 1])
            low, high = np.searchsorted(held, keys[span], "left"), np.searchsorted(held, keys[span], "right")
            hits = high - low
            places = np.repeat(low - np.concatenate([[0], np.cumsum(hits)[:-1]]), hits) + np.arange(hits.sum())
            both = np.minimum(np.repeat(number[span], hits), many[places])
            shared = np.bincount(owner[places], weights=both, minlength=len(prints)).astype(np.int64)
            alike = shared * bound.denominator >= bound.numerator * (total[row] + total - shared)
            for other in np.flatnonzero(alike & (shared > 0) & ~asks):
                if prints[other] != prints[row]:
                    a.append(prints[row])
                    b.append(prints[other])
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return rows.groupBy(*group).applyInArrow(compare, "a binary, b binary")


def _blocks(rows: DataFrame, groups: DataFrame, key: str, block: int) -> DataFrame:
    """The comparisons of each group dealt into blocks (key, left, right) of about ``block`` rows a side.

    ``rows``: key, print, asks. Askers are dealt over the left sides and copied to all right sides;
    the asked the other way round. ``groups``: key, askers, asked (how many).
    """
    lefts, rights = (F.greatest(F.lit(1), F.ceil(F.col(c) / block)).cast("int") for c in ("askers", "asked"))
    sized = lookup_join(
        rows, groups.select(key, "asked", lefts.alias("lefts"), rights.alias("rights")), key, weight="asked", broadcast_rows=BROADCAST_ROWS
    )
    own = F.xxhash64("print")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    return sized.select(
        key,
        "print",
        "asks",
        F.when(F.col("asks"), F.array(F.pmod(own, F.col("lefts")).cast("int"))).otherwise(every("lefts")).alias("left"),
        F.when(F.col("asks"), every("rights")).otherwise(F.array(F.pmod(own, F.col("rights")).cast("int"))).alias("right"),
    ).withColumn("left", F.explode("left")).withColumn("right", F.explode("right"))


def _texts_of(rows: DataFrame, texts: DataFrame) -> DataFrame:
    often = rows.groupBy("print").agg(F.count(F.lit(1)).alias("often"))
    return lookup_join(rows, texts.join(often, "print"), "print", weight="often", broadcast_rows=0).drop("often")


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    size: int = SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per document: key, class_id, class_size, n_shingles, kept.

    Two documents are linked if the weighted Jaccard similarity of their shingles is at least
    ``similarity``; classes are the connected components, named by their smallest key, whose
    document is the one kept. Null texts and texts without a word are classes of their own.
    Rows with the same text are in the same class; of rows repeated in full one is kept.
    Null keys sort last. An empty table gives no rows; other columns are ignored.
    """
    named = _classes(docs, key, text, similarity, size, bands, rows)
    return named.select(F.col("id").alias(key), "class_id", "class_size", "n_shingles", "kept")


def _print(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _classes(docs: DataFrame, key: str, text: str, similarity: float, size: int, bands: int, rows: int) -> DataFrame:
    """id, print, class_id, class_size, n_shingles, kept."""
    names_of(docs, [key, text])
    source = docs.select(F.col(key).alias("id"), whole_text(text).alias("text"))
    printed = source.withColumn("print", _print(F.col("text")))
    prints = with_bands(printed, "text", size, bands, rows).drop("text")
    prints = staged(prints.withColumn("row", F.monotonically_increasing_id()), "prints")

    # copies are one node, whose first row stands for them
    order = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    nodes = staged(
        prints.where("n_shingles > 0").groupBy("print").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("copies")), "nodes"
    )
    several = staged(nodes.where("copies > 1"), "copies")
    told = lookup_join(prints.where("n_shingles > 0"), several, "print", "left", weight="copies", broadcast_rows=BROADCAST_ROWS)
    alone = told.where(F.col("first").isNull() | (F.col("first.row") == F.col("row")))

    # buckets of two nodes or more, each set of members once
    banded = staged(alone.select("print", "n_shingles", F.explode("bands").alias("bucket")), "banded")
    size_, sum_ = F.count(F.lit(1)).alias("size"), F.sum(F.xxhash64("print").cast("decimal(38,0)")).alias("set")
    buckets = banded.groupBy("bucket").agg(size_, sum_).where("size > 1")
    buckets = staged(buckets.groupBy("size", "set").agg(F.min("bucket").alias("bucket")).drop("set"), "buckets")
    members = staged(lookup_join(banded, buckets, "bucket", weight="size", broadcast_rows=BROADCAST_ROWS), "members")

    wanted = members.select("print").distinct().join(nodes, "print").select("print", F.col("first.id").alias("id"))
    texts = staged(
        printed.alias("d").join(wanted.alias("w"), (F.col("d.print") == F.col("w.print")) & F.col("d.id").eqNullSafe(F.col("w.id")))
        .select("d.print", "d.text").dropDuplicates(["print"]),
        "texts",
    )

    # every member with the pivot of its bucket: the node that meets most others
    met = members.groupBy("print").agg(F.sum("size").alias("met"))
    pivots = members.join(met, "print").groupBy("bucket").agg(
        F.max(F.struct("met", "print", "n_shingles")).alias("p"), F.count(F.lit(1)).alias("size")
    )
    pivots = staged(pivots.select("bucket", "size", F.col("p.print").alias("pivot"), F.col("p.n_shingles").alias("n")), "pivots")
    enough = F.least("n", "n_shingles") >= similarity * F.greatest("n", "n_shingles") - 1e-6
    pairs = lookup_join(members.drop("size"), pivots, "bucket", weight="size", broadcast_rows=BROADCAST_ROWS)
    pairs = staged(pairs.where(enough & (F.col("print") != F.col("pivot"))).select("pivot", "print").distinct(), "pairs")
    asked = pairs.groupBy("pivot").agg(F.lit(1).alias("askers"), F.count(F.lit(1)).alias("asked"))
    asking = asked.select("pivot", F.col("pivot").alias("print"), F.lit(True).alias("asks"))
    first = _blocks(pairs.withColumn("asks", F.lit(False)).unionByName(asking), staged(asked, "asked"), "pivot", BLOCK)
    found = staged(links(_texts_of(first, texts), ["pivot", "left", "right"], similarity, size), "links")

    # what lies outside the largest component of its bucket, with all others of the bucket
    label = F.coalesce("label", "print").alias("label")
    so_far = components(found).withColumnRenamed("node", "print")
    placed = staged(members.join(so_far, "print", "left").select("bucket", "print", label), "placed")
    parts = placed.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    apart = parts.groupBy("bucket").agg(
        F.sum("n").alias("asked"), F.max(F.struct("n", "label")).alias("largest"), F.count(F.lit(1)).alias("parts")
    ).where("parts > 1")
    apart = staged(
        apart.select("bucket", "asked", (F.col("asked") - F.col("largest.n")).alias("askers"), F.col("largest.label").alias("main")), "apart"
    )
    if not apart.isEmpty():
        left = lookup_join(placed, apart, "bucket", weight="asked", broadcast_rows=BROADCAST_ROWS)
        left = left.select(
            "bucket", "print", F.explode(F.when(F.col("label") == F.col("main"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))).alias("asks")
        )
        second = _blocks(left, apart, "bucket", BLOCK)
        more = links(_texts_of(second, texts), ["bucket", "left", "right"], similarity, size)
        found = staged(found.unionByName(more).distinct(), "links")

    linked = components(found).withColumnRenamed("node", "print")
    linked = staged(nodes.join(linked, "print", "left").select("print", "first", "copies", label), "linked")
    classes = linked.groupBy("label").agg(F.min("first").alias("head"), F.sum("copies").alias("class_size"))
    classes = staged(classes.where("class_size > 1"), "classes")
    grouped = lookup_join(linked, classes, "label", weight="class_size", broadcast_rows=BROADCAST_ROWS)
    grouped = staged(grouped.select("print", "copies", "head", "class_size"), "grouped")
    named = lookup_join(prints, grouped, "print", "left", weight="copies", broadcast_rows=BROADCAST_ROWS)
    single = F.col("class_size").isNull() | (F.col("n_shingles") == 0)
    return named.select(
        "id",
        "print",
        F.when(single, F.col("id")).otherwise(F.col("head.id")).alias("class_id"),
        F.when(single, 1).otherwise(F.col("class_size")).cast("long").alias("class_size"),
        "n_shingles",
        (single | (F.col("head.row") == F.col("row"))).alias("kept"),
    )


def drop_near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    size: int = SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """``docs`` with one document of each class, that with the smallest key; columns as given.

    Keys may repeat or be null: null keys sort last, and of rows with the same key and text one
    stays, except texts without a word, which all stay.
    """
    classes = _classes(docs, key, text, similarity, size, bands, rows).where("class_size > 1")
    decided = classes.select(F.col("id").alias("key"), "print", "kept")
    return kept_rows(docs, decided, key, _print(whole_text(text)))
