"""Runs of characters or words, counted inside each row by tasks.

A column of all runs of a text holds twice as many strings as the text has characters or words, and
counting them by document and term hashes and spills every one. Here a task numbers the symbols
(characters or words) of a slice of rows, sorts whole numbers, and spells each distinct run once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.functions import text as tx

# symbols of the rows a task counts at once, but for longer rows, and rows of a batch it returns
AT_ONCE = 1 << 18
ROWS_OUT = 1 << 18


@dataclass(frozen=True)
class CharGrams:
    """All runs of ``low`` to ``high`` characters of the lower-case text."""

    text: Column
    low: int = 2
    high: int = 3
    between = ""

    @property
    def column(self) -> Column:
        return tx.char_ngrams(self.text, self.low, self.high)

    @property
    def symbols(self) -> Column:
        return tx.squeezed(self.text)

    def numbered(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """(symbols' numbers, lengths of rows, alphabet)"""
        texts = pc.fill_null(texts, "")
        points = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), np.uint32)
        used = np.zeros(int(points.max(initial=0)) + 1, bool)
        used[points] = True
        codes = (np.cumsum(used, dtype=np.int32) - 1)[points].astype(np.int64)
        return codes, self.lengths(texts), pa.array([chr(c) for c in np.flatnonzero(used).tolist()], pa.string())

    def lengths(self, texts: pa.Array) -> np.ndarray:
        return pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


@dataclass(frozen=True)
class WordGrams:
    """All runs of ``low`` to ``high`` tokens joined by a space; tokens hold no spaces."""

    words: Column
    low: int = 2
    high: int = 3
    between = " "

    @property
    def column(self) -> Column:
        return tx.word_ngrams(self.words, self.low, self.high)

    @property
    def symbols(self) -> Column:
        return self.words

    def numbered(self, lists: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """(symbols' numbers, lengths of rows, alphabet)"""
        coded = lists.flatten().dictionary_encode()
        return coded.indices.to_numpy().astype(np.int64), self.lengths(lists), coded.dictionary

    def lengths(self, lists: pa.Array) -> np.ndarray:
        return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


Grams = CharGrams | WordGrams


def _runs(codes: np.ndarray, lengths: np.ndarray, size: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, run, n): every row's distinct runs as rows of ``high`` symbols; ``size`` stands for none."""
    rows, base = len(lengths), size + 1
    if rows > 1 and rows * base**high >= 1 << 63:
        half = rows // 2
        cut = int(lengths[:half].sum())
        one, two = _runs(codes[:cut], lengths[:half], size, low, high), _runs(codes[cut:], lengths[half:], size, low, high)
        return np.concatenate([one[0], two[0] + half]), np.concatenate([one[1], two[1]]), np.concatenate([one[2], two[2]])
    row, left = np.repeat(np.arange(rows), lengths), np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))
    if rows * base**high >= 1 << 63:  # one row of very many symbols
        starts = [(n, np.flatnonzero(left >= n)) for n in range(low, high + 1)]
        parts = [np.stack([codes[s + j] if j < n else np.full(len(s), size) for j in range(high)], 1) for n, s in starts]
        run, n = np.unique(np.concatenate(parts), axis=0, return_counts=True)
        return np.zeros(len(n), np.int64), run, n
    keys, key = [], row
    for n in range(1, high + 1):
        key = key[: len(codes) - n + 1] * base + codes[n - 1 :]  # of the n symbols from each place on
        if n >= low:
            keys.append(key[left[: len(key)] >= n] * base ** (high - n) + (base ** (high - n) - 1) // (base - 1) * size)
    keys, n = np.unique(np.concatenate(keys), return_counts=True)
    row, keys = np.divmod(keys, base**high)
    run = np.empty((len(keys), high), np.int64)
    for j in reversed(range(high)):
        keys, run[:, j] = np.divmod(keys, base)
    return row, run, n


def _spelled(run: np.ndarray, alphabet: pa.Array, low: int, between: str) -> tuple[pa.Array, np.ndarray]:
    """The distinct runs as strings, and the place of each run among them."""
    size, high = len(alphabet), run.shape[1]
    if (size + 1) ** high < 1 << 63:
        keys = run[:, 0]
        for j in range(1, high):
            keys = keys * (size + 1) + run[:, j]
        _, first, place = np.unique(keys, return_index=True, return_inverse=True)
    else:
        first = place = np.arange(len(run))
    distinct, texts, order = run[first], [], []
    length = (distinct < size).sum(axis=1)
    for n in range(low, high + 1):
        some = np.flatnonzero(length == n)
        parts = [alphabet.take(pa.array(distinct[some, j])) for j in range(n)]
        texts.append(pc.binary_join_element_wise(*parts, between) if n > 1 else parts[0])
        order.append(some)
    back = np.empty(len(first), np.int64)
    back[np.concatenate(order)] = np.arange(len(first))
    return pa.concat_arrays(texts), back[place]


def _counted(batch: pa.RecordBatch, grams: Grams) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.Array, np.ndarray]]:
    """(first row, rows, their terms' places, terms, counts) of a batch, slice after slice of its rows."""
    column = batch.column("_symbols")
    lengths = grams.lengths(column)
    slices = (np.cumsum(lengths) - lengths) // AT_ONCE
    cuts = [0, *(np.flatnonzero(np.diff(slices)) + 1).tolist(), len(lengths)]
    for begin, end in zip(cuts, cuts[1:]):
        if lengths[begin:end].any():
            codes, sizes, alphabet = grams.numbered(column.slice(begin, end - begin))
            row, run, n = _runs(codes, sizes, len(alphabet), grams.low, grams.high)
            if len(n):
                terms, place = _spelled(run, alphabet, grams.low, grams.between)
                yield begin, row, place, terms, n


def gram_frequencies(docs: DataFrame, grams: Grams) -> DataFrame:
    """(term, df): rows that hold a run, already added up for each slice of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, place, terms, _ in _counted(batch, grams_only):
                yield from _cut({"term": terms, "df": pa.array(np.bincount(place, minlength=len(terms)))})

    grams_only = _bare(grams)
    parts = docs.select(grams.symbols.alias("_symbols")).mapInArrow(run, "term string, df bigint")
    return parts.groupBy("term").agg(F.sum("df").alias("df"))


def gram_totals(docs: DataFrame, grams: Grams) -> DataFrame:
    """(term, n): occurrences of a run, already added up for each slice of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, place, terms, n in _counted(batch, grams_only):
                yield from _cut({"term": terms, "n": pa.array(np.bincount(place, n, len(terms)).astype(np.int64))})

    grams_only = _bare(grams)
    parts = docs.select(grams.symbols.alias("_symbols")).mapInArrow(run, "term string, n bigint")
    return parts.groupBy("term").agg(F.sum("n").alias("n"))


def gram_cells(docs: DataFrame, grams: Grams, keep: Sequence[str] = (), vocabulary: DataFrame | None = None, n_docs: int | None = None) -> DataFrame:
    """(doc_id, keep..., term, n), one row per row of ``docs`` and run.

    With a ``vocabulary`` (term, df) that fits a broadcast: its runs only, and their ``df``; with
    ``n_docs`` also their share ``unit`` of the row's TF-IDF vector.
    """
    sent = None
    if vocabulary is not None:
        table = vocabulary.select("term", "df").where("term IS NOT NULL").toArrow()
        sent = docs.sparkSession.sparkContext.broadcast((table.column("term").combine_chunks(), table.column("df").to_numpy()))
    grams_only, names = _bare(grams), ["doc_id", *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf = None
        if sent is not None:
            known, df = sent.value
            if n_docs is not None:
                values, place = np.unique(df, return_inverse=True)
                idf = np.array([math.log((1.0 + n_docs) / (v + 1.0)) + 1.0 for v in values.tolist()])[place]
        for batch in batches:
            for begin, row, place, terms, n in _counted(batch, grams_only):
                columns = {}
                if sent is not None:
                    found = pc.fill_null(pc.index_in(terms, value_set=known), -1).to_numpy(zero_copy_only=False)[place]
                    kept = found >= 0
                    row, place, n, found = row[kept], place[kept], n[kept], found[kept]
                    columns["df"] = pa.array(df[found])
                    if idf is not None:
                        times, which = np.unique(n, return_inverse=True)
                        weight = np.array([math.log(t) + 1.0 for t in times.tolist()])[which] * idf[found]
                        columns["unit"] = pa.array(weight / np.sqrt(np.bincount(row, weight * weight))[row])
                at = pa.array(row + begin)
                yield from _cut({c: batch.column(c).take(at) for c in names} | {"term": terms.take(pa.array(place)), "n": pa.array(n.astype(np.int64))} | columns)

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names) + ", term string, n bigint"
    schema += ", df bigint" if vocabulary is not None else ""
    schema += ", unit double" if vocabulary is not None and n_docs is not None else ""
    return docs.select(*names, grams.symbols.alias("_symbols")).mapInArrow(run, schema)


def _bare(grams: Grams) -> Grams:
    """Without its column, which stays with the driver."""
    return type(grams)(None, grams.low, grams.high)


def _cut(columns: dict[str, pa.Array]) -> Iterator[pa.RecordBatch]:
    made = pa.RecordBatch.from_pydict(columns)
    for begin in range(0, made.num_rows, ROWS_OUT):
        yield made.slice(begin, ROWS_OUT)
