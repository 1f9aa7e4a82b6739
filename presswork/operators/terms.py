"""Long, sparse term tables (doc_id, term, value): counts, vocabularies, TF-IDF, word ids.

Fitting touches only (term, count) pairs: distinct terms are taken inside each
row and pre-aggregated before the shuffle. Transforming moves each document
once, by ``doc_id``; counting, the vocabulary lookup and the vector norm all
reuse that partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presswork.functions.numbers import round_even
from presswork.functions.text import context_windows
from presswork.operators.grams import CharGrams, Grams, WordGrams, gram_cells, gram_frequencies, gram_totals
from presswork.plans import global_rank, lookup_join, staged
from presswork.plans.lookup import fits_broadcast

# words of the rows that ask for ids together, but for the last row
WORDS_AT_ONCE = 1 << 20

# a list of tokens, or runs of characters or words that tasks count from the row
Tokens = Column | Grams


def _shared_keys(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``docs`` whose doc_id no other row has, and the others, if there are any."""
    keys = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
    if keys.isEmpty():
        return docs, None
    keys = staged(keys.select("doc_id"), "shared-keys")
    same = docs["doc_id"].eqNullSafe(keys["doc_id"])
    return docs.join(keys, same, "left_anti"), docs.join(keys, same, "left_semi")


def term_counts(docs: DataFrame, tokens: Tokens, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, keep..., term, n) with one row per document and term."""
    if isinstance(tokens, CharGrams | WordGrams):
        single, shared = _shared_keys(docs)
        cells = gram_cells(single, tokens, keep)
        return cells if shared is None else cells.unionByName(term_counts(shared, tokens.column, keep))
    placed = docs.repartition("doc_id")
    exploded = placed.select("doc_id", *keep, F.explode(tokens).alias("term"))
    return exploded.groupBy("doc_id", *keep, "term").agg(F.count(F.lit(1)).alias("n"))


def document_frequencies(docs: DataFrame, tokens: Tokens, min_df: int = 1) -> DataFrame:
    """(term, df): in how many documents a term occurs, cut below ``min_df``."""
    if isinstance(tokens, CharGrams | WordGrams):
        return gram_frequencies(docs, tokens).where(F.col("df") >= min_df)
    exploded = docs.select(F.explode(F.array_distinct(tokens)).alias("term"))
    counted = exploded.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return counted.where(F.col("df") >= min_df)


def fit_vocabulary(docs: DataFrame, tokens: Tokens, min_df: int = 2) -> DataFrame:
    """Staged (term, df) of the terms found in at least ``min_df`` documents."""
    return staged(document_frequencies(docs, tokens, min_df), "vocabulary")


def number_vocabulary(vocabulary: DataFrame) -> DataFrame:
    """Add the 0-based position of each term in term order."""
    ranked = global_rank(vocabulary, ["term"], "position")
    return ranked.withColumn("position", F.col("position") - 1)


def known_terms(counts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Keep the terms of a fitted vocabulary; unknown ones vanish."""
    return lookup_join(counts, vocabulary, "term", weight="df")


def count_vectorize(
    docs: DataFrame,
    tokens: Tokens,
    vocabulary: DataFrame,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Bag of terms: (doc_id, keep..., term, n) over a fitted vocabulary."""
    if isinstance(tokens, CharGrams | WordGrams) and fits_broadcast(vocabulary):
        single, shared = _shared_keys(docs)
        cells = gram_cells(single, tokens, keep, vocabulary).drop("df")
        return cells if shared is None else cells.unionByName(count_vectorize(shared, tokens.column, vocabulary, keep))
    return known_terms(term_counts(docs, tokens, keep), vocabulary).select("doc_id", *keep, "term", "n")


def tfidf(
    docs: DataFrame,
    tokens: Tokens,
    vocabulary: DataFrame,
    n_docs: int,
    keep: Sequence[str] = (),
    digits: int | None = 2,
) -> DataFrame:
    """(doc_id, keep..., term, tfidf), unit length per document, then rounded.

    weight = (1 + ln n) * (ln((1 + n_docs) / (1 + df)) + 1) with ``n_docs`` and
    df from the fitting split. Weights rounded to 0 are dropped, like any other
    empty cell.
    """
    if isinstance(tokens, CharGrams | WordGrams) and fits_broadcast(vocabulary):
        single, shared = _shared_keys(docs)
        cells = gram_cells(single, tokens, keep, vocabulary, n_docs)
        value = F.col("unit") if digits is None else round_even(F.col("unit"), digits)
        rows = cells.select("doc_id", *keep, "term", value.alias("tfidf"))
        rows = rows if digits is None else rows.where(F.col("tfidf") > 0)
        return rows if shared is None else rows.unionByName(tfidf(shared, tokens.column, vocabulary, n_docs, keep, digits))
    found = known_terms(term_counts(docs, tokens, keep), vocabulary)
    idf = F.log(F.lit(1.0 + n_docs) / (F.col("df") + 1.0)) + 1.0
    weighted = found.withColumn("w", (F.log(F.col("n").cast("double")) + 1.0) * idf)
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc_id")))
    unit = F.col("w") / norm
    value = unit if digits is None else round_even(unit, digits)
    rows = weighted.select("doc_id", *keep, "term", value.alias("tfidf"))
    return rows if digits is None else rows.where(F.col("tfidf") > 0)


def term_totals(docs: DataFrame, tokens: Tokens, vocabulary: DataFrame | None = None) -> DataFrame:
    """(term, n) over the corpus, straight from the tokens: one shuffle of partial counts."""
    if isinstance(tokens, CharGrams | WordGrams):
        totals = gram_totals(docs, tokens)
    else:
        exploded = docs.select(F.explode(tokens).alias("term"))
        totals = exploded.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    if vocabulary is None:
        return totals
    return totals.join(vocabulary.select("term"), "term", "left_semi")  # one row per term on either side


def tfidf_totals(weights: DataFrame) -> DataFrame:
    """(term, n): whole part of the summed two-digit weights, summed as integers."""
    cents = F.sum(F.rint(F.col("tfidf") * 100).cast("bigint"))
    return weights.groupBy("term").agg(F.floor(cents / 100).alias("n"))


def top_terms(totals: DataFrame, k: int) -> DataFrame:
    """The k most frequent terms; ties in term order."""
    return totals.orderBy(F.desc("n"), "term").limit(k)


def build_word_ids(docs: DataFrame, tokens: Column) -> DataFrame:
    """(word, n, word_id): ids from 1 by descending count, first-seen order in a tie; 0 pads.

    Words are first counted inside each document, where the documents already
    lie; then only one row per task and word is shuffled. Both steps keep
    numbers in their buffers and stay hash aggregations.
    """
    seen = docs.repartition("doc_id").select("doc_id", F.posexplode(tokens).alias("pos", "word"))
    inside = seen.groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("pos"))
    counted = inside.groupBy("word").agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("doc_id"), F.min_by("pos", "doc_id").alias("pos")
    )
    ranked = global_rank(counted, [F.desc("n"), "doc_id", "pos"], "word_id")
    return ranked.select("word", "n", "word_id")


def encode_words(docs: DataFrame, tokens: Column, word_ids: DataFrame) -> DataFrame:
    """(doc_id, word_ids) with the ids in text order; words without an id are skipped.

    A document without a numbered word has an empty list. Texts stay in slices of some
    ``WORDS_AT_ONCE`` words: a slice asks once for each word it holds, and the answers come back
    to it. Rows that share a doc_id have one list of all their words, which is put together by a join.
    """
    single, shared = _shared_keys(docs)
    lists = _sliced_ids(single, tokens, word_ids)
    if shared is None:
        return lists
    words = shared.select("doc_id", F.posexplode(tokens).alias("pos", "word"))
    numbered = lookup_join(words, word_ids, "word", weight="n").select("doc_id", "pos", "word_id")
    placed = F.array_sort(F.collect_list(F.struct("pos", "word_id")))
    joined = numbered.groupBy("doc_id").agg(F.transform(placed, lambda p: p["word_id"]).alias("word_ids"))
    every = shared.select("doc_id").join(joined, "doc_id", "left")
    return lists.unionByName(every.select("doc_id", F.coalesce("word_ids", F.array().cast("array<bigint>")).alias("word_ids")))


def _sliced_ids(docs: DataFrame, tokens: Column, word_ids: DataFrame) -> DataFrame:
    """(doc_id, word_ids) of rows that share no doc_id; the list of a null key is empty."""
    key = docs.schema["doc_id"].dataType.simpleString()

    def sliced(batches: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches).combine_chunks()
        keys, lists = (table.column(c).combine_chunks() for c in ("doc_id", "tokens"))
        row, words = pc.list_parent_indices(lists), lists.flatten()
        kept = pc.and_(words.is_valid(), keys.is_valid().take(row))
        coded = words.filter(kept).dictionary_encode()
        ends = np.cumsum(np.bincount(row.filter(kept).to_numpy(), minlength=len(keys)))
        whole = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in (keys, coded.dictionary)]
        codes = coded.indices.to_numpy().astype(np.int32).tobytes()
        columns = {"slice": pa.array([number], pa.int64()), "keys": whole[0], "ends": pa.array([ends.tobytes()]), "codes": pa.array([codes]), "words": whole[1]}
        return pa.RecordBatch.from_pydict(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, words = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            lengths = pc.fill_null(pc.list_value_length(batch.column("tokens")), 0).to_numpy().astype(np.int64)
            cuts = [0, *(np.flatnonzero(np.diff((np.cumsum(lengths) - lengths) // WORDS_AT_ONCE)) + 1).tolist(), len(lengths)]
            for begin, end in zip(cuts, cuts[1:]):
                held.append(batch.slice(begin, end - begin))
                words += lengths[begin:end].sum()
                if words >= WORDS_AT_ONCE:
                    yield sliced(held, number)
                    number, held, words = number + 1, [], 0
        if held:
            yield sliced(held, number)

    def named(texts: pa.Table, answers: pa.Table) -> pa.Table:
        codes, ends = (np.frombuffer(texts.column(c)[0].as_buffer(), kind) for c, kind in (("codes", np.int32), ("ends", np.int64)))
        ids = np.full(codes.max(initial=-1) + 1, -1, np.int64)
        ids[answers.column("at").to_numpy()] = answers.column("word_id").to_numpy()
        found = ids[codes]
        before = np.concatenate([[0], np.cumsum(found >= 0)])
        lists = pa.ListArray.from_arrays(pa.array(before[np.concatenate([[0], ends])], pa.int32()), pa.array(found[found >= 0]))
        return pa.table({"doc_id": texts.column("keys").combine_chunks().flatten(), "word_ids": lists})

    schema = f"slice bigint, keys array<{key}>, ends binary, codes binary, words array<string>"
    slices = staged(docs.select("doc_id", tokens.alias("tokens")).mapInArrow(run, schema), "slices")
    asked = slices.select(F.col("slice").alias("of"), F.posexplode("words").alias("at", "word"))
    answers = lookup_join(asked, word_ids.select("word", "n", "word_id"), "word", weight="n").select("of", "at", F.col("word_id").cast("bigint").alias("word_id"))
    tasks = max(1, min(slices.count(), 10_000))
    texts = slices.select("slice", "keys", "ends", "codes").repartition(tasks, "slice").groupBy("slice")
    return texts.cogroup(answers.repartition(tasks, "of").groupBy("of")).applyInArrow(named, f"doc_id {key}, word_ids array<bigint>")


def context_pairs(encoded: DataFrame, window: int = 2) -> DataFrame:
    """(doc_id, pos, context, target): neighbours of every word, made inside the row."""
    rows = encoded.select("doc_id", F.inline(context_windows(F.col("word_ids"), window)))
    return rows.select("doc_id", "pos", "context", "target")


def full_context_pairs(pairs: DataFrame, k: int = 21) -> DataFrame:
    """First k pairs whose context needed no padding."""
    full = pairs.where(~F.array_contains("context", F.lit(0).cast("bigint")))
    return full.orderBy("doc_id", "pos").limit(k)
