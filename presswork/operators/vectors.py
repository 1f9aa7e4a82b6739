"""Word vectors, document embeddings and similar words."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presswork.functions.numbers import dot
from presswork.operators.terms import document_frequencies
from presswork.plans import lookup_join, staged

# bytes of word vectors a broadcast may hold
VECTOR_BYTES = 128 * 1024 * 1024
# words of documents whose vectors a task adds up at once
ADDED_AT_ONCE = 1 << 12


def train_word2vec(
    docs: DataFrame,
    tokens: Column,
    size: int = 300,
    window: int = 20,
    min_count: int = 5,
    iterations: int = 5,
    partitions: int | None = None,
    seed: int = 1,
) -> DataFrame:
    """Staged (word, vector) of a skip-gram model trained on token lists."""
    model = Word2Vec(
        vectorSize=size,
        windowSize=window,
        minCount=min_count,
        maxIter=iterations,
        numPartitions=partitions or docs.sparkSession.sparkContext.defaultParallelism,
        seed=seed,
        inputCol="tokens",
        outputCol="vector",
    )
    vectors = model.fit(docs.select(tokens.alias("tokens"))).getVectors()
    return staged(vectors.select("word", vector_to_array("vector").alias("vector")), "word-vectors")


def vector_size(vectors: DataFrame, column: str = "vector") -> int:
    row = vectors.select(F.size(column)).first()
    return row[0] if row else 0


def doc_embeddings(docs: DataFrame, tokens: Column, vectors: DataFrame) -> DataFrame:
    """(doc_id, vec): mean of the known words' vectors, zeros where no word is known.

    Texts stay where they are: each task adds up the vectors of its documents' words from a
    broadcast table, and one row a document moves. Where ``vectors`` is above ``VECTOR_BYTES``,
    the table holds the words of most documents (by ``df``, counted if it is no column); the
    rarer words' vectors are joined to the few documents that hold them.
    """
    vectors = vectors.where(F.col("word").isNotNull() & F.col("vector").isNotNull())
    size = vector_size(vectors)
    rows = max(1, VECTOR_BYTES // (8 * max(size, 1)))
    common, rare = vectors, None
    if vectors.count() > rows:
        if "df" not in vectors.columns:
            vectors = staged(vectors.join(document_frequencies(docs, tokens), F.col("word") == F.col("term")).drop("term"), "weighed")
        least = _least_df(vectors, rows)
        common, rare = vectors.where(F.col("df") >= least), vectors.where(F.col("df") < least)
    parts = _added_up(docs, tokens, common, size, rest=rare is not None)
    if rare is not None:
        parts = staged(parts, "common-words")
        rare = staged(rare.select("word", "vector", "df"), "rare-words")
        found = lookup_join(parts.select("doc_id", F.inline("rest")), rare, "word", weight="df", broadcast_rows=rows)
        parts = parts.select("doc_id", "n", "vec").unionByName(found.select("doc_id", "n", F.col("vector").cast("array<double>").alias("vec")))
    mean = Summarizer.mean(array_to_vector("vec"), F.col("n"))
    pooled = parts.where("n > 0").repartition("doc_id").groupBy("doc_id").agg(mean.alias("mean"))
    means = pooled.select("doc_id", vector_to_array("mean").alias("mean"))
    zeros = F.array_repeat(F.lit(0.0), size)
    joined = docs.select("doc_id").join(means, "doc_id", "left")
    return joined.select("doc_id", F.coalesce("mean", zeros).alias("vec"))


def _least_df(vectors: DataFrame, rows: int) -> int:
    """The least df whose words, with those of any higher one, are at most ``rows``."""
    least, total = None, 0
    counts = vectors.groupBy("df").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("df")).collect()
    for row in counts:
        total += row.words
        if total > rows:
            break
        least = row.df
    return counts[0].df + 1 if least is None else least


def _added_up(docs: DataFrame, tokens: Column, vectors: DataFrame, size: int, rest: bool) -> DataFrame:
    """(doc_id, n, vec): how many words of a row have a vector, and the mean of their vectors.

    ``rest`` adds the other words with their counts, as an array of (word, n).
    """
    table = vectors.select("word", "vector").toArrow().sort_by("word")
    words, vector = (table.column(c).combine_chunks() for c in ("word", "vector"))
    matrix = pc.fill_null(vector.flatten(), 0.0).to_numpy().reshape(len(words), size)
    first = np.flatnonzero(np.diff(words.dictionary_encode().indices.to_numpy(), prepend=-1))
    times = np.diff(first, append=len(words)).astype(float)
    if len(first) < len(words):  # a word may have several vectors
        words, matrix = words.take(pa.array(first)), np.add.reduceat(matrix.astype(float), first, axis=0)
    shared = docs.sparkSession.sparkContext.broadcast((words, times, matrix))

    def counted(row: pa.Array, code: pa.Array, codes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        pairs, n = np.unique(row.to_numpy().astype(np.int64) * max(codes, 1) + code.to_numpy(), return_counts=True)
        return *np.divmod(pairs, max(codes, 1)), n.astype(float)

    def listed(row: np.ndarray, values: pa.Array, count: int) -> pa.Array:
        ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=count))])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, times, matrix = shared.value
        for batch in batches:
            lists, count = batch.column("tokens"), batch.num_rows
            text, row = lists.flatten(), pc.list_parent_indices(lists)
            code = pc.index_in(text, value_set=words)
            known = code.is_valid()
            at, which, n = counted(row.filter(known), code.filter(known), len(words))
            total = np.bincount(at, weights=n * times[which], minlength=count).astype(float)
            sums = np.zeros((count, size))
            for begin in range(0, len(at), ADDED_AT_ONCE):
                part = slice(begin, begin + ADDED_AT_ONCE)
                starts = np.flatnonzero(np.diff(at[part], prepend=-1))
                sums[at[part][starts]] += np.add.reduceat(matrix[which[part]] * n[part, None], starts, axis=0)
            sums /= np.maximum(total, 1.0)[:, None]
            vec = listed(np.repeat(np.arange(count), size), pa.array(sums.ravel()), count)
            columns = {"doc_id": batch.column("doc_id"), "n": pa.array(total), "vec": vec}
            if rest:
                other = pc.and_(pc.invert(known), text.is_valid())
                left = text.filter(other).dictionary_encode()
                at, which, n = counted(row.filter(other), left.indices, len(left.dictionary))
                entries = pa.StructArray.from_arrays([left.dictionary.take(pa.array(which)), pa.array(n)], names=["word", "n"])
                columns["rest"] = listed(at, entries, count)
            yield pa.RecordBatch.from_pydict(columns)

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n double, vec array<double>"
    schema += ", rest array<struct<word: string, n: double>>" if rest else ""
    return docs.select("doc_id", tokens.alias("tokens")).mapInArrow(run, schema)


def similar_words(vectors: DataFrame, words: Sequence[str], k: int = 5, key: str = "word") -> DataFrame:
    """(query, word, cosine, rank): the k nearest words of each asked word.

    The asked vectors travel as one array value, one entry per asked word. The
    ranking keeps k rows per task and query before anything is shuffled.
    """
    unit = vectors.select(key, F.col("vector").cast("array<double>").alias("v")).withColumn(
        "_norm", F.sqrt(dot(F.col("v"), F.col("v")))
    )
    asked = unit.where(F.col(key).isin(list(words)))
    entry = F.struct(F.col(key).alias("query"), F.col("v").alias("qv"), F.col("_norm").alias("qn"))
    queries = asked.agg(F.array_sort(F.collect_list(entry))).scalar()
    pairs = unit.withColumn("_asked", queries).select(key, "v", "_norm", F.inline("_asked"))
    cosine = dot(F.col("v"), F.col("qv")) / (F.col("_norm") * F.col("qn"))
    scored = pairs.where(F.col(key) != F.col("query")).select("query", key, F.round(cosine, 9).alias("cosine"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("cosine"), key))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k)


def cluster_centers(assigned: DataFrame, vec: str = "vec", label: str = "cluster") -> DataFrame:
    """(cluster, size, pos, value): mean vector of each cluster as a table."""
    as_vector = array_to_vector(F.col(vec).cast("array<double>"))
    means = assigned.groupBy(label).agg(F.count(F.lit(1)).alias("size"), Summarizer.mean(as_vector).alias("m"))
    return means.select(label, "size", F.posexplode(vector_to_array("m")).alias("pos", "value"))


def long_vectors(vectors: DataFrame, key: str, vec: str) -> DataFrame:
    """(key, pos, value): one row per vector component."""
    return vectors.select(key, F.posexplode(vec).alias("pos", "value"))
