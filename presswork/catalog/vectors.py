"""Embeddings, similarity, topics and clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from presswork.catalog import fragments as sql
from presswork.catalog.registry import corpus, documents, query, table
from presswork.catalog.tables import _path
from presswork.functions import text as tx
from presswork.operators import vectors as vc
from presswork.plans import staged
from presswork.sources import tables as src


def word_vectors(spark, folder):
    """A vector for every word of three or more documents: the embedding its hash points to."""
    vectors = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    from presswork.operators.terms import document_frequencies

    words = document_frequencies(documents(spark, folder), tx.wordpunct_tokens(F.col("text")), 3)
    slot = F.conv(F.substring(F.md5("term"), 1, 7), 16, 10).cast("bigint") % vectors.agg(F.count("vec_id")).scalar()
    words = words.select(F.col("term").alias("word"), "df", slot.alias("vec_id"))
    return staged(words.join(vectors, "vec_id").select("word", "vector", "df"), "words")


VECTORS_SQL = f"""occ AS (SELECT doc_id, unnest({sql.wordpunct('text')}) AS word FROM documents),
    counts AS (SELECT doc_id, word, count(*) AS n FROM occ GROUP BY ALL),
    words AS (SELECT word, CAST('0x' || md5(word)[1:7] AS BIGINT) % (SELECT count(*) FROM embeddings) AS vec_id
      FROM counts GROUP BY word HAVING count(*) >= 3),
    vectors AS (SELECT word, embedding AS vector FROM words JOIN embeddings USING (vec_id))"""


@query(
    "J5 X25 F16",
    f"""WITH {VECTORS_SQL},
    parts AS (SELECT doc_id, n, unnest(vector)::DOUBLE AS x, generate_subscripts(vector, 1) - 1 AS pos
      FROM counts JOIN vectors USING (word)),
    means AS (SELECT doc_id, pos, sum(n * x) / sum(n) AS value FROM parts GROUP BY doc_id, pos),
    cells AS (SELECT doc_id, unnest(range(0, 64)) AS pos FROM documents)
    SELECT doc_id, CAST(pos AS INTEGER) AS pos, round(coalesce(value, 0), 6) + 0.0 AS value
    FROM cells LEFT JOIN means USING (doc_id, pos)""",
)
def document_embeddings(spark, folder):
    docs = documents(spark, folder)
    vectors = vc.doc_embeddings(docs, tx.wordpunct_tokens(F.col("text")), word_vectors(spark, folder))
    return vc.long_vectors(vectors, "doc_id", "vec").withColumn("value", F.round("value", 6) + 0.0)


@query(
    "F19",
    f"""WITH {VECTORS_SQL},
    picked AS (SELECT word FROM counts JOIN vectors USING (word) GROUP BY word ORDER BY sum(n) DESC, word LIMIT 5),
    norms AS (SELECT word, list_transform(vector, lambda x: x::DOUBLE) AS v FROM vectors),
    pairs AS (SELECT q.word AS query, w.word AS word, round(list_dot_product(w.v, q.v)
      / (sqrt(list_dot_product(w.v, w.v)) * sqrt(list_dot_product(q.v, q.v))), 9) AS cosine
      FROM norms w, norms q WHERE q.word IN (SELECT word FROM picked) AND w.word <> q.word)
    SELECT query, word, round(cosine, 6) AS cosine, CAST(row_number() OVER (PARTITION BY query ORDER BY cosine DESC, word)
      AS INTEGER) AS rank FROM pairs QUALIFY rank <= 5""",
)
def similar_words(spark, folder):
    """Nearest words of the five most frequent ones."""
    vectors = word_vectors(spark, folder)
    tokens = documents(spark, folder).select(F.explode(tx.wordpunct_tokens(F.col("text"))).alias("word"))
    counted = tokens.groupBy("word").agg(F.count(F.lit(1)).alias("n")).join(vectors.select("word"), "word", "left_semi")
    picked = [row.word for row in counted.orderBy(F.desc("n"), "word").limit(5).collect()]
    return vc.similar_words(vectors, picked, 5).withColumn("cosine", F.round("cosine", 6))


@query(
    "F13",
    """WITH parts AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS pos
      FROM embeddings)
    SELECT label AS cluster, count(*) AS size, CAST(pos AS INTEGER) AS pos, round(avg(x), 6) + 0.0 AS value
    FROM parts GROUP BY label, pos""",
)
def cluster_centers(spark, folder):
    """Centres of the labelled embeddings; the labels stand for cluster numbers."""
    assigned = table(spark, folder, "embeddings").select(F.col("label").alias("cluster"), F.col("embedding").alias("vec"))
    return vc.cluster_centers(assigned).withColumn("value", F.round("value", 6) + 0.0)


@query("F15 S9")
def train_word2vec(spark, folder):
    """Word vectors trained on the cleaned corpus, saved and read back."""
    docs = corpus(spark, folder).select("doc_id", tx.clean_text(F.col("text")).alias("cleaned"))
    vectors = vc.train_word2vec(docs, tx.wordpunct_tokens(F.col("cleaned")), size=100, window=20, iterations=50)
    path = _path(spark, "word-vectors")
    src.save_vectors(vectors, path)
    return vc.long_vectors(src.load_vectors(spark, path), "word", "vector")
