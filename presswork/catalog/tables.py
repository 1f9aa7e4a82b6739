"""Sources, sinks, projections, joins, grouping and sampling."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from presswork.catalog.registry import CLASSES, CORPUS_SQL, corpus, documents, query, table
from presswork.functions import text as tx
from presswork.functions.numbers import first_argmax, round_even
from presswork.functions.wordlists import CLASS_NAMES
from presswork.operators import sampling as sm
from presswork.operators import tables as tb
from presswork.plans.stage import stage_folder
from presswork.sources import numpy_files as nf
from presswork.sources import tables as src

NAMES_SQL = "names AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{name}')" for i, name in enumerate(CLASS_NAMES, start=1)
) + ") AS t(category, class_name))"


def _path(spark, label):
    return f"{stage_folder(spark)}/{label}-{uuid.uuid4().hex}"


@query("S1", f"WITH {CORPUS_SQL} SELECT category, headline, replace(text, chr(10), ' ') AS content FROM corpus")
def read_corpus_csv(spark, folder):
    path = _path(spark, "corpus")
    docs = corpus(spark, folder).select(
        "category", "headline", F.replace("text", F.lit("\n"), F.lit(" ")).alias("content")
    )
    docs.write.options(**src.KEEP_BLANKS).option("quoteAll", True).option("escape", '"').csv(path)
    return src.read_corpus_csv(spark, path)


@query(
    "S2 J6",
    f"""WITH {CORPUS_SQL}, {NAMES_SQL} SELECT category, class_name, count(*) AS n
    FROM corpus LEFT JOIN names USING (category) GROUP BY ALL""",
)
def class_names(spark, folder):
    counted = corpus(spark, folder).groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    return tb.class_names(counted, src.read_classes(spark)).select("category", "class_name", "n")


@query("S3 S4", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def save_and_load_table(spark, folder):
    path = _path(spark, "table")
    src.save_table(table(spark, folder, "documents"), path)
    return src.load_table(spark, path)


@query("S5", "SELECT doc_id, lang FROM documents")
def load_two_columns(spark, folder):
    return src.load_table(spark, f"{folder}/documents.parquet", ["doc_id", "lang"])


@query("S6", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def save_and_load_csv(spark, folder):
    path, docs = _path(spark, "csv"), table(spark, folder, "documents")
    src.save_csv(docs, path)
    return src.load_csv(spark, path, docs.schema)


@query(
    "S7",
    """WITH kept AS (SELECT DISTINCT source FROM documents)
    SELECT row_number() OVER (ORDER BY source) AS seq, source FROM kept""",
)
def save_and_load_sources(spark, folder):
    path = _path(spark, "sources")
    src.save_sources(src.number_sources(table(spark, folder, "documents")), path)
    return src.load_sources(spark, path)


@query("S8", "SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings")
def save_and_load_vectors(spark, folder):
    path = _path(spark, "vectors")
    vectors = table(spark, folder, "embeddings")
    src.save_vectors(vectors.withColumn("embedding", F.col("embedding").cast("array<double>")), path)
    loaded = src.load_vectors(spark, path).select("vec_id", "label", F.posexplode("embedding").alias("pos", "x"))
    return loaded.withColumn("pos", F.col("pos").cast("bigint"))


@query("S8", "SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings")
def save_and_load_numpy(spark, folder):
    """Vectors written as NumPy archives by tasks and read back by ranges of rows."""
    path = _path(spark, "numpy")
    nf.save_numpy(table(spark, folder, "embeddings"), path, "vec_id", "embedding")
    loaded = nf.load_numpy(spark, path).select(F.col("key").alias("vec_id"), F.posexplode("vector").alias("pos", "x"))
    return loaded.withColumn("pos", F.col("pos").cast("bigint"))


@query("P1", "SELECT doc_id AS id, text AS content, lang AS language, source AS origin, n_chars AS size FROM documents")
def rename_columns(spark, folder):
    return tb.rename_all(table(spark, folder, "documents"), ["id", "content", "language", "origin", "size"])


@query("P2", "SELECT doc_id, text, lang, n_chars FROM documents")
def drop_column(spark, folder):
    return table(spark, folder, "documents").drop("source")


@query("P3", "SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 20")
def preview(spark, folder):
    return tb.preview(table(spark, folder, "documents").select("doc_id", "lang", "n_chars"), 20)


@query("P5", f"WITH {CORPUS_SQL} SELECT doc_id, headline FROM corpus WHERE category = 1")
def one_category(spark, folder):
    return corpus(spark, folder).where("category = 1").select("doc_id", "headline")


@query("P7", f"WITH {CORPUS_SQL} SELECT doc_id, text AS x, category AS y FROM corpus")
def predictor_and_target(spark, folder):
    return corpus(spark, folder).select("doc_id", F.col("text").alias("x"), F.col("category").alias("y"))


@query("P8", f"WITH {CORPUS_SQL} SELECT doc_id, category, headline FROM corpus WHERE doc_id = 34")
def document_at(spark, folder):
    return tb.at_key(corpus(spark, folder), 34).select("doc_id", "category", "headline")


def _sampled(n, seed):
    return f"ORDER BY md5(concat('{seed}:', doc_id)), doc_id LIMIT {n}"


@query("P9", f"SELECT doc_id, lang FROM documents {_sampled(400, 123)}")
def sample_documents(spark, folder):
    return sm.sample_n(table(spark, folder, "documents").select("doc_id", "lang"), 400)


@query(
    "P10",
    f"SELECT doc_id, n_chars, quality FROM documents JOIN labels USING (doc_id) {_sampled(100, 123)}",
)
def aligned_sample(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "n_chars")
    joined = docs.join(table(spark, folder, "labels").select("doc_id", "quality"), "doc_id")
    return sm.sample_n(joined, 100)


@query("P11", "SELECT vec_id, label FROM embeddings ORDER BY md5(concat('0:', vec_id)), vec_id LIMIT 20")
def background_sample(spark, folder):
    return sm.sample_n(table(spark, folder, "embeddings").select("vec_id", "label"), 20, seed=0, key="vec_id")


@query("A1", f"WITH {CORPUS_SQL} SELECT category, count(headline) AS n FROM corpus GROUP BY category")
def category_counts(spark, folder):
    return tb.category_counts(corpus(spark, folder))


@query(
    "A1 P9",
    f"""WITH {CORPUS_SQL}, sampled AS (SELECT * FROM corpus {_sampled(400, 123)})
    SELECT category, count(headline) AS n FROM sampled GROUP BY category""",
)
def sampled_category_counts(spark, folder):
    return tb.category_counts(sm.sample_n(corpus(spark, folder).select("doc_id", "category", "headline"), 400))


@query(
    "A2",
    f"""WITH {CORPUS_SQL}, marked AS (SELECT *, nullif(headline, text) AS lead FROM corpus)
    SELECT category, count(headline) AS n_headline, count(lead) AS n_lead, count(content) AS n_content
    FROM marked GROUP BY category""",
)
def filled_counts(spark, folder):
    docs = corpus(spark, folder).withColumn("lead", F.nullif("headline", "text"))
    return tb.filled_counts(docs, "category", ["headline", "lead", "content"])


def _describe_sql(column):
    return f"""SELECT category, '{column}' AS field, CAST(sum(n) AS BIGINT) AS n, count(*) AS n_unique,
      arg_min(value, (-n, value)) AS top, max(n) AS freq
    FROM (SELECT category, {column} AS value, count(*) AS n FROM corpus WHERE {column} IS NOT NULL GROUP BY ALL)
    GROUP BY category"""


@query("A3", f"WITH {CORPUS_SQL} {_describe_sql('headline')} UNION ALL {_describe_sql('text')}")
def describe_by_category(spark, folder):
    return tb.describe_by(corpus(spark, folder), "category", ["headline", "text"])


@query(
    "J1",
    """SELECT doc_id, lang, quality::DOUBLE AS predicted FROM documents LEFT JOIN labels USING (doc_id)""",
)
def attach_predictions(spark, folder):
    predictions = table(spark, folder, "labels").select(
        "doc_id", F.col("quality").cast("double").alias("predicted")
    )
    return tb.attach_predictions(table(spark, folder, "documents").select("doc_id", "lang"), predictions)


@query(
    "W7",
    "SELECT doc_id, CAST(ntile(5) OVER (ORDER BY doc_id) - 1 AS INTEGER) AS fold FROM documents",
)
def assign_folds(spark, folder):
    return sm.assign_folds(table(spark, folder, "documents").select("doc_id"), 5)


@query(
    "W8",
    "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS best FROM embeddings",
)
def row_argmax(spark, folder):
    return table(spark, folder, "embeddings").select("vec_id", first_argmax(F.col("embedding")).alias("best"))


@query(
    "W9",
    """WITH ranked AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn, count(*) OVER () AS n FROM documents),
    percents AS (SELECT CAST(unnest(range(10, 101, 10)) AS INTEGER) AS percent)
    SELECT percent, doc_id FROM ranked JOIN percents ON rn <= n * percent // 100""",
)
def prefix_subsets(spark, folder):
    return sm.prefix_subsets(table(spark, folder, "documents").select("doc_id")).select("percent", "doc_id")


@query(
    "X23",
    f"""WITH {CORPUS_SQL}, classes AS (SELECT CAST(unnest([1, 2, 3, 4]) AS INTEGER) AS c)
    SELECT doc_id, c - 1 AS class_id, CAST(category = c AS INTEGER) AS y FROM corpus, classes""",
)
def binarize_labels(spark, folder):
    return tb.binarize_labels(corpus(spark, folder).select("doc_id", "category"), CLASSES).drop("category")


@query(
    "X24",
    """SELECT o_orderkey, round_even(o_totalprice / 7 * 100, 0) / 100 AS cents,
      round_even(o_totalprice / 7 * 1000, 0) / 1000 AS mills FROM orders""",
)
def round_half_even(spark, folder):
    price = F.col("o_totalprice") / 7
    return table(spark, folder, "orders").select(
        "o_orderkey", round_even(price, 2).alias("cents"), round_even(price, 3).alias("mills")
    )


@query("S10 F1", None)
def save_and_load_terms(spark, folder):
    """Bag of words saved as a long table per split and read back; same rows as bag_of_words."""
    from presswork.catalog.features import bag_of_words

    path = _path(spark, "terms")
    src.save_terms(bag_of_words(spark, folder), path)
    return src.load_terms(spark, path).select("doc_id", "split", "term", "n")


@query(
    "X12",
    None,
)
def clean_short_texts(spark, folder):
    """Cleaning of the short text tables: conversation turns and benchmark items."""
    turns = table(spark, folder, "conversations").select(
        F.concat_ws("-", F.lit("turn"), "conv_id", "turn").alias("text_id"), "text"
    )
    items = table(spark, folder, "benchmark").select(F.concat_ws("-", F.lit("item"), "item_id").alias("text_id"), "text")
    return turns.unionByName(items).select("text_id", tx.clean_text(F.col("text")).alias("cleaned"))


def _short_sql():
    from presswork.catalog import fragments as sql

    return f"""SELECT concat_ws('-', 'turn', conv_id, turn) AS text_id, {sql.clean('text')} AS cleaned FROM conversations
    UNION ALL SELECT concat_ws('-', 'item', item_id), {sql.clean('text')} FROM benchmark"""


def _with_sql(name, sql_text):
    from dataclasses import replace

    from presswork.catalog.registry import CATALOG

    CATALOG[name] = replace(CATALOG[name], sql=sql_text)


_with_sql("clean_short_texts", _short_sql())


def _terms_sql():
    from presswork.catalog.registry import CATALOG
    from presswork.catalog import features  # noqa: F401

    return CATALOG["bag_of_words"].sql


_with_sql("save_and_load_terms", _terms_sql())
