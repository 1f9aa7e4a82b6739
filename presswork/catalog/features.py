"""Term features, selection, word ids and context pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from presswork.catalog import fragments as sql
from presswork.catalog.registry import CORPUS_SQL, corpus, documents, query
from presswork.functions import text as tx
from presswork.operators import selection as sel
from presswork.operators import terms as tm
from presswork.operators.grams import CharGrams, WordGrams

WORDS = tx.word_tokens
TRAIN = "split = 'train'"


def GRAMS(text):
    return WordGrams(tx.word_tokens(text))


CHARS = CharGrams

# SQL: every term occurrence with its document, split and category
WORDS_SQL = f"""{CORPUS_SQL},
    occ AS (SELECT doc_id, split, category, unnest({sql.words('text')}) AS term FROM corpus)"""
GRAMS_SQL = f"""{CORPUS_SQL},
    tokens AS (SELECT doc_id, split, category, {sql.words('text')} AS t FROM corpus),
    occ AS (SELECT doc_id, split, category, {sql.ngrams('t')} AS term FROM tokens)"""
CHARS_SQL = f"""{CORPUS_SQL},
    chars AS (SELECT doc_id, split, category, {sql.characters('text')} AS c FROM corpus),
    occ AS (SELECT doc_id, split, category, {sql.char_ngrams('c')} AS term FROM chars)"""
FIT_SQL = """counts AS (SELECT doc_id, split, category, term, count(*) AS n FROM occ GROUP BY ALL),
    vocab AS (SELECT term, count(*) AS df FROM counts WHERE split = 'train' GROUP BY term HAVING count(*) >= 2),
    bag AS (SELECT c.*, v.df FROM counts c JOIN vocab v USING (term))"""
ALL_SQL = """counts AS (SELECT doc_id, term, count(*) AS n FROM occ GROUP BY ALL),
    vocab AS (SELECT term, count(*) AS df FROM counts GROUP BY term HAVING count(*) >= 2),
    totals AS (SELECT term, CAST(sum(n) AS BIGINT) AS n FROM counts JOIN vocab USING (term) GROUP BY term)"""
TFIDF_SQL = """weighted AS (SELECT doc_id, split, category, term,
      (1 + ln(n)) * (ln((1.0 + (SELECT count(*) FROM corpus WHERE split = 'train')) / (1.0 + df)) + 1) AS w FROM bag),
    unit AS (SELECT doc_id, split, category, term,
      round_even(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) * 100, 0) / 100 AS tfidf FROM weighted),
    weights AS (SELECT * FROM unit WHERE tfidf > 0)"""


def fitted(spark, folder, tokens):
    """Corpus and the vocabulary of its training split."""
    docs = corpus(spark, folder)
    return docs, tm.fit_vocabulary(docs.where(TRAIN), tokens(F.col("text")))


def bag(spark, folder, tokens, keep=("split",)):
    docs, vocabulary = fitted(spark, folder, tokens)
    return tm.count_vectorize(docs, tokens(F.col("text")), vocabulary, keep)


def weights(spark, folder, tokens, keep=("split",)):
    docs, vocabulary = fitted(spark, folder, tokens)
    n_docs = docs.where(TRAIN).count()
    return tm.tfidf(docs, tokens(F.col("text")), vocabulary, n_docs, keep)


def _by_term(rows, value):
    """Per split and term: documents and total, to keep large outputs readable."""
    total = F.sum(F.rint(F.col(value) * 100).cast("bigint")).alias("hundredths")
    return rows.groupBy("split", "term").agg(F.count(F.lit(1)).alias("n_docs"), total)


def _by_term_sql(table, value):
    return f"""SELECT split, term, count(*) AS n_docs, CAST(sum(CAST(round_even({value} * 100, 0) AS BIGINT)) AS BIGINT)
    AS hundredths FROM {table} GROUP BY split, term"""


@query(
    "F1 J4",
    f"WITH {WORDS_SQL}, {FIT_SQL} SELECT doc_id, split, term, n FROM bag",
)
def bag_of_words(spark, folder):
    return bag(spark, folder, WORDS)


@query("F2 J4", f"WITH {GRAMS_SQL}, {FIT_SQL} SELECT doc_id, split, term, n FROM bag")
def bag_of_word_ngrams(spark, folder):
    return bag(spark, folder, GRAMS)


@query("F3 J4", f"WITH {CHARS_SQL}, {FIT_SQL} {_by_term_sql('bag', 'n')}")
def bag_of_char_ngrams(spark, folder):
    return _by_term(bag(spark, folder, CHARS), "n")


@query("F4 X24", f"WITH {WORDS_SQL}, {FIT_SQL}, {TFIDF_SQL} SELECT doc_id, split, term, tfidf FROM weights")
def tfidf_words(spark, folder):
    return weights(spark, folder, WORDS)


@query("F5 X24", f"WITH {GRAMS_SQL}, {FIT_SQL}, {TFIDF_SQL} SELECT doc_id, split, term, tfidf FROM weights")
def tfidf_word_ngrams(spark, folder):
    return weights(spark, folder, GRAMS)


@query("F6 X24", f"WITH {CHARS_SQL}, {FIT_SQL}, {TFIDF_SQL} {_by_term_sql('weights', 'tfidf')}")
def tfidf_char_ngrams(spark, folder):
    return _by_term(weights(spark, folder, CHARS), "tfidf")


@query(
    "A5",
    f"""WITH {CHARS_SQL}, {FIT_SQL}, {TFIDF_SQL}
    SELECT term, CAST(sum(CAST(round_even(tfidf * 100, 0) AS BIGINT)) // 100 AS BIGINT) AS n
    FROM weights WHERE split = 'train' GROUP BY term""",
)
def tfidf_char_totals(spark, folder):
    return tm.tfidf_totals(weights(spark, folder, CHARS).where(TRAIN))


def _totals(spark, folder, tokens):
    docs = corpus(spark, folder)
    known = tm.fit_vocabulary(docs, tokens(F.col("text")))
    return tm.term_totals(docs, tokens(F.col("text")), known)


@query("A4", f"WITH {WORDS_SQL}, {ALL_SQL} SELECT term, n FROM totals")
def term_totals(spark, folder):
    return _totals(spark, folder, WORDS)


@query("A7", f"WITH {GRAMS_SQL}, {ALL_SQL} SELECT term, df FROM vocab")
def document_frequencies(spark, folder):
    return tm.document_frequencies(corpus(spark, folder), GRAMS(F.col("text")), 2)


@query(
    "A8",
    f"""WITH {WORDS_SQL}, {FIT_SQL}
    SELECT term, df, row_number() OVER (ORDER BY term) - 1 AS position FROM vocab""",
)
def vocabulary(spark, folder):
    return tm.number_vocabulary(fitted(spark, folder, WORDS)[1])


@query("W1", f"WITH {WORDS_SQL}, {ALL_SQL} SELECT term, n FROM totals ORDER BY n DESC, term LIMIT 40")
def top_terms(spark, folder):
    return tm.top_terms(_totals(spark, folder, WORDS), 40)


@query("W2", f"WITH {GRAMS_SQL}, {ALL_SQL} SELECT term, n FROM totals ORDER BY n DESC, term LIMIT 20")
def top_word_ngrams(spark, folder):
    return tm.top_terms(_totals(spark, folder, GRAMS), 20)


@query(
    "P4",
    f"""WITH {WORDS_SQL}, {FIT_SQL}
    SELECT count(DISTINCT doc_id) AS n_docs, count(DISTINCT term) AS n_terms, count(*) AS n_cells FROM bag""",
)
def matrix_shape(spark, folder):
    from presswork.operators.tables import shape

    return shape(bag(spark, folder, WORDS))


ANOVA_SQL = """sizes AS (SELECT category, count(*) AS size FROM corpus WHERE split = 'train' GROUP BY category),
    sums AS (SELECT term, category, sum({v}) / 100.0::DOUBLE AS s, sum({v} * {v})::DOUBLE / 10000 AS q
      FROM (SELECT term, category, CAST(round_even({value} * 100, 0) AS BIGINT) AS v FROM {table} WHERE split = 'train')
      GROUP BY term, category),
    parts AS (SELECT term, sum(s) AS total, sum(s * s / size) AS c, sum(q) AS q
      FROM sums JOIN sizes USING (category) GROUP BY term),
    spreads AS (SELECT term, total, q, c - total * total / (SELECT sum(size) FROM sizes) AS b, q - c AS w FROM parts),
    scores AS (SELECT term, total, CASE WHEN w <= 1e-9 * q AND b <= 1e-9 * q THEN NULL
        WHEN w <= 1e-9 * q THEN CAST('Infinity' AS DOUBLE)
        ELSE (b / 3) / (w / ((SELECT sum(size) FROM sizes) - 4)) END AS f_score FROM spreads)"""


def anova_sql(table, value):
    return ANOVA_SQL.format(v="v", table=table, value=value)


def _scores(rows, docs, value):
    return sel.anova_f(rows.where(TRAIN), sel.class_sizes(docs.where(TRAIN)), value)


def _word_scores(spark, folder):
    docs, known = fitted(spark, folder, WORDS)
    rows = tm.count_vectorize(docs, WORDS(F.col("text")), known, ("split", "category"))
    return rows, _scores(rows, docs, "n")


@query(
    "F7",
    f"""WITH {WORDS_SQL}, {FIT_SQL}, {anova_sql('bag', 'n')}
    SELECT term, round(f_score, 6) AS f_score, total FROM scores""",
)
def anova_scores(spark, folder):
    return _word_scores(spark, folder)[1].select("term", F.round("f_score", 6).alias("f_score"), "total")


def select_sql(bag_sql, table, value):
    return f"""WITH {bag_sql}, {anova_sql(table, value)},
    ranked AS (SELECT term, row_number() OVER (ORDER BY round(f_score, 9) DESC NULLS LAST, term) AS rank,
      count(*) OVER () AS total FROM scores),
    percents AS (SELECT unnest([10, 25, 50, 75]) AS percent),
    selected AS (SELECT percent, term, rank FROM ranked JOIN percents ON rank <= total * percent // 100)"""


@query(
    "F8",
    select_sql(f"{WORDS_SQL}, {FIT_SQL}", "bag", "n") + " SELECT percent, term, rank FROM selected",
)
def select_percentiles(spark, folder):
    return sel.select_percentiles(_word_scores(spark, folder)[1]).select("percent", "term", "rank")


@query(
    "P12 F8",
    select_sql(f"{WORDS_SQL}, {FIT_SQL}", "bag", "n")
    + """ SELECT percent, doc_id, split, term, n FROM bag JOIN selected USING (term)""",
)
def selected_bag_of_words(spark, folder):
    docs, known = fitted(spark, folder, WORDS)
    rows = tm.count_vectorize(docs, WORDS(F.col("text")), known, ("split", "category"))
    kept = sel.select_features(rows, sel.class_sizes(docs.where(TRAIN)), "n")
    return kept.select("percent", "doc_id", "split", "term", "n")


def _selected_weights(spark, folder, tokens):
    docs, known = fitted(spark, folder, tokens)
    n_docs = docs.where(TRAIN).count()
    rows = tm.tfidf(docs, tokens(F.col("text")), known, n_docs, ("split", "category"))
    kept = sel.select_features(rows, sel.class_sizes(docs.where(TRAIN)), "tfidf")
    return kept.groupBy("percent", "split", "term").agg(F.count(F.lit(1)).alias("n_docs"))


def _selected_weights_sql(occurrences):
    return (
        select_sql(f"{occurrences}, {FIT_SQL}, {TFIDF_SQL}", "weights", "tfidf")
        + " SELECT percent, split, term, count(*) AS n_docs FROM weights JOIN selected USING (term) GROUP BY ALL"
    )


@query("F8", _selected_weights_sql(WORDS_SQL))
def selected_tfidf_words(spark, folder):
    return _selected_weights(spark, folder, WORDS)


@query("F8", _selected_weights_sql(GRAMS_SQL))
def selected_tfidf_word_ngrams(spark, folder):
    return _selected_weights(spark, folder, GRAMS)


@query("F8", _selected_weights_sql(CHARS_SQL))
def selected_tfidf_char_ngrams(spark, folder):
    return _selected_weights(spark, folder, CHARS)


def _selected_bag(spark, folder, tokens):
    docs, known = fitted(spark, folder, tokens)
    rows = tm.count_vectorize(docs, tokens(F.col("text")), known, ("split", "category"))
    kept = sel.select_features(rows, sel.class_sizes(docs.where(TRAIN)), "n")
    return kept.groupBy("percent", "split", "term").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n")
    )


def _selected_bag_sql(occurrences):
    return select_sql(f"{occurrences}, {FIT_SQL}", "bag", "n") + (
        " SELECT percent, split, term, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n"
        " FROM bag JOIN selected USING (term) GROUP BY ALL"
    )


@query("F8", _selected_bag_sql(GRAMS_SQL))
def selected_word_ngrams(spark, folder):
    return _selected_bag(spark, folder, GRAMS)


@query("F8", _selected_bag_sql(CHARS_SQL))
def selected_char_ngrams(spark, folder):
    return _selected_bag(spark, folder, CHARS)


@query(
    "W1 F8",
    select_sql(f"{WORDS_SQL}, {FIT_SQL}", "bag", "n")
    + """ SELECT term, CAST(sum(n) AS BIGINT) AS n FROM bag JOIN selected USING (term)
    WHERE percent = 10 AND split = 'train' GROUP BY term ORDER BY n DESC, term LIMIT 40""",
)
def top_selected_terms(spark, folder):
    docs, known = fitted(spark, folder, WORDS)
    train = docs.where(TRAIN)
    rows = tm.count_vectorize(train, WORDS(F.col("text")), known, ("split", "category"))
    kept = sel.select_features(rows, sel.class_sizes(train), "n", [10])
    return tm.top_terms(kept.groupBy("term").agg(F.sum("n").alias("n")), 40)


IDS_SQL = f"""seen AS (SELECT doc_id, unnest({sql.sequence('text')}) AS word,
      generate_subscripts({sql.sequence('text')}, 1) AS pos FROM documents),
    counted AS (SELECT word, count(*) AS n, min(doc_id * 10000000 + pos) AS first FROM seen GROUP BY word),
    ids AS (SELECT word, n, row_number() OVER (ORDER BY n DESC, first) AS word_id FROM counted)"""


@query("X21", f"WITH {IDS_SQL} SELECT word, n, word_id FROM ids")
def word_ids(spark, folder):
    return tm.build_word_ids(documents(spark, folder), tx.sequence_tokens(F.col("text")))


def _encoded(spark, folder):
    docs = documents(spark, folder)
    tokens = tx.sequence_tokens(F.col("text"))
    from presswork.plans import staged

    return tm.encode_words(docs, tokens, staged(tm.build_word_ids(docs, tokens), "words"))


@query(
    "X21",
    f"""WITH {IDS_SQL} SELECT doc_id, coalesce(string_agg(word_id::VARCHAR, ' ' ORDER BY pos), '') AS word_ids
    FROM documents LEFT JOIN (SELECT * FROM seen JOIN ids USING (word)) USING (doc_id) GROUP BY doc_id""",
)
def encoded_documents(spark, folder):
    return _encoded(spark, folder).select(
        "doc_id", F.array_join(F.col("word_ids").cast("array<string>"), " ").alias("word_ids")
    )


PAIRS_SQL = f"""{IDS_SQL},
    placed AS (SELECT doc_id, pos - 1 AS pos, word_id FROM seen JOIN ids USING (word)),
    near AS (SELECT doc_id, pos, word_id AS target,
      coalesce(list(word_id) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING), []) AS l,
      coalesce(list(word_id) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING), []) AS r
      FROM placed),
    pairs AS (SELECT doc_id, pos, target,
      list_concat(list_transform(range(0, 4 - len(l) - len(r)), lambda i: 0), l, r) AS context FROM near)"""


@query(
    "W5 X22",
    f"""WITH {PAIRS_SQL}
    SELECT doc_id, CAST(pos AS INTEGER) AS pos, array_to_string(context, ' ') AS context, target FROM pairs""",
)
def context_pairs(spark, folder):
    pairs = tm.context_pairs(_encoded(spark, folder))
    return pairs.withColumn("context", F.array_join(F.col("context").cast("array<string>"), " "))


@query(
    "W6",
    f"""WITH {PAIRS_SQL}
    SELECT doc_id, CAST(pos AS INTEGER) AS pos, array_to_string(context, ' ') AS context, target FROM pairs
    WHERE NOT list_contains(context, 0) ORDER BY doc_id, pos LIMIT 21""",
)
def full_context_pairs(spark, folder):
    pairs = tm.full_context_pairs(tm.context_pairs(_encoded(spark, folder)))
    return pairs.withColumn("context", F.array_join(F.col("context").cast("array<string>"), " "))
