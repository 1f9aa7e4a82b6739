"""Text functions and corpus cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.catalog import fragments as sql
from presswork.catalog.registry import CORPUS_SQL, corpus, documents, query, table
from presswork.functions import text as tx
from presswork.operators import cleaning as cl
from presswork.operators import sentences as st
from presswork.operators.terms import top_terms
from presswork.plans import staged


def rejected(spark: SparkSession, folder: str) -> DataFrame:
    """Reviewer's list: found sources that hold a comma are place lists, not sources."""
    dated = corpus(spark, folder).select(tx.strip_dates(F.col("content")).alias("content_cleaned"))
    return cl.extract_sources(dated).where("contains(source, ',')")


@query("X1", f"SELECT page_id, {sql.markup('html')} AS stripped FROM pages")
def strip_markup(spark, folder):
    return table(spark, folder, "pages").select("page_id", tx.strip_markup(F.col("html")).alias("stripped"))


@query("X2", f"WITH {CORPUS_SQL} SELECT doc_id, {sql.font('content')} AS stripped FROM corpus")
def strip_font(spark, folder):
    return corpus(spark, folder).select("doc_id", tx.strip_font(F.col("content")).alias("stripped"))


@query("X3", f"WITH {CORPUS_SQL} SELECT doc_id, {sql.dates('content')} AS stripped FROM corpus")
def strip_dates(spark, folder):
    return corpus(spark, folder).select("doc_id", tx.strip_dates(F.col("content")).alias("stripped"))


@query(
    "X4 X5 A6",
    f"""WITH {CORPUS_SQL} SELECT DISTINCT {sql.dateline(sql.dates('content'))} AS source
    FROM corpus WHERE {sql.dateline(sql.dates('content'))} <> '' ORDER BY source""",
)
def extract_sources(spark, folder):
    dated = corpus(spark, folder).withColumn("content_cleaned", tx.strip_dates(F.col("content")))
    return cl.extract_sources(dated).orderBy("source")


DATED_SQL = f"dated AS (SELECT *, {sql.dates('content')} AS dated FROM corpus)"
FOUND_SQL = f"found AS (SELECT split, {sql.dateline('dated')} AS source FROM dated)"


@query(
    "U1",
    f"""WITH {CORPUS_SQL}, {DATED_SQL}, {FOUND_SQL}
    SELECT source FROM found WHERE split = 'train' AND source <> ''
    UNION SELECT source FROM found WHERE split = 'test' AND source <> ''""",
)
def merge_sources(spark, folder):
    dated = corpus(spark, folder).withColumn("content_cleaned", tx.strip_dates(F.col("content")))
    train = cl.extract_sources(dated.where("split = 'train'"))
    return cl.merge_sources(train, cl.extract_sources(dated.where("split = 'test'")))


REVIEWED_SQL = f"""{CORPUS_SQL}, {DATED_SQL}, {FOUND_SQL},
    reviewed AS (SELECT DISTINCT source FROM found WHERE source <> '' AND NOT contains(source, ','))"""


@query("J8", f"WITH {REVIEWED_SQL} SELECT source FROM reviewed")
def review_sources(spark, folder):
    dated = corpus(spark, folder).withColumn("content_cleaned", tx.strip_dates(F.col("content")))
    return cl.review_sources(cl.extract_sources(dated), rejected(spark, folder))


LISTED_SQL = "listed AS (SELECT coalesce(list(source ORDER BY source), []) AS sources FROM reviewed)"
BARE_SQL = (
    "bare AS (SELECT dated.*, list_reduce(list_concat([dated], (SELECT sources FROM listed)), "
    "lambda text, source: replace(text, source, ' ')) AS nosources FROM dated)"
)


@query(
    "X6 J3",
    f"WITH {REVIEWED_SQL}, {LISTED_SQL}, {BARE_SQL} SELECT doc_id, nosources AS content_nosources FROM bare",
)
def remove_sources(spark, folder):
    dated = corpus(spark, folder).withColumn("content_cleaned", tx.strip_dates(F.col("content")))
    kept = cl.review_sources(cl.extract_sources(dated), rejected(spark, folder))
    bare = cl.remove_sources(dated, cl.number_sources(kept))
    return bare.select("doc_id", "content_nosources")


@query("X7", f"SELECT doc_id, {sql.joined(sql.treebank('text'))} AS tokens FROM documents")
def treebank_tokens(spark, folder):
    return documents(spark, folder).select(
        "doc_id", tx.join_tokens(tx.treebank_tokens(F.col("text"))).alias("tokens")
    )


SCORES_SQL = r"""seen AS (SELECT unnest(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\r\f]+'), lambda t: t <> '')) AS token FROM documents),
    counted AS (SELECT CASE WHEN regexp_matches(token, '^[A-Za-z][A-Za-z.]*$') THEN regexp_replace(lower(token), '[.]$', '') END AS word,
      count(*) FILTER (token LIKE '%.') AS with_period, count(*) FILTER (token NOT LIKE '%.') AS without_period FROM seen GROUP BY word),
    totals AS (SELECT sum(with_period) / sum(with_period + without_period) AS p FROM counted),
    scores AS (SELECT word, with_period, without_period, length(word) - length(replace(word, '.', '')) AS inside, length(replace(word, '.', '')) AS letters,
      2 * (with_period * ln(0.99::DOUBLE / p) + without_period * (ln(1 - 0.99::DOUBLE) - ln(1 - p))) * exp(-letters) * (inside + 1)
        * pow(letters::DOUBLE, -without_period) AS score FROM counted, totals WHERE word IS NOT NULL AND with_period > 0)"""


@query("X7", f"WITH {SCORES_SQL} SELECT word, with_period, without_period, round(score, 6) + 0.0 AS score FROM scores")
def abbreviation_scores(spark, folder):
    """How much each word of the corpus behaves like an abbreviation."""
    return st.abbreviation_scores(documents(spark, folder)).withColumn("score", F.round("score", 6) + 0.0)


@query(
    "X7",
    rf"""WITH {SCORES_SQL},
    placed AS (SELECT doc_id, token, pos, lead(token) OVER (PARTITION BY doc_id ORDER BY pos) AS after FROM (SELECT doc_id, unnest(t) AS token,
      generate_subscripts(t, 1) AS pos FROM (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ 	
]+'), lambda t: t <> '') AS t FROM documents))),
    ends AS (SELECT p.*, regexp_full_match(token, '.*[.!?]["'')\]]*') AND NOT regexp_full_match(token, '[A-Za-z][.]')
      AND NOT (regexp_full_match(token, '[A-Za-z][A-Za-z.]*[.]') AND s.word IS NOT NULL)
      AND coalesce(regexp_matches(after, '^["''(\[]*[A-Z0-9]'), false) AS stops
      FROM placed p LEFT JOIN scores s ON s.score >= 0.3 AND s.word = regexp_replace(lower(token), '[.]$', '')),
    numbered AS (SELECT doc_id, token, pos, coalesce(sum(stops::INT) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n FROM ends)
    SELECT doc_id, CAST(n AS INTEGER) AS n, string_agg(token, ' ' ORDER BY pos) AS sentence FROM numbered GROUP BY doc_id, n""",
)
def split_sentences(spark, folder):
    """Sentences of every document, by abbreviations learned from all of them."""
    docs = documents(spark, folder)
    scores = staged(st.abbreviation_scores(docs), "scores")
    return st.split_sentences(docs, scores).select("doc_id", F.posexplode("sentences").alias("n", "sentence"))


@query("X8", f"SELECT doc_id, {sql.joined(sql.lowered(sql.treebank('text')))} AS tokens FROM documents")
def lower_tokens(spark, folder):
    return documents(spark, folder).select(
        "doc_id", tx.join_tokens(tx.lower_tokens(tx.treebank_tokens(F.col("text")))).alias("tokens")
    )


@query("X9", f"SELECT doc_id, {sql.joined(sql.alphabetic(sql.lowered(sql.treebank('text'))))} AS tokens FROM documents")
def alpha_tokens(spark, folder):
    tokens = tx.alpha_tokens(tx.lower_tokens(tx.treebank_tokens(F.col("text"))))
    return documents(spark, folder).select("doc_id", tx.join_tokens(tokens).alias("tokens"))


@query(
    "X10 X11",
    f"""SELECT doc_id, {sql.joined(sql.no_stop_words(sql.lowered(sql.treebank('text'))))} AS tokens FROM documents""",
)
def drop_stop_words(spark, folder):
    tokens = tx.drop_stop_words(tx.lower_tokens(tx.treebank_tokens(F.col("text"))))
    return documents(spark, folder).select("doc_id", tx.join_tokens(tokens).alias("tokens"))


@query("X12", f"WITH {CORPUS_SQL} SELECT doc_id, {sql.clean('content')} AS cleaned FROM corpus")
def clean_text(spark, folder):
    return corpus(spark, folder).select("doc_id", tx.clean_text(F.col("content")).alias("cleaned"))


@query(
    "X13 X12",
    f"""WITH {REVIEWED_SQL}, {LISTED_SQL}, {BARE_SQL}
    SELECT doc_id, category, {sql.clean('headline')} AS headline_cleaned, nosources AS content_nosources,
      {sql.clean('nosources', True)} AS content_cleaned FROM bare""",
)
def clean_corpus(spark, folder):
    cleaned = cl.clean_corpus(corpus(spark, folder), rejected(spark, folder), font=True)
    return cleaned.select("doc_id", "category", "headline_cleaned", "content_nosources", "content_cleaned")


@query(
    "X13",
    f"""WITH {REVIEWED_SQL}, {LISTED_SQL}, {BARE_SQL}
    SELECT doc_id, {sql.clean('nosources', True)} AS content_cleaned FROM bare""",
)
def reclean_corpus(spark, folder):
    first = cl.clean_corpus(corpus(spark, folder), rejected(spark, folder))
    return cl.reclean(first).select("doc_id", "content_cleaned")


@query(
    "X1 X7 X8 X9 X10 A4 W1",
    f"""WITH {CORPUS_SQL},
    words AS (SELECT category, unnest(string_split({sql.clean('text')}, ' ')) AS term FROM corpus),
    counted AS (SELECT category, term, count(*) AS n FROM words WHERE term <> '' GROUP BY ALL)
    SELECT category, term, n FROM counted
    QUALIFY row_number() OVER (PARTITION BY category ORDER BY n DESC, term) <= 20""",
)
def top_words_by_category(spark, folder):
    """The 20 most frequent cleaned words of each category.

    Counts are final before the ranking, so a window task sees one row per word.
    """
    from pyspark.sql import Window

    words = F.split(tx.clean_text(F.col("text")), " ")
    counted = (
        corpus(spark, folder)
        .select("category", F.explode(words).alias("term"))
        .where("term <> ''")
        .groupBy("category", "term")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.row_number().over(Window.partitionBy("category").orderBy(F.desc("n"), "term"))
    return counted.withColumn("_rank", best).where("_rank <= 20").drop("_rank")


@query(
    "W1",
    f"""WITH words AS (SELECT unnest(string_split({sql.clean('text')}, ' ')) AS term FROM documents)
    SELECT term, count(*) AS n FROM words WHERE term <> '' GROUP BY term ORDER BY n DESC, term LIMIT 100""",
)
def word_cloud_terms(spark, folder):
    words = documents(spark, folder).select(
        F.explode(F.split(tx.clean_text(F.col("text")), " ")).alias("term")
    )
    return top_terms(words.where("term <> ''").groupBy("term").agg(F.count(F.lit(1)).alias("n")), 100)


@query(
    "X14",
    "SELECT doc_id, regexp_replace(strip_accents(text), '[^\\x00-\\x7F]', '', 'g') AS plain FROM documents",
)
def strip_accents(spark, folder):
    return documents(spark, folder).select("doc_id", tx.strip_accents_ascii(F.col("text")).alias("plain"))


@query("X15", f"SELECT doc_id, {sql.joined(sql.words('text'))} AS tokens FROM documents")
def word_tokens(spark, folder):
    return documents(spark, folder).select(
        "doc_id", tx.join_tokens(tx.word_tokens(F.col("text"))).alias("tokens")
    )


@query("X16", f"SELECT doc_id, {sql.joined(sql.words('text', stop=True))} AS tokens FROM documents")
def word_tokens_without_stop_words(spark, folder):
    return documents(spark, folder).select(
        "doc_id", tx.join_tokens(tx.word_tokens(F.col("text"), tx.STOP_WORDS)).alias("tokens")
    )


@query(
    "X17",
    f"""WITH tokens AS (SELECT doc_id, {sql.words('text')} AS t FROM documents),
    grams AS (SELECT doc_id, {sql.ngrams('t')} AS term FROM tokens)
    SELECT doc_id, count(term) AS n_grams, count(DISTINCT term) AS n_distinct, min(term) AS first, max(term) AS last
    FROM documents LEFT JOIN grams USING (doc_id) GROUP BY doc_id""",
)
def word_ngrams(spark, folder):
    grams = documents(spark, folder).select(
        "doc_id", tx.word_ngrams(tx.word_tokens(F.col("text"))).alias("g")
    )
    return grams.select(
        "doc_id",
        F.size("g").cast("bigint").alias("n_grams"),
        F.size(F.array_distinct("g")).cast("bigint").alias("n_distinct"),
        F.array_min("g").alias("first"),
        F.array_max("g").alias("last"),
    )


@query(
    "X18",
    f"""WITH chars AS (SELECT doc_id, {sql.characters('text')} AS c FROM documents),
    grams AS (SELECT doc_id, {sql.char_ngrams('c')} AS term FROM chars)
    SELECT doc_id, count(term) AS n_grams, count(DISTINCT term) AS n_distinct, min(term) AS first, max(term) AS last
    FROM documents LEFT JOIN grams USING (doc_id) GROUP BY doc_id""",
)
def char_ngrams(spark, folder):
    grams = documents(spark, folder).select("doc_id", tx.char_ngrams(F.col("text")).alias("g"))
    return grams.select(
        "doc_id",
        F.size("g").cast("bigint").alias("n_grams"),
        F.size(F.array_distinct("g")).cast("bigint").alias("n_distinct"),
        F.array_min("g").alias("first"),
        F.array_max("g").alias("last"),
    )


@query("X19", f"SELECT doc_id, {sql.joined(sql.wordpunct('text'))} AS tokens FROM documents")
def wordpunct_tokens(spark, folder):
    return documents(spark, folder).select(
        "doc_id", tx.join_tokens(tx.wordpunct_tokens(F.col("text"))).alias("tokens")
    )


@query("X20", f"SELECT doc_id, {sql.joined(sql.sequence('text'))} AS tokens FROM documents")
def sequence_tokens(spark, folder):
    return documents(spark, folder).select(
        "doc_id", tx.join_tokens(tx.sequence_tokens(F.col("text"))).alias("tokens")
    )
