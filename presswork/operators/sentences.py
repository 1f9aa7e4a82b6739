"""Sentences of texts, with abbreviations learned from the corpus.

An abbreviation is a word that hardly occurs without a final period: its score (Kiss and Strunk, 2006)
is a log-likelihood ratio of word and period, lowered for long words and for each occurrence without
one. A text ends a sentence after ! or ?, or after a period that ends neither an abbreviation nor an
initial, if the next word opens with a capital or a digit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.plans import lookup_join, staged

# The published thresholds and the share of periods an abbreviation is taken to have.
LEAST_SCORE = 0.3
ABBREVIATED = 0.99
# letters with inner periods, and perhaps a final one
WORD = r"^[A-Za-z][A-Za-z.]*$"
STOP = r"^.*[.!?][\"')\]]*$"
PERIOD = r"^[A-Za-z][A-Za-z.]*[.]$"
INITIAL = r"^[A-Za-z][.]$"
OPENING = r"^[\"'(\[]*[A-Z0-9].*$"
MARK = "\u0001"


def tokens_of(text: Column) -> Column:
    """The runs without white space of a text; none of a null or empty one."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[ \t\n\r\f]+"), lambda t: t != "")


def type_of(token: Column) -> Column:
    """The word in small letters without one final period."""
    return F.regexp_replace(F.lower(token), r"[.]$", "")


def abbreviation_scores(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, with_period, without_period, score) of every word met with a final period.

    One aggregation by word with partial counts, and the corpus' two totals in one row.
    """
    seen = docs.select(F.explode(tokens_of(F.col(text))).alias("token"))
    ends = F.col("token").endswith(".")
    words = F.when(F.col("token").rlike(WORD), type_of(F.col("token")))
    counted = staged(seen.groupBy(words.alias("word")).agg(F.count_if(ends).alias("with_period"), F.count_if(~ends).alias("without_period")), "words")
    totals = counted.agg(F.sum(F.col("with_period") + F.col("without_period")).alias("n"), F.sum("with_period").alias("periods"))
    both, a = F.col("with_period"), F.col("with_period") + F.col("without_period")
    p = F.col("periods") / F.col("n")
    ratio = 2 * (both * F.ln(ABBREVIATED / p) + F.col("without_period") * (F.ln(F.lit(1 - ABBREVIATED)) - F.ln(1 - p)))
    inner = F.length(F.regexp_replace("word", "[^.]", ""))
    length = F.length("word") - inner
    score = ratio * F.exp(-length) * (inner + 1) * F.pow(length.cast("double"), -F.col("without_period"))
    # one row of totals; where every word has a period the ratio says nothing
    scored = counted.where("word IS NOT NULL AND with_period > 0").join(F.broadcast(totals), how="cross")
    return scored.select("word", "with_period", "without_period", F.when(p < 1, score).otherwise(0.0).alias("score"))


def split_sentences(docs: DataFrame, scores: DataFrame, key: str = "doc_id", text: str = "text", least: float = LEAST_SCORE) -> DataFrame:
    """(key, sentences): the sentences of every text in order, words parted by single blanks.

    ``scores`` is staged (word, with_period, score). A text's candidates are looked up in it, so the list of
    abbreviations may be of any length. A null or empty text has none; repeated keys keep their rows.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), tokens_of(F.col(text)).alias("tokens"))
    rows = staged(rows, "tokens")
    ending = F.array_distinct(F.transform(F.filter("tokens", lambda t: t.rlike(PERIOD)), type_of))
    asked = rows.select("row", F.explode(ending).alias("word"))
    known = staged(scores.where(F.col("score") >= least).select("word", "with_period"), "abbreviations")
    short = lookup_join(asked, known, "word", weight="with_period").groupBy("row").agg(F.collect_list("word").alias("short"))
    placed = rows.join(short, "row", "left").withColumn("short", F.coalesce("short", F.array().cast("array<string>")))

    def marked(token: Column, i: Column) -> Column:
        after = F.get(F.col("tokens"), i + 1)
        abbreviated = token.rlike(INITIAL) | (token.rlike(PERIOD) & F.array_contains("short", type_of(token)))
        ends = token.rlike(STOP) & ~abbreviated & F.coalesce(after.rlike(OPENING), F.lit(False))
        return F.when(ends, F.concat(token, F.lit(MARK))).otherwise(token)

    joined = F.array_join(F.transform("tokens", marked), " ")
    return placed.select(F.col("key").alias(key), F.filter(F.split(joined, f"{MARK} "), lambda s: s != "").alias("sentences"))
