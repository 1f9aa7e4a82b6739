import unicodedata

import pytest
from pyspark.sql import functions as F

from presswork.functions import text as tx
from presswork.operators import cleaning as cl


def apply(spark, value, fn):
    return spark.createDataFrame([(value,)], "t string").select(fn(F.col("t"))).first()[0]


@pytest.mark.parametrize(
    "fn, text, expected",
    [
        (tx.strip_markup, "a (b) c (d) e", "a  e"),
        (tx.strip_markup, "a (b\nc) d", "a (b\nc) d"),
        (tx.strip_markup, "(a\r b) c", " c"),
        (tx.strip_markup, "x &lt;b", "x ;b"),
        (tx.strip_font, "a FONT x /FONT b", "a  b"),
        (tx.strip_dates, "Marketing", " keting"),
        (tx.strip_dates, "on 12 May 2004, it", "on it"),
        (tx.dateline, "NEW YORK (Reuters) - Stocks", "NEW YORK (Reuters) -"),
        (tx.dateline, "no source here", ""),
        (tx.clean_text, "well-known U.S. firm", "firm"),
        (tx.clean_text, None, ""),
        (tx.clean_text, "The Profits of AP fell. Don't (Reuters) sell!", "profits ap fell sell"),
        (tx.treebank_tokens, "Don't it's. cannot", ["Do", "n't", "it", "'s", ".", "can", "not"]),
        (tx.treebank_tokens, "1,000 a,b", ["1,000", "a", ",", "b"]),
        (tx.treebank_tokens, "Mr. Fox ran home.", ["Mr.", "Fox", "ran", "home", "."]),
        (tx.word_tokens, "Étion aé naïve don", ["don"]),
        (tx.word_tokens, "Ab_c de f gh1 ij", ["de", "ij"]),
        (lambda c: tx.word_ngrams(F.split(c, " "), 2, 3), "a", []),
        (lambda c: tx.word_ngrams(F.split(c, " "), 2, 3), "a b c", ["a b", "b c", "a b c"]),
        (tx.char_ngrams, "Ab  c", ["ab", "b ", " c", "ab ", "b c"]),
        (tx.char_ngrams, "x😀y", ["x😀", "😀y", "x😀y"]),
        (tx.wordpunct_tokens, "can't stop...now", ["can", "'", "t", "stop", "...", "now"]),
        (tx.sequence_tokens, "A-b, c!\td", ["a", "b", "c", "d"]),
    ],
)
def test_text_functions(spark, fn, text, expected):
    assert apply(spark, text, fn) == expected


def test_clean_text_equals_its_steps(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    steps = tx.join_tokens(
        tx.drop_stop_words(tx.alpha_tokens(tx.lower_tokens(tx.treebank_tokens(tx.strip_markup(F.col("text"))))))
    )
    assert docs.where(steps != tx.clean_text(F.col("text"))).count() == 0


@pytest.mark.parametrize("text", ["Crème brûlée naïve", "ﬁn ½ № ㎏ ﷺ", "Łódź ß œ Ω 日本", "𝔘nicode 𝟙", ""])
def test_strip_accents_is_compatibility_decomposition(spark, text):
    plain = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()
    assert apply(spark, text, tx.strip_accents_ascii) == plain


def test_context_windows(spark):
    df = spark.createDataFrame([([1, 2, 3, 4],)], "ids array<bigint>")
    rows = df.select(F.inline(tx.context_windows(F.col("ids"), 2))).collect()
    assert [(r.context, r.target) for r in rows] == [
        ([0, 0, 2, 3], 1),
        ([0, 1, 3, 4], 2),
        ([0, 1, 2, 4], 3),
        ([0, 0, 2, 3], 4),
    ]


@pytest.mark.parametrize("per_step", [1, 2, 100])
def test_remove_sources_in_list_order_and_in_steps(spark, per_step):
    docs = spark.createDataFrame([(1, "AP - X AP"), (2, None)], "doc_id int, content_cleaned string")
    sources = spark.createDataFrame([(1, "AP -"), (2, "AP"), (3, "Z")], "seq bigint, source string")
    rows = cl.remove_sources(docs, sources, per_step=per_step).orderBy("doc_id").collect()
    assert [r.content_nosources for r in rows] == ["  X  ", ""]


def test_clean_corpus(spark):
    docs = spark.createDataFrame(
        [(1, 1, "Oil &amp; Gas", "NEW YORK (Reuters) - Oil prices rose on 3 March 2004, said Reuters")],
        "doc_id int, category int, headline string, content string",
    )
    row = cl.clean_corpus(docs).first()
    assert row.headline_cleaned == "oil gas"
    assert row.content_cleaned == "oil prices rose said reuters"


def test_streaming_table_takes_the_same_functions(spark, tmp_path):
    from presswork.streaming.cleaning import clean_stream

    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(1, "The firm (AP) grew")], "doc_id bigint, content string").write.parquet(source)
    clean_stream(spark, source, target, "doc_id bigint, content string", str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(target).first().content_cleaned == "firm grew"
