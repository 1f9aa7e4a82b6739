"""The classifier: pooling and gradients against plain loops, accuracy on rows it never saw."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from presswork.llm import toxicity as tox
from presswork.llm.shared import remainder


def small_model(seed=0):
    rng = np.random.default_rng(seed)
    return tox.Model(
        rng.normal(0, 1, (tox.BUCKETS, tox.DIMENSIONS)), rng.normal(0, 1, (tox.BUCKETS, tox.DIMENSIONS)),
        [rng.normal(0, 1, (w, tox.DIMENSIONS, tox.FILTERS)) for w in tox.WIDTHS],
        [rng.normal(0, 1, tox.FILTERS) for _ in tox.WIDTHS], rng.normal(0, 1, tox.FILTERS * len(tox.WIDTHS)), 0.3,
    )


def plain_score(model, whole, begin):
    x = [model.word[a] + model.begin[b] for a, b in zip(whole, begin, strict=True)]
    hidden = []
    for w, width in enumerate(tox.WIDTHS):
        made = [sum(x[t + j] @ model.filters[w][j] for j in range(width) if t + j < len(x)) for t in range(len(x))]
        hidden.append(np.maximum(np.max(made, axis=0) + model.bias[w], 0) if made else np.zeros(tox.FILTERS))
    return float(tox.sigmoid(np.concatenate(hidden) @ model.out + model.const))


TEXTS = ["", "one", "two words", "a, b! c-d e", "the same the same the same", "x " * 50, "  "]


def test_table_scores_equal_plain_convolution():
    model = small_model()
    whole, begin, rows = tox.buckets(pa.array(TEXTS))
    raw = model.table().raw(whole, begin, rows)
    for i in range(len(TEXTS)):
        part = slice(rows[i], rows[i + 1])
        assert abs(raw[i] - plain_score(model, whole[part], begin[part])) < 1e-4


def test_training_lowers_the_loss_and_finds_the_word():
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(300)]
    texts, labels = [], []
    for i in range(400):
        text = [words[rng.integers(300)] for _ in range(40)]
        labels.append(int(i % 4 == 0))
        if labels[-1]:
            text[rng.integers(40)] = "vilest" if i % 8 else "vileness"
        texts.append(" ".join(text))
    whole, begin, rows = tox.buckets(pa.array(texts))
    parts = [(whole[a:b], begin[a:b]) for a, b in zip(rows[:-1], rows[1:], strict=True)]
    hold = np.arange(400) % 5 == 0
    model = tox.fit(parts, np.array(labels), ["en"] * 400, hold)
    values, _ = model.table().score(*tox.buckets(pa.array(["w1 w2 vilely w3 w4", "w1 w2 w3 w4 w5", ""])))
    assert values[0] >= tox.CUT > values[1] and values[2] < tox.CUT


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = tox.train(docs, labels, remainder("doc_id", 3) != 1)
    held = docs.join(labels, "doc_id").where(remainder("doc_id", 3) == 1).select("doc_id", "text", "toxic")
    got = tox.score(held, model).toPandas()
    hits = ((got.predicted == 1) & (got.toxic == 1)).sum()
    assert hits / (got.toxic == 1).sum() > 0.85 and hits / (got.predicted == 1).sum() > 0.85
    assert ((got.score >= tox.CUT) == (got.predicted == 1)).all() and got.score.between(0, 1).all()


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "good words here", "en"), (2, None, None), (3, "", "fr"), (None, "bad idiot", "en"), (1, "good words here", "en"), (4, "idiot " * 40_000, "en")],
        "doc_id long, text string, lang string",
    )
    labels = spark.createDataFrame([(1, 0), (1, 0), (4, 1), (3, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    model = tox.train(docs, labels, F.lit(True))
    got = tox.score(docs.withColumn("scores", F.lit(1)), model).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (2, 3)}) == 1
    empty = tox.train(docs.where("false"), labels, F.lit(True))
    assert [0 <= r.score < tox.CUT for r in tox.score(docs, empty).collect()] == [True] * 6


def test_one_long_text_does_not_empty_the_sample(spark):
    docs = spark.range(60).select(
        F.concat(F.lit("k"), "id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "vilest words of all").otherwise("plain words of all").alias("text"), F.lit("en").alias("lang")
    )
    first = docs.orderBy(F.xxhash64("doc_id")).first().doc_id
    docs = docs.withColumn("text", F.when(F.col("doc_id") == first, F.repeat(F.lit("long "), 4000)).otherwise(F.col("text")))
    labels = docs.select("doc_id", F.col("text").startswith("vil").cast("int").alias("toxic"))
    model = tox.train(docs, labels, F.lit(True), sample_words=1000)
    scores = {r.text: r.score for r in tox.score(docs, model).collect()}
    assert scores["vilest words of all"] > scores["plain words of all"] + 0.2


def test_rows_that_fit():
    rows = [type("Row", (), {"row": i, "n": n}) for i, n in enumerate([5, 20, 3, 2, 1])]
    assert tox.within(rows, 10) == [0, 2, 3]


def worded(rows):
    """(documents, labels) rows of (text, toxic), with keys in the order of their hash."""
    docs = rows.select(F.col("id").alias("doc_id"), "text", F.lit("en").alias("lang"))
    return docs, rows.select(F.col("id").alias("doc_id"), "toxic")


def test_rows_past_the_first_twelve_thousand_teach(spark):
    ids = spark.range(16_000).orderBy(F.xxhash64("id"), "id").toPandas().reset_index(names="place")
    rows = spark.createDataFrame(ids).withColumn("toxic", (F.col("place") % 4 == 0).cast("int"))
    plain = F.concat_ws(" ", *[F.concat(F.lit("w"), F.pmod(F.xxhash64("id", F.lit(i)), F.lit(200))) for i in range(6)])
    bad = F.when(F.col("place") < 12_000, "awful").otherwise("vilest")
    rows = rows.withColumn("text", F.when(F.col("toxic") == 1, F.concat_ws(" ", plain, bad)).otherwise(plain))
    model = tox.train(*worded(rows), F.lit(True))
    asked = spark.createDataFrame([("vilest", "w1 w2 vilest w3 w4 w5"), ("awful", "w1 w2 awful w3 w4 w5"), ("plain", "w1 w2 w3 w4 w5")], "doc_id string, text string")
    got = {r.doc_id: r.score for r in tox.score(asked, model).collect()}
    assert got["vilest"] >= tox.CUT and got["awful"] >= tox.CUT > got["plain"]


def some_rows(spark, n):
    rows = spark.range(n).withColumn("toxic", (F.col("id") % 3 == 0).cast("int"))
    word = F.when(F.pmod(F.xxhash64("id"), F.lit(10)) == 0, "odd").when(F.col("toxic") == 1, "vilest").otherwise("plain")
    return rows.withColumn("text", F.concat_ws(" ", F.concat(F.lit("w"), F.col("id") % 40), word, F.concat(F.lit("w"), F.col("id") % 7)))


def test_one_shard_equals_training_at_hand(spark):
    rows = some_rows(spark, 300)
    model = tox.train(*worded(rows), F.lit(True))
    parts = rows.withColumn("hold", F.pmod(F.xxhash64("id"), F.lit(5)) == 0).toPandas()
    whole, begin, bounds = (x.astype(np.int64) for x in tox.buckets(pa.array(parts.text)))
    parts["whole"], parts["begin"] = ([x[a:b].astype(tox.STORED) for a, b in zip(bounds[:-1], bounds[1:], strict=True)] for x in (whole, begin))
    place = spark.createDataFrame(
        [(i, w.size, w.tobytes(), b.tobytes()) for i, w, b in zip(parts.id.tolist(), parts.whole, parts.begin, strict=True)], "key long, n long, whole binary, begin binary"
    ).select("key", F.xxhash64("key", "n", "whole", "begin").alias("place"))
    parts = parts.merge(place.toPandas(), left_on="id", right_on="key").sort_values("place")
    texts = list(zip(parts.whole, parts.begin, strict=True))
    plain = tox.fit(texts, parts.toxic.to_numpy(), ["en"] * 300, parts.hold.to_numpy())
    assert np.allclose(model.out, plain.out) and np.allclose(model.word, plain.word) and np.allclose(model.prior, plain.prior)
    assert all(np.allclose(a, b) for a, b in zip(model.filters + model.bias, plain.filters + plain.bias, strict=True))
    assert np.allclose(model.word_given_language, plain.word_given_language)
    assert np.allclose(model.thresholds, plain.thresholds) and abs(model.threshold - plain.threshold) < 1e-9


def test_shards_learn_together_and_again_the_same(spark, monkeypatch):
    monkeypatch.setattr(tox, "SHARD_ROWS", 100)
    rows = some_rows(spark, 900)
    model, again = (tox.train(*worded(rows.repartition(n)), F.lit(True)) for n in (3, 5))
    assert np.allclose(model.word, again.word) and np.allclose(model.out, again.out) and model.threshold == again.threshold
    asked = spark.createDataFrame([("w1 vilest w2", 1), ("w1 plain w2", 0)], "text string, toxic int")
    assert all(r.predicted == r.toxic for r in tox.score(asked, model).collect())


def test_thresholds_over_a_table_equal_those_at_hand(spark):
    rng = np.random.default_rng(5)
    raw, language = np.round(rng.random(500), 2), rng.integers(0, 3, 500)
    hit = (rng.random(500) < raw) & (language != 2)
    scored = spark.createDataFrame([(int(a), float(b), int(c)) for a, b, c in zip(language, raw, hit, strict=True)], "language int, raw double, hit long")
    got = {r.language: r for r in tox._best_thresholds(scored)}
    for which, mine in ((-1, language >= 0), (0, language == 0), (1, language == 1)):
        assert abs(got[which].at - tox._best_threshold(raw[mine], hit[mine])) < 1e-12
        assert (got[which].hits, got[which].cases) == (hit[mine].sum(), mine.sum())
    assert got[2].hits == 0 and got[2].at is None
