"""The language model: counts against brute force, one mass over all tokens, better on held-out texts."""

import collections
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from presswork.llm import maxent_lm as lm
from presswork.llm.shared import remainder

FOLDER = "/root/testdata/sf0.01"


def split(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def brute(rows, learn):
    counts = collections.Counter(t for key, text in rows if learn(key) for t in split(text))
    n, v = sum(counts.values()), len(counts)
    return {
        key: (len(w := split(text)), sum(counts[t] > 0 for t in w), n, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in w))
        for key, text in rows
    }


@pytest.fixture(scope="module")
def fitted(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return docs, *lm.train(docs, remainder("doc_id", 7) != 2)


@pytest.mark.parametrize("common", [lm.COMMON, 50])
def test_counts_and_base_against_brute_force(spark, common):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    table = lm.count_tokens(docs, remainder("doc_id", 7) != 2, "text")
    model = lm.initial(lm.common_counts(table, common), least=20)
    got = {r.doc_id: r for r in lm.score(docs, model, table).collect()}
    expected = brute([(r.doc_id, r.text) for r in docs.collect()], lambda key: zlib.crc32(str(key).encode()) % 7 != 2)
    assert set(got) == set(expected)
    for key, (n_tokens, n_known, n, base) in expected.items():
        r = got[key]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n_tokens, n_known, n)
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base))


def keyed(*words):
    return np.array([lm.word_key(w) for w in words], np.uint64)


def test_probabilities_sum_to_one(fitted):
    _, model, _ = fitted
    assert len(model.words) > 5_000 and np.abs(model.weights).max() > 1
    every = np.arange(model.other + 1)
    for two, one in (keyed("the", "of"), keyed("never-met", "the"), np.ones(2, np.uint64)):
        p = np.exp(lm.log_prob(model, np.full(len(every), two), np.full(len(every), one), every))
        assert abs(p.sum() - 1) < 1e-4


def test_tree_of_classes_is_that_of_least_depth():
    rng = np.random.default_rng(1)
    for n in (2, 3, 4, 5, 16, 17, 18, 40):
        counts = rng.integers(1, 50, n)
        parent, place, shares = lm.class_tree(counts, 3)
        root, depth = len(shares) - 1, []
        for leaf in range(n):
            at, up, p = leaf, 0, 0.0
            while True:
                p += shares[parent[at], place[at]]
                up += 1
                if parent[at] == root:
                    break
                at = n + parent[at]
            depth.append(up)
            assert math.exp(p) == pytest.approx(counts[leaf] / counts.sum(), rel=1e-4)
        queue = sorted(counts.tolist() + [0] * ((1 - n) % 2))
        cost = 0
        while len(queue) > 1:
            some, queue = sum(queue[:3]), queue[3:]
            cost, queue = cost + some, sorted([*queue, some])
        assert (np.array(depth) * counts).sum() == cost


def slow_log_prob(model, two, one, key):
    """One token's log10 probability by the formula, with plain loops."""
    at = {int(k): int(leaf) for k, leaf in zip(model.words, model.leaf)}.get(int(key), model.other)
    log, root, first = 0.0, len(model.shares) - 1, len(model.words) + 1
    while True:
        above = int(model.parent[at])
        rows = lm.features(*(np.array([v], np.uint64) for v in (one, two)), np.array([above]), len(model.weights))
        x = [float(model.shares[above, j]) + sum(float(model.weights[r[0], j]) for r in rows) for j in range(lm.BRANCHES)]
        log += x[int(model.place[at])] - math.log(sum(math.exp(v) for v in x))
        if above == root:
            return log / math.log(10)
        at = above + first


def test_scores_against_plain_loops(fitted):
    docs, model, table = fitted
    some = [r for r in docs.orderBy("doc_id").limit(40).collect() if len(r.text or "") < 4000][:12]
    counts = {r.key: r.n for r in table.collect()}
    as_long = lambda k: int(np.uint64(k).astype(np.int64))
    got = {r.doc_id: r.score for r in lm.score(docs.where(F.col("doc_id").isin([r.doc_id for r in some])), model, table).collect()}
    for r in some:
        keys = [lm.word_key(w) if w is not None else int(lm.END) for w in split(r.text)]
        total, two, one = 0.0, 1, 1
        for k in keys:
            total += slow_log_prob(model, two, one, k)
            if int(k) not in set(model.words.tolist()):
                total += math.log10((counts.get(as_long(k), 0) + 1) / model.other_mass)
            two, one = one, k
        assert got[r.doc_id] == pytest.approx(total, rel=1e-4)


def test_observed_less_expected_is_the_gradient(fitted):
    _, model, _ = fitted
    rng = np.random.default_rng(0)
    keys = rng.choice(model.words, 300)
    bounds = np.array([0, 120, 300])
    sums = np.zeros(2 * model.weights.size, np.float32)
    lm.observe(model, keys, bounds, sums)
    sums = sums.reshape(-1, 2, lm.BRANCHES)
    assert sums[:, 0].sum() == pytest.approx(sums[:, 1].sum(), rel=1e-4)
    grad = sums[:, 0] - sums[:, 1]
    likelihood = lambda: lm.log_prob(model, lm.before(keys, bounds, 2), lm.before(keys, bounds, 1), model.leaves_of(keys)).sum()
    for at in [np.unravel_index(i, grad.shape) for i in np.argsort(-np.abs(grad), axis=None)[:6]]:
        held = model.weights[at]
        model.weights[at] = held + 0.02
        up = likelihood()
        model.weights[at] = held - 0.02
        down = likelihood()
        model.weights[at] = held
        assert abs((up - down) / 0.04 - grad[at]) < 0.02 * abs(grad[at]) + 0.05


def test_sixteen_bits_keep_three_digits():
    x = np.array([0.0, 1.0, 3.14159, 1e6, 1e-6], np.float32)
    assert np.allclose(lm.unpacked(lm.packed(x)), x, rtol=4e-3)


def test_rounds_cover_every_document_once(spark, fitted, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    table = lm.count_tokens(docs, F.lit(True), "text")
    start = lm.initial(lm.common_counts(table))
    seen = []
    monkeypatch.setattr(lm, "moved", lambda observed, expected: seen.append(observed.sum()) or np.zeros(observed.shape, np.float32))
    lm.improve(start, docs, "text", 3)
    depth = np.bincount(start.way(start.leaves_of(start.counts.keys))[0], minlength=len(start.counts.keys))
    assert sum(seen) == pytest.approx(3 * (depth * start.counts.counts).sum(), rel=5e-3)


def test_held_out_texts_are_likelier_than_under_the_base(fitted):
    docs, model, table = fitted
    scored = lm.score(docs.withColumn("held_out", remainder("doc_id", 7) == 2), model, table)
    got = scored.where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.sum("n_tokens").alias("n")).first()
    assert got.s / got.n > got.b / got.n + 0.1


def test_odd_rows(spark):
    rows = [(1, "A b c", 1), (2, None, 2), (3, " \n", None), (None, "a b", 3), (1, "A b c", 1), (5, "a " * 50_000 + "zz", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    model, table = lm.train(docs, F.coalesce(F.col("doc_id"), F.lit(0)) != 3)
    got = lm.score(docs, model, table).collect()
    expected = brute([(i, r[1]) for i, r in enumerate(rows)], lambda i: i != 2)
    assert sorted((r.n_tokens, r.n_known, r.train_tokens) for r in got) == sorted(e[:3] for e in expected.values())
    assert np.allclose(sorted(r.base_score for r in got), sorted(e[3] for e in expected.values()))
    assert all(r.score <= 0 for r in got)
    model, table = lm.train(docs.where("false"), F.lit(True))
    got = lm.score(docs, model, table).collect()
    assert len(got) == 6 and all(r.n_known == 0 and r.train_tokens == 0 and r.base_score == 0 for r in got)
    with pytest.raises(ValueError):
        lm.score(docs.withColumnRenamed("n", "Score"), model, table)
