"""BagMinHash: registers against the exact similarity, classes against brute force over all pairs."""

import collections
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from presswork.llm import minhash
from presswork.llm.components import components

FOLDER = "/root/testdata/sf0.001"


def bag(text):
    words = "".join(c.lower() if c < "\x80" else c for c in text or "").split()
    return collections.Counter(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, min(1, len(words)))))


def overlap(a, b):
    shared = sum((a & b).values())
    return shared, sum(a.values()) + sum(b.values()) - shared


def brute_classes(rows):
    """{id: smallest id of its class}, from all pairs."""
    bags = {i: bag(t) for i, t in rows}
    head = {i: i for i in bags}

    def find(i):
        while head[i] != i:
            i = head[i]
        return i

    ids = sorted(bags)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            shared, whole = overlap(bags[a], bags[b])
            if shared and 5 * shared >= 4 * whole:
                low, high = sorted((find(a), find(b)))
                head[high] = low
    return {i: find(i) for i in ids}


def test_registers_agree_as_often_as_the_multisets_overlap():
    rng = random.Random(3)
    for repeats in (1, 2, 5, 40):
        common = [f"w{rng.randrange(10**6)}" for _ in range(60)]
        a = common * repeats + [f"x{i}" for i in range(60)]
        b = common * (repeats + 1)
        column = pa.array([" ".join(a), " ".join(b)])
        keys, bounds = minhash.shingles(column, 1)
        made = minhash.signatures(*minhash.counted(keys, bounds), 2, 4000)
        ca, cb = collections.Counter(a), collections.Counter(b)
        expected = sum((ca & cb).values()) / sum((ca | cb).values())
        assert abs((made[0] == made[1]).mean() - expected) < 0.035


def test_signature_does_not_depend_on_neighbours():
    texts = [" ".join(f"w{(i * j) % 97}" for i in range(50)) for j in range(1, 9)]
    keys, bounds = minhash.shingles(pa.array(texts))
    whole = minhash.signatures(*minhash.counted(keys, bounds), 8, 130)
    for j, text in enumerate(texts):
        keys, bounds = minhash.shingles(pa.array([text]))
        assert np.array_equal(minhash.signatures(*minhash.counted(keys, bounds), 1, 130)[0], whole[j])


def test_documents_against_all_pairs(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = {r.doc_id: r for r in minhash.near_duplicates(docs).collect()}
    expected = brute_classes([(r.doc_id, r.text) for r in docs.collect()])
    assert {i: r.class_id for i, r in got.items()} == expected
    sizes = collections.Counter(expected.values())
    assert all(r.class_size == sizes[r.class_id] and r.kept == (r.class_id == i) for i, r in got.items())


def test_group_of_near_copies_and_chains(spark):
    """Copies that differ from each other, a chain whose ends are unlike, and one odd document."""
    rng = random.Random(7)
    base = [f"w{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 60):
        words = list(base)
        for _ in range(rng.choice((1, 2, 3, 4, 6))):
            words[rng.randrange(120)] = f"e{rng.randrange(9999)}"
        rows.append((i, " ".join(words)))
    chain = [f"c{i}" for i in range(100)]
    for i in range(12):
        rows.append((100 + i, " ".join(chain[i * 4 :] + [f"d{j}" for j in range(i * 4)])))
    rows.append((200, "nothing of the kind is said in this one here"))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.class_id for r in got.collect()} == brute_classes(rows)


def test_defined_results_for_odd_rows(spark):
    long_text = " ".join(f"t{i % 5000}" for i in range(60_000))
    rows = [
        (1, None, "x"), (2, "", "x"), (3, "  \n", "x"), (4, "one two", "x"), (5, "One two", None), (6, "one two three", "x"),
        (7, long_text, "x"), (8, long_text + " end", "x"), (9, "a b c d e f", "x"), (9, "a b c d e f", "x"), (None, "one two", "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bands string").withColumn("row", F.lit(1))
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[i].class_id for i in (1, 2, 3, 4, 5, 6, 7, 8)] == [1, 2, 3, 4, 4, 6, 7, 7]
    assert by[None].class_id == 4 and not by[None].kept and by[4].class_size == 3
    assert sorted(r.kept for r in got if r.doc_id == 9) == [False, True]
    left = minhash.drop_near_duplicates(docs.where("doc_id < 9"))
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 2, 3, 4, 6, 7]
    assert minhash.near_duplicates(docs.where("false")).count() == 0


def test_one_row_of_each_class_stays(spark):
    base = " ".join(f"w{i}" for i in range(100))
    rows = [
        (1, "a b c d e f", "x"), (1, "a b c d e f", "y"), (2, base, "x"), (2, base + " end", "x"), (3, base, "x"), (None, base, "x"),
        (3, "kept beside a dropped one", "x"), (None, "g h i j k l", "x"), (None, "g h i j k l", "x"), (4, None, "x"), (4, "", "x"), (4, "", "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, print string")
    left = minhash.drop_near_duplicates(docs)
    got = [tuple(r) for r in left.collect()]
    assert left.columns == docs.columns and set(got) <= set(rows)
    heads = [r for r in got if (r[1] or "").startswith("w0 ")]
    assert len(heads) == 1 and heads[0][0] == 2
    others = sorted(((r[1] or "", str(r[0])) for r in got if r not in heads))
    assert others == sorted([("a b c d e f", "1"), ("kept beside a dropped one", "3"), ("g h i j k l", "None"), *[("", "4")] * 3])


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 105), (105, 103)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 105: 100, 103: 100}
