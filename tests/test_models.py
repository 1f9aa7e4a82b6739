import numpy as np
import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from presswork.catalog import registry
from presswork.operators import bayes as nb
from presswork.operators import ensembles as en
from presswork.operators import explain as ex
from presswork.operators import metrics as mt
from presswork.operators import models as md
from presswork.operators import sampling as sm
from presswork.operators import validation as va
from presswork.operators import vectors as vc

CLASSES = [1, 2, 3]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    data = []
    for d in range(240):
        c = d % 3
        x = rng.normal(size=5) + 2.5 * np.eye(3, 5)[c]
        data.append((d, c + 1, [float(v) for v in x]))
    df = spark.createDataFrame(data, "doc_id bigint, category int, vec array<double>")
    df = df.withColumn("features", array_to_vector("vec"))
    return sm.assign_folds(df, 5).persist()


def test_gaussian_nb_equals_the_built_in_one(spark):
    emb = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    df = emb.select(F.col("vec_id").alias("doc_id"), F.col("label").alias("category"), F.col("embedding").cast("array<double>").alias("vec"))
    mine = nb.score_gaussian_nb(df, nb.fit_gaussian_nb(df, [3]), [3])
    labelled = df.select("doc_id", (F.col("category") == 3).cast("double").alias("label"), array_to_vector("vec").alias("features"))
    theirs = NaiveBayes(modelType="gaussian").fit(labelled).transform(labelled)
    theirs = theirs.select("doc_id", vector_to_array("probability")[1].alias("p"))
    worst = mine.join(theirs, "doc_id").agg(F.max(F.abs(F.col("score") - F.col("p")))).first()[0]
    assert worst < 1e-6


def test_vectors_of_unknown_words_are_zero(spark):
    docs = spark.createDataFrame([(1, ["a", "a", "b"]), (2, ["zzz"]), (3, [])], "doc_id bigint, t array<string>")
    words = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [4.0, 3.0])], "word string, vector array<double>")
    got = {r.doc_id: r.vec for r in vc.doc_embeddings(docs, F.col("t"), words).collect()}
    assert got == {1: [2.0, 1.0], 2: [0.0, 0.0], 3: [0.0, 0.0]}


def _word_rows(spark):
    """Documents with repeated keys, texts of no known word, and words of zero to many documents; one word has two vectors."""
    rng = np.random.default_rng(3)
    names = [f"w{i}" for i in range(40)] + ["zzz"]
    texts = [(d % 55, [names[int(i)] for i in np.minimum(rng.geometric(0.12, 1 + d % 30) - 1, 40)]) for d in range(60)]
    texts += [(100, []), (101, None), (102, ["zzz", "zzz"]), (103, ["w3", None, "w3"])]
    vectors = [(w, [float(x) for x in rng.normal(size=4)]) for w in [*names[:40], "w2"]]
    docs = spark.createDataFrame(texts, "doc_id bigint, t array<string>").repartition(3)
    return docs, spark.createDataFrame(vectors, "word string, vector array<float>")


def _plain_means(docs, vectors):
    known, words = {}, {}
    for r in vectors.collect():
        known.setdefault(r.word, []).append(np.array(r.vector))
    for r in docs.collect():
        words.setdefault(r.doc_id, []).extend(v for w in r.t or [] for v in known.get(w, []))
    return {d: np.mean(v, axis=0) if v else np.zeros(4) for d, v in words.items()}


@pytest.mark.parametrize("size", [4 << 20, 32 * 12, 1], ids=["all common", "some rare", "all rare"])
def test_document_vectors_equal_plain_means(spark, monkeypatch, size):
    monkeypatch.setattr(vc, "VECTOR_BYTES", size)
    monkeypatch.setattr(vc, "ADDED_AT_ONCE", 7)
    docs, vectors = _word_rows(spark)
    got = vc.doc_embeddings(docs, F.col("t"), vectors).collect()
    want = _plain_means(docs, vectors)
    assert len(got) == docs.count()
    assert all(np.allclose(r.vec, want[r.doc_id], atol=1e-12) for r in got)


def test_words_of_most_documents_are_added_up_where_the_texts_lie(spark):
    docs, vectors = _word_rows(spark)
    plan = vc.doc_embeddings(docs, F.col("t"), vectors)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan  # no row for each word of a document


@pytest.mark.parametrize(
    "fitter",
    [
        va.gaussian_fitter(),
        va.estimator_fitter(md.linear_svm),
        va.estimator_fitter(md.logistic),
        va.estimator_fitter(md.decision_tree),
        en.bagging_fitter(3),
        en.adaboost_fitter(10),
        en.stacking_fitter({"nb": va.gaussian_fitter(), "svm": va.estimator_fitter(md.linear_svm)}, folds=3),
    ],
    ids=["nb", "svm", "logistic", "tree", "bagging", "adaboost", "stacking"],
)
def test_every_model_beats_the_majority(rows, fitter):
    train, test = rows.where("fold > 0"), rows.where("fold = 0")
    scored = fitter(train, CLASSES)(test)
    assert scored.count() == test.count() * 3
    assert scored.agg(F.sum("y")).first()[0] == test.count()
    assert mt.micro_metrics(scored).first().f1 > 0.75


def test_boosting_weights_follow_the_misses(rows):
    stumps = [(0, 0.5, 1, 0.8), (2, -0.1, -1, 0.4)]
    got = rows.select("vec", en._stump_votes(stumps).alias("v")).collect()
    for r in got:
        expected = 0.8 * (1 if r.vec[0] <= 0.5 else -1) - 0.4 * (1 if r.vec[2] <= -0.1 else -1)
        assert r.v == pytest.approx(expected)


def test_bootstrap_weights_look_like_poisson(spark):
    df = spark.range(20000).select(en.bootstrap_weight(F.col("id"), 1).alias("w"))
    row = df.agg(F.avg("w").alias("m"), F.var_pop("w").alias("v"), F.avg((F.col("w") == 0).cast("int")).alias("z")).first()
    assert row.m == pytest.approx(1, abs=0.05) and row.v == pytest.approx(1, abs=0.08) and row.z == pytest.approx(0.368, abs=0.02)


def test_cross_validation_table(rows):
    got = va.cross_validate(rows, {"nb": va.gaussian_fitter()}, CLASSES)
    assert got.columns == ["algo", "cv_fold", "metric", "value"]
    assert got.count() == 5 * 6


def test_grid_search_nb_agrees_with_plain_scoring(rows):
    got = {(r.var_smoothing, r.fold): r.test_f1 for r in nb.grid_search_nb(rows, CLASSES, [1e-9, 1.0]).collect()}
    for smoothing in (1e-9, 1.0):
        model = nb.fit_gaussian_nb(rows.where("fold <> 2"), CLASSES, smoothing)
        f1 = mt.micro_metrics(nb.score_gaussian_nb(rows.where("fold = 2"), model, CLASSES)).first().f1
        assert got[(smoothing, 2)] == pytest.approx(f1)


def test_documents_without_any_predicted_class_stay(spark):
    emb = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    df = emb.select(F.col("vec_id").alias("doc_id"), F.col("label").alias("category"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    model = md.fit_binary_relevance(df, md.logistic(df.count()), [0, 1])
    scored = model.predict(df)
    assert scored.count() == 2 * df.count()
    assert scored.groupBy("doc_id").agg(F.sum("pred").alias("p")).where("p = 0").count() > 0


@pytest.fixture(scope="module")
def logistic_parts(rows):
    model = md.fit_binary_relevance(rows, md.logistic(rows.count()), CLASSES)
    parts = md.linear_table(model)
    return model, [p[1] for p in parts], [p[2] for p in parts]


def test_sampled_shapley_adds_up(rows, logistic_parts):
    model, w, b = logistic_parts
    values = ex.shapley_sampled(rows, sm.sample_n(rows, 10), w, b, permutations=2)
    sums = values.groupBy("doc_id", "class_id").agg((F.sum("phi") + F.first("base")).alias("p"))
    scored = model.predict(rows).select("doc_id", "class_id", "score")
    assert sums.join(scored, ["doc_id", "class_id"]).agg(F.max(F.abs(F.col("p") - F.col("score")))).first()[0] < 1e-9


def test_local_surrogate_finds_the_driving_position(rows, logistic_parts):
    _, w, b = logistic_parts
    got = ex.explain_local(rows, w, b, ex.quartile_bins(rows), samples=500, k=3)
    assert got.groupBy("doc_id").count().where("count <> 3").count() == 0
    strongest = got.where("abs(weight) > 0").groupBy("doc_id", "class_id").agg(F.max_by("position", F.abs("weight")).alias("p"))
    assert strongest.where("p < 3").count() > 0.9 * rows.count()


def test_local_surrogate_equals_the_dense_one_in_little_memory(spark):
    import tracemalloc

    import pandas as pd

    class Frame:  # gives the function that tasks would run
        select = lambda self, *columns: self
        mapInPandas = lambda self, run, schema: run

    rng = np.random.default_rng(3)
    size, samples, seed = 24, 5000, 1
    data = rng.normal(size=(400, size))
    quarters = np.percentile(data, [25, 50, 75], axis=0).T
    rows = []
    for p, (x, q) in enumerate(zip(data.T, quarters)):
        bins = (x[:, None] > q).sum(axis=1)
        rows += [(p, n, *(f(x[bins == n]) for f in (len, np.mean, np.std, np.min, np.max)), list(q)) for n in range(4)]
    stats = pd.DataFrame(rows, columns=["p", "bin", "n", "mean", "std", "low", "high", "q"])
    w, b = rng.normal(size=(3, size)), rng.normal(size=3)
    run = ex.explain_local(Frame(), w, b, stats, samples=samples, k=4, seed=seed)
    batch = pd.DataFrame({"doc_id": [5, 8], "vec": list(data[:2])})
    next(run(iter([batch])))
    tracemalloc.start()
    got = next(run(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * samples * size * 8  # the dense way holds many arrays of samples x size numbers

    low, high, mean, std, n = (stats[c].to_numpy().reshape(size, 4) for c in ("low", "high", "mean", "std", "n"))
    for doc_id, x in zip(batch.doc_id, batch.vec):
        draw = np.random.default_rng([seed, doc_id])
        own = (x[:, None] > quarters).sum(axis=1)
        edges = np.cumsum(n / n.sum(axis=1, keepdims=True), axis=1)
        drawn = (draw.random((samples, size))[:, :, None] > edges[:, :3]).sum(axis=2)
        drawn[0], at = own, np.arange(size)
        value = np.clip(draw.standard_normal((samples, size)) * std[at, drawn] + mean[at, drawn], low[at, drawn], high[at, drawn])
        value[0] = x
        same = (drawn == own).astype(float)
        weight = np.sqrt(np.exp((same.sum(axis=1) - size) / (0.75**2 * size)))
        chance = 1 / (1 + np.exp(-(value @ w.T + b)))
        top = int(np.argmax(chance[0]))

        def ridge(z, y):
            zc, yc = z - weight @ z / weight.sum(), y - weight @ y / weight.sum()
            return np.linalg.solve(zc.T @ (zc * weight[:, None]) + np.eye(z.shape[1]), zc.T @ (weight * yc))

        strongest = np.argsort(-np.abs(ridge(same, chance[:, top])))[:4]
        expected = dict(zip(strongest.tolist(), ridge(same[:, strongest], chance[:, top])))
        mine = got[got.doc_id == doc_id]
        assert set(mine.class_id) == {top}
        assert dict(zip(mine.position, mine.weight)) == pytest.approx(expected, rel=1e-9, abs=1e-12)


def test_linear_shapley_is_exact(spark):
    cells = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (2, "b", 3), (3, "c", 1)], "doc_id bigint, term string, n bigint")
    docs_ = spark.createDataFrame([(1,), (2,), (3,), (4,)], "doc_id bigint")
    weights = spark.createDataFrame([("a", 1.0, -1.0, 2), ("b", 0.5, 0.5, 4), ("c", -2.0, 1.0, 1)], "term string, w0 double, w1 double, total bigint")
    model = ex.LinearShapley(weights, [0.1, -0.2], ex.background_means(docs_, cells, 2, seed=0))
    rows = model.force_rows(model.values(docs_, cells)).collect()
    w = {"a": (1.0, -1.0), "b": (0.5, 0.5), "c": (-2.0, 1.0)}
    docs = {1: {"a": 2, "b": 1}, 2: {"b": 3}, 3: {"c": 1}, 4: {}}
    assert len(rows) == 8
    for r in rows:
        margin = (0.1, -0.2)[r.class_id] + sum(n * w[t][r.class_id] for t, n in docs[r.doc_id].items())
        assert r.probability == pytest.approx(1 / (1 + np.exp(-margin)))




def test_sampled_shapley_values_are_near_the_exact_ones(spark):
    import itertools
    import math

    rng = np.random.default_rng(4)
    vectors = rng.standard_normal((12, 6))
    w, b = rng.standard_normal((2, 6)), rng.standard_normal(2)
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "doc_id long, vec array<double>")
    ground = vectors[:5]
    got = {(r.doc_id, r.class_id, r.position): r.phi for r in ex.shapley_sampled(docs, docs.where("doc_id < 5"), w.tolist(), b.tolist()).collect()}

    def probability(x, inside):
        mixed = np.where(np.isin(np.arange(6), list(inside)), x, ground)
        return (1 / (1 + np.exp(-(mixed @ w.T + b)))).mean(axis=0)

    errors = []
    for i in range(5, 9):
        for p in range(6):
            exact = 0
            for size in range(6):
                share = math.factorial(size) * math.factorial(5 - size) / math.factorial(6)
                for inside in itertools.combinations([q for q in range(6) if q != p], size):
                    exact = exact + share * (probability(vectors[i], {*inside, p}) - probability(vectors[i], inside))
            errors += [abs(got[i, c, p] - exact[c]) for c in range(2)]
    assert max(errors) < 0.02 and np.mean(errors) < 0.005


def test_an_order_and_its_reverse_are_switched_in_full(spark):
    """Values of a few rows by the definition: one position after the other, in the same orders."""
    rng = np.random.default_rng(4)
    w, b = rng.standard_normal((3, 5)), [0.1, -0.2, 0.3]
    x, ground = rng.standard_normal((4, 5)), rng.standard_normal((3, 5))
    frame = lambda rows: spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "doc_id long, vec array<double>")
    for turns in (4, 3):
        got = ex.shapley_sampled(frame(x), frame(ground), w, b, permutations=turns).toPandas()
        for i in range(4):
            draw, want, order = np.random.default_rng([0, i]), np.zeros((5, 3)), None
            for turn in range(turns):
                order = order[::-1] if turn % 2 else draw.permutation(5)
                now = ground.copy()
                for p in order:
                    before = 1 / (1 + np.exp(-(now @ w.T + b)))
                    now[:, p] = x[i, p]
                    want[p] += (1 / (1 + np.exp(-(now @ w.T + b))) - before).mean(axis=0) / turns
            mine = got[got.doc_id == i].sort_values(["position", "class_id"]).phi.to_numpy().reshape(5, 3)
            assert np.abs(mine - want).max() < 1e-12
