"""What must hold for fitted models, as queries whose full answers SQL gets from the tables alone.

A fitted model has no SQL form; sums that its fit must reproduce, partitions of the rows, key sets
and bounds have one. Each query runs the operator it is tagged with.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from presswork.catalog import fragments as sql
from presswork.catalog import models as cm
from presswork.catalog import similarity as cs
from presswork.catalog import vectors as cv
from presswork.catalog.features import TRAIN
from presswork.catalog.registry import CLASSES, CORPUS_SQL, corpus, query, table
from presswork.functions.numbers import dot, sigmoid
from presswork.operators import clusters as ct
from presswork.operators import kernel_shap as ks
from presswork.operators import sampling as sm
from presswork.operators import tables as tb
from presswork.operators import validation as va
from presswork.operators import vectors as vc
from presswork.operators import wide as wd

KINDS = "(SELECT unnest([1, 2, 3, 4]) AS c)"


# ---- class-against-rest models: every row scored, and labels, scores and predictions agree

SCORED_SQL = f"""WITH {CORPUS_SQL} SELECT CAST(c - 1 AS INTEGER) AS class_id, count(*) AS n, count(*) FILTER (category = c) AS positives,
    true AS consistent FROM corpus, {KINDS} GROUP BY c"""


def _tallied(scored, cut: float):
    same = (F.col("score") > cut) == (F.col("pred") == 1)
    positives = F.sum("y").cast("bigint").alias("positives")
    return scored.groupBy("class_id").agg(F.count(F.lit(1)).alias("n"), positives, F.every(same).alias("consistent"))


@query("M1 M7", SCORED_SQL)
def svm_tally(spark, folder):
    return _tallied(cm.linear_svm(spark, folder), 0.0)


@query("N1", SCORED_SQL)
def stacking_tally(spark, folder):
    return _tallied(cm.stacking(spark, folder), 0.5)


@query("N2", SCORED_SQL)
def bagging_tally(spark, folder):
    return _tallied(cm.bagging(spark, folder), 0.5)


@query("N3", SCORED_SQL)
def adaboost_tally(spark, folder):
    return _tallied(cm.adaboost(spark, folder), 0.0)


@query(
    "M2",
    f"""WITH {CORPUS_SQL} SELECT CAST(c - 1 AS INTEGER) AS class_id, count(*) FILTER (category = c) AS expected,
      true AS flat FROM corpus, {KINDS} WHERE split = 'train' GROUP BY c""",
)
def logistic_balance(spark, folder):
    """At the optimum the probabilities of a class add up to its rows: the gradient of the bias is 0."""
    train = corpus(spark, folder).where(TRAIN).select("doc_id")
    scored = cm.logistic_regression(spark, folder).join(train, "doc_id", "left_semi")
    sums = scored.groupBy("class_id").agg(F.sum("score").alias("mass"), F.sum("y").cast("bigint").alias("expected"))
    return sums.select("class_id", "expected", (F.abs(F.col("mass") - F.col("expected")) < 1 + 0.01 * F.col("expected")).alias("flat"))


@query(
    "M4",
    f"""WITH {CORPUS_SQL} SELECT CAST(c - 1 AS INTEGER) AS class_id, count(*) FILTER (category = c) AS rows, true AS few_missed
    FROM corpus, {KINDS} WHERE split = 'train' GROUP BY c""",
)
def tree_recall(spark, folder):
    """A deep tree with leaves of one row finds its training rows again; rows in one bin of every position
    cannot be told apart, which may hide one in twenty."""
    train = corpus(spark, folder).where(TRAIN).select("doc_id")
    scored = cm.decision_tree(spark, folder).join(train, "doc_id", "left_semi")
    sums = scored.groupBy("class_id").agg(F.sum("y").cast("bigint").alias("rows"), F.sum(F.col("y") * (1 - F.col("pred"))).alias("missed"))
    return sums.select("class_id", "rows", (F.col("missed") <= 0.05 * F.col("rows")).alias("few_missed"))


@query(
    "M6 E10",
    f"""WITH {CORPUS_SQL} SELECT algo, CAST(category - 1 AS INTEGER) AS actual, count(*) AS n
    FROM corpus, (SELECT unnest(['SVM/Linear SVC', 'Logistic Regression', 'Decision Tree']) AS algo)
    WHERE split = 'test' GROUP BY algo, category""",
)
def confusion_margins(spark, folder):
    """Rows of each confusion matrix add up to the test rows of the class."""
    cells = cm.one_vs_rest_confusion(spark, folder)
    rows = F.col("p0") + F.col("p1") + F.col("p2") + F.col("p3")
    return cells.select("algo", F.col("actual").cast("int").alias("actual"), rows.cast("bigint").alias("n")).where("n > 0")


# ---- validation: the grid of keys, and values within bounds

FOLDS = "(SELECT unnest(range(0, 5))::INTEGER AS f)"


@query(
    "V1 N1 N2 N3 N4",
    f"""SELECT algo, f AS cv_fold, metric, true AS bounded FROM {FOLDS},
      (SELECT unnest(['Gaussian Naive Bayes', 'SVM/Linear SVC', 'Logistic Regression', 'Decision Tree', 'Stacking', 'Bagging', 'AdaBoost']) AS algo),
      (SELECT unnest(['fit_time', 'score_time', 'test_precision', 'test_recall', 'test_f1', 'test_roc_auc']) AS metric)""",
)
def cross_validated_keys(spark, folder):
    """Seven algorithms x five folds x six metrics in one table."""
    rows = cm.cross_validate_all(spark, folder)
    bounded = F.col("value").between(0, F.when(F.col("metric").endswith("time"), 1e6).otherwise(1.0))
    return rows.select("algo", "cv_fold", "metric", bounded.alias("bounded"))


GRID_SQL = """SELECT count(*) AS settings, 5::BIGINT AS folds, true AS bounded, true AS useful FROM (SELECT unnest(range(0, {n})))"""
# micro F1 of the constant answer to four classes: one hit and three false alarms a row
CONSTANT = 0.4


def _grid_keys(results):
    """Settings and folds, whether F1 is between 0 and 1, and whether the best setting beats a constant in every fold."""
    good = F.col("test_f1").between(0, 1)
    best = results.groupBy("fold").agg(F.max("test_f1").alias("best")).agg(F.min("best").alias("worst_best"))
    settings, folds = F.countDistinct("setting").alias("settings"), F.countDistinct("fold").alias("folds")
    found = results.agg(settings, folds, F.every(good).alias("bounded"))
    return found.join(F.broadcast(best), how="cross").select("settings", "folds", "bounded", (F.col("worst_best") >= CONSTANT).alias("useful"))  # one row each


@query("V3", GRID_SQL.format(n=16))
def logistic_grid_keys(spark, folder):
    return _grid_keys(cm.grid_search_logistic(spark, folder))


@query("V4", GRID_SQL.format(n=216))
def svm_grid_keys(spark, folder):
    return _grid_keys(cm.grid_search_svm(spark, folder))


# three losses and penalties x eight costs x nine tolerances x five folds: the smooth ones reach every tolerance
@query("V4", "SELECT l AS loss, p AS l1, 360::BIGINT AS fits, true AS optimal FROM (VALUES ('hinge', 'False'), ('squared_hinge', 'False'), ('squared_hinge', 'True')) v(l, p)")
def svm_grid_optimum(spark, folder):
    """Every squared-hinge setting meets its tolerance; of hinges of costs up to 1 the dual value is within the
    tolerance or a hundredth of their own."""
    rows = cm.grid_search_svm(spark, folder)
    part = lambda name: F.regexp_extract("setting", rf"\b{name}=([^,]+)", 1)
    rows = rows.select(part("loss").alias("loss"), part("l1").alias("l1"), part("c").cast("double").alias("c"), part("tol").cast("double").alias("tol"), "distance")
    hinge = (F.col("c") > 1) | (F.col("distance") <= F.greatest(F.col("tol"), F.lit(0.01)))
    met = F.when(F.col("loss") == "hinge", hinge).otherwise(F.col("distance") <= F.col("tol"))
    return rows.groupBy("loss", "l1").agg(F.count(F.lit(1)).alias("fits"), F.every(met).alias("optimal"))


@query(
    "E12 W9",
    "SELECT CAST(p AS INTEGER) AS percent, true AS bounded FROM (SELECT unnest(range(10, 101, 10)) AS p)",
)
def learning_curve_keys(spark, folder):
    rows = cm.learning_curve(spark, folder)
    return rows.select("percent", (F.col("train_error").between(0, 1) & F.col("test_error").between(0, 1)).alias("bounded"))


def _sweep_keys(rows):
    """Keys of a sweep, whether the scores are bounded, and whether each fit's gradient is within the tolerance."""
    bounded = F.col("average_precision").between(0, 1 + 1e-9) & F.col("f1").between(0, 1)
    return rows.select("family", "class_id", bounded.alias("bounded"), (F.col("distance") <= 1e-4).alias("optimal"))


@query(
    "M8",
    f"""SELECT family, CAST(c - 1 AS INTEGER) AS class_id, true AS bounded, true AS optimal FROM {KINDS},
    (SELECT unnest(['vectors', 'count-words', 'tfidf-words', 'count-ngrams', 'tfidf-ngrams', 'count-chars', 'tfidf-chars']) AS family)""",
)
def feature_sweep_keys(spark, folder):
    return _sweep_keys(va.feature_sweep(cm.sweep_tables(spark, folder, selected=False), CLASSES))


@query(
    "M8",
    f"""SELECT family || '-' || p AS family, CAST(c - 1 AS INTEGER) AS class_id, true AS bounded, true AS optimal FROM {KINDS},
    (SELECT unnest(['count-words', 'count-ngrams', 'count-chars']) AS family), (SELECT unnest([10, 25, 50, 75]) AS p)""",
)
def feature_sweep_percentile_keys(spark, folder):
    return _sweep_keys(va.feature_sweep(cm.sweep_tables(spark, folder, whole=False), CLASSES))


# ---- clusters, topics, projections, vectors


@query("F11", "SELECT vec_id, true AS nearest FROM embeddings")
def nearest_centres(spark, folder):
    """No vector is nearer to the mean of the other cluster than to that of its own."""
    vectors = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("vec"))
    assigned = cs.embedding_clusters(spark, folder).join(vectors, "vec_id")
    centres = vc.cluster_centers(assigned).groupBy("cluster").agg(F.array_sort(F.collect_list(F.struct("pos", "value"))).alias("c"))
    centres = centres.select(F.col("cluster").alias("to"), F.transform("c", lambda x: x["value"]).alias("centre"))
    far = dot(F.col("centre"), F.col("centre")) - 2 * dot(F.col("vec"), F.col("centre"))
    placed = assigned.join(F.broadcast(centres), how="cross").withColumn("far", far)  # two centres
    own = F.max(F.when(F.col("cluster") == F.col("to"), F.col("far")))
    return placed.groupBy("vec_id").agg((own <= F.min("far") + 1e-3).alias("nearest"))


@query("F17", "SELECT label, count(*) AS n, true AS few FROM embeddings GROUP BY label")
def bisected_labels(spark, folder):
    """Every vector is in one of at most four clusters."""
    rows = cs.bisecting_clusters(spark, folder)
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.every(F.col("cluster").between(0, 3)).alias("few"))


@query("F18", "SELECT count(*) AS n, true AS uncorrelated, true AS main FROM embeddings")
def projection_axes(spark, folder):
    """The two axes are uncorrelated, and the first varies no less than the second or any single position."""
    vectors = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").alias("vec"))
    placed = ct.project_2d(ct.dense_vectors(vectors))
    single = vectors.select(F.posexplode(F.col("vec").cast("array<double>")).alias("p", "v")).groupBy("p").agg(F.var_pop("v").alias("v"))
    most = single.agg(F.max("v").alias("most"))
    rows = placed.agg(F.count(F.lit(1)).alias("n"), F.corr("x", "y").alias("r"), F.var_pop("x").alias("x"), F.var_pop("y").alias("y"))
    main = (F.col("x") >= F.col("y") - 1e-9) & (F.col("x") >= F.col("most") - 1e-9)
    return rows.join(F.broadcast(most), how="cross").select("n", (F.abs("r") < 1e-6).alias("uncorrelated"), main.alias("main"))


@query(
    "F14",
    f"""WITH {CORPUS_SQL}, seen AS (SELECT doc_id, unnest({sql.words('text')}) AS term FROM corpus),
    vocab AS (SELECT term FROM (SELECT DISTINCT doc_id, term FROM seen) GROUP BY term HAVING count(*) >= 2)
    SELECT doc_id, CAST(count(term) > 0 AS BIGINT) AS total FROM corpus LEFT JOIN (SELECT * FROM seen JOIN vocab USING (term)) USING (doc_id)
    GROUP BY doc_id""",
)
def topic_totals(spark, folder):
    """Topic weights of a document add up to 1, or to 0 without a known word."""
    rows = cs.document_topics(spark, folder)
    return rows.groupBy("doc_id").agg(F.round(F.sum("weight"), 6).cast("bigint").alias("total"))


@query("W3 W4", "SELECT CAST(t AS INTEGER) AS topic, true AS ordered, true AS bounded, 10::BIGINT AS words FROM (SELECT unnest(range(0, 8)) AS t)")
def topic_word_bounds(spark, folder):
    """Each topic has ten words in falling weight; those above a bound are no more than its inverse."""
    _, positions, _, model = cs._topics(spark, folder)
    words = ct.topic_words(model, positions, 10)
    before = F.lag("weight").over(Window.partitionBy("topic").orderBy("rank"))
    falling = words.withColumn("falls", F.coalesce(before >= F.col("weight"), F.lit(True)))
    heavy = ct.heavy_topic_words(ct.topic_words(model, positions, 200), 0.005).groupBy("topic").agg(F.sum("weight").alias("mass"))
    named = ct.topic_summaries(words).select("topic", F.size(F.split("summary", " ")).cast("bigint").alias("words"))
    found = falling.groupBy("topic").agg(F.every("falls").alias("ordered")).join(named, "topic").join(heavy, "topic", "left")
    return found.select("topic", "ordered", F.coalesce(F.col("mass") <= 1.0 + 1e-9, F.lit(True)).alias("bounded"), "words")


@query(
    "J2",
    f"""WITH {CORPUS_SQL} SELECT doc_id, category, label AS cluster FROM corpus JOIN embeddings ON doc_id = vec_id""",
)
def attached_clusters(spark, folder):
    """Cluster labels joined back to documents; the embeddings' labels stand for clusters."""
    labels = table(spark, folder, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("label").alias("cluster"))
    return tb.attach_clusters(corpus(spark, folder).select("doc_id", "category"), labels)


@query("F12 J2", f"WITH {CORPUS_SQL} SELECT doc_id, category, true AS known FROM corpus")
def topic_cluster_members(spark, folder):
    """Every document is in one of four clusters of topic weights."""
    rows = cs.topic_clusters(spark, folder)
    return rows.select("doc_id", "category", F.col("cluster").between(0, 3).alias("known"))


@query(
    "F15 S9",
    f"""WITH cleaned AS (SELECT {sql.clean('text')} AS t FROM documents), seen AS (SELECT unnest({sql.wordpunct('t')}) AS word FROM cleaned)
    SELECT word, 100::BIGINT AS size FROM seen GROUP BY word HAVING count(*) >= 5""",
)
def trained_words(spark, folder):
    """Every word of five or more occurrences has a vector, saved and read back."""
    rows = cv.train_word2vec(spark, folder)
    return rows.groupBy("word").agg(F.count(F.lit(1)).alias("size"))


# ---- explanations


@query("I3", "SELECT doc_id, 10::BIGINT AS n, true AS distinct_positions FROM documents")
def local_explanations(spark, folder):
    rows = cm.explain_local(spark, folder)
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), (F.countDistinct("position") == F.count(F.lit(1))).alias("distinct_positions"))


@query("I5 I6", f"SELECT doc_id, CAST(c - 1 AS INTEGER) AS class_id, true AS exact FROM documents, {KINDS}")
def shapley_sums(spark, folder):
    """Sampled Shapley values and the base add up to a document's probability."""
    values = cm.shapley_rows(spark, folder)
    sums = values.groupBy("doc_id", "class_id").agg((F.sum("phi") + F.max("base")).alias("p"))
    return sums.join(cm.logistic_regression(spark, folder), ["doc_id", "class_id"]).select(
        "doc_id", "class_id", (F.abs(F.col("p") - F.col("score")) < 1e-6).alias("exact")
    )


@query("I5", f"WITH {CORPUS_SQL} SELECT doc_id, CAST(c - 1 AS INTEGER) AS class_id, true AS exact FROM corpus, {KINDS}")
def shapley_ngram_sums(spark, folder):
    """Kernel SHAP values and the base add up to a document's probability."""
    docs, cells, rows, fits, weights = cm._ngram_logistic(spark, folder)
    values = ks.kernel_shap(docs, cells, weights, fits.biases, sm.sample_n(docs.select("doc_id"), 20, seed=0))
    sums = values.groupBy("doc_id", "class_id").agg((F.sum("phi") + F.max("base")).alias("p"))
    found = sums.join(wd.scored(rows, fits), ["doc_id", "class_id"])
    return found.select("doc_id", "class_id", (F.abs(F.col("p") - sigmoid(F.col("score"))) < 1e-6).alias("exact"))


@query(
    "I1 J7",
    f"SELECT CAST(c - 1 AS INTEGER) AS class_id, 10::BIGINT AS n, true AS ordered FROM {KINDS}",
)
def strongest_weights(spark, folder):
    """Ten named weights of each class in falling strength."""
    rows = cm.top_logistic_weights(spark, folder)
    before = F.lag(F.abs("weight")).over(Window.partitionBy("class_id").orderBy("rank"))
    falls = rows.withColumn("falls", F.coalesce(before >= F.abs("weight") - 1e-9, F.lit(True)))
    return falls.groupBy("class_id").agg(F.count("term").alias("n"), F.every("falls").alias("ordered"))

