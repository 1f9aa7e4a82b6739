"""Naive Bayes, fitted models, validation, ensembles and explanations."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from presswork.catalog.features import CHARS, FIT_SQL, GRAMS, TRAIN, WORDS, WORDS_SQL, bag, fitted
from presswork.catalog.registry import CLASSES, corpus, documents, query, table
from presswork.catalog.vectors import word_vectors
from presswork.functions import text as tx
from presswork.operators import bayes as nb
from presswork.operators import ensembles as en
from presswork.operators import explain as ex
from presswork.operators import kernel_shap as ks
from presswork.operators import linear as lm
from presswork.operators import metrics as mt
from presswork.operators import models as md
from presswork.operators import sampling as sm
from presswork.operators import selection as sel
from presswork.operators import tables as tb
from presswork.operators import terms as tm
from presswork.operators import validation as va
from presswork.operators import vectors as vc
from presswork.operators import wide as wd
from presswork.plans import staged

TEN = list(range(10))


def embeddings(spark, folder):
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("doc_id"), F.col("label").alias("category"), F.col("embedding").cast("array<double>").alias("vec")
    )


def document_vectors(spark, folder):
    """Staged (doc_id, category, split, vec, features, fold): mean word vectors of the corpus."""
    docs = corpus(spark, folder)
    vectors = vc.doc_embeddings(docs, tx.wordpunct_tokens(F.col("text")), word_vectors(spark, folder))
    rows = docs.select("doc_id", "category", "split").join(vectors, "doc_id")
    return staged(sm.assign_folds(rows.withColumn("features", array_to_vector("vec")), 5), "vectors")


def _round(df, *names):
    for name in names:
        df = df.withColumn(name, F.round(name, 6))
    return df


PARTS_SQL = """parts AS (SELECT vec_id AS doc_id, label AS category, unnest(embedding)::DOUBLE AS x,
      generate_subscripts(embedding, 1) AS pos FROM embeddings),
    spread AS (SELECT max(v) AS v FROM (SELECT var_pop(x) AS v FROM parts GROUP BY pos)),
    classes AS (SELECT CAST(unnest(range(0, 10)) AS INTEGER) AS c)"""


@query(
    "M3 M7",
    f"""WITH {PARTS_SQL},
    stats AS (SELECT c, category = c AS inside, pos, avg(x) AS m, var_pop(x) + 1e-9 * (SELECT v FROM spread) AS v
      FROM parts, classes GROUP BY ALL),
    priors AS (SELECT c, ln(count(*) FILTER (label = c)) - ln(count(*) FILTER (label <> c)) AS prior
      FROM embeddings, classes GROUP BY c),
    dens AS (SELECT doc_id, category, s.c, sum(CASE WHEN inside THEN 1 ELSE -1 END
      * (-0.5 * ln(2 * pi() * v) - 0.5 * (x - m) * (x - m) / v)) AS d FROM parts JOIN stats s USING (pos) GROUP BY ALL),
    odds AS (SELECT doc_id, category, c, d + prior AS odds FROM dens JOIN priors USING (c))
    SELECT doc_id, c AS class_id, CAST(category = c AS INTEGER) AS y, round(1 / (1 + exp(-odds)), 6) AS score,
      CAST(odds > 0 AS INTEGER) AS pred FROM odds""",
)
def gaussian_naive_bayes(spark, folder):
    rows = embeddings(spark, folder)
    model = nb.fit_gaussian_nb(rows, TEN)
    return _round(nb.score_gaussian_nb(rows, model, TEN), "score")


GRID_SQL = f"""WITH {PARTS_SQL},
    folds AS (SELECT vec_id AS doc_id, CAST(ntile(5) OVER (ORDER BY vec_id) - 1 AS INTEGER) AS fold FROM embeddings),
    held AS (SELECT CAST(unnest(range(0, 5)) AS INTEGER) AS h),
    grid AS (SELECT unnest([1e-9, 1e-8, 1e-7, 1e-6, 1e-5, 1e-4, 1e-3, 1e-2, 1e-1, 1.0])::DOUBLE AS s),
    dealt AS (SELECT * FROM parts JOIN folds USING (doc_id)),
    tops AS (SELECT h, max(v) AS top FROM (SELECT h, pos, var_pop(x) AS v FROM dealt, held WHERE fold <> h GROUP BY h, pos)
      GROUP BY h),
    stats AS (SELECT h, c, category = c AS inside, pos, avg(x) AS m, var_pop(x) AS v
      FROM dealt, held, classes WHERE fold <> h GROUP BY ALL),
    priors AS (SELECT h, c, ln(count(*) FILTER (label = c)) - ln(count(*) FILTER (label <> c)) AS prior
      FROM embeddings e JOIN folds f ON e.vec_id = f.doc_id, held, classes WHERE fold <> h GROUP BY h, c),
    dens AS (SELECT d.doc_id, d.category, d.fold, t.h, t.c, s, sum(CASE WHEN inside THEN 1 ELSE -1 END
      * (-0.5 * ln(2 * pi() * (v + s * top)) - 0.5 * (x - m) * (x - m) / (v + s * top))) AS z
      FROM dealt d JOIN stats t USING (pos) JOIN tops USING (h), grid GROUP BY ALL),
    preds AS (SELECT s, h, fold = h AS test, category = c AS y, z + prior > 0 AS pred FROM dens JOIN priors USING (h, c)),
    f1s AS (SELECT s, h, test, 2.0 * count(*) FILTER (y AND pred) / nullif(2 * count(*) FILTER (y AND pred)
      + count(*) FILTER (y <> pred), 0) AS f1 FROM preds GROUP BY ALL),
    results AS (SELECT s AS var_smoothing, h AS fold, coalesce(max(f1) FILTER (NOT test), 0) AS train_f1,
      coalesce(max(f1) FILTER (test), 0) AS test_f1 FROM f1s GROUP BY s, h)"""


def _grid(spark, folder):
    return nb.grid_search_nb(sm.assign_folds(embeddings(spark, folder), 5), TEN)


@query(
    "V2",
    GRID_SQL
    + " SELECT var_smoothing, fold, round(train_f1, 6) AS train_f1, round(test_f1, 6) AS test_f1 FROM results",
)
def grid_search_naive_bayes(spark, folder):
    return _round(_grid(spark, folder), "train_f1", "test_f1")


@query(
    "V6 V2",
    GRID_SQL
    + """ SELECT var_smoothing, round(avg(test_f1), 6) AS mean_score FROM results GROUP BY var_smoothing
    ORDER BY round(avg(test_f1), 9) DESC, var_smoothing LIMIT 1""",
)
def best_smoothing(spark, folder):
    return _round(nb.best_setting(_grid(spark, folder), "var_smoothing"), "mean_score")


# ---- multinomial naive Bayes: the linear model whose weights SQL can compute


def _multinomial(spark, folder):
    cells = staged(bag(spark, folder, WORDS, ("split", "category")), "bag")
    sizes = sel.class_sizes(corpus(spark, folder).where(TRAIN))
    weights, biases = nb.multinomial_weights(cells.where(TRAIN), sizes)
    return cells, weights, biases


MULTI_SQL = f"""{WORDS_SQL}, {FIT_SQL},
    classes AS (SELECT CAST(unnest([1, 2, 3, 4]) AS INTEGER) AS c),
    train AS (SELECT * FROM bag WHERE split = 'train'),
    sums AS (SELECT term, c, sum(CASE WHEN category = c THEN n ELSE 0 END) AS yes, sum(n) AS total
      FROM train, classes GROUP BY term, c),
    alls AS (SELECT c, count(*) AS v, sum(yes) AS ys, sum(total - yes) AS ns FROM sums GROUP BY c),
    weights AS (SELECT c - 1 AS class_id, term, ln((yes + 1.0::DOUBLE) / (ys + v)) - ln((total - yes + 1.0::DOUBLE) / (ns + v))
      AS weight FROM sums JOIN alls USING (c)),
    biases AS (SELECT c - 1 AS class_id, ln(count(*) FILTER (category = c)) - ln(count(*) FILTER (category <> c)) AS bias
      FROM corpus, classes WHERE split = 'train' GROUP BY c)"""


@query(
    "M5 M7",
    f"""WITH {MULTI_SQL},
    margins AS (SELECT doc_id, class_id, sum(n * weight) AS m FROM bag JOIN weights USING (term) GROUP BY ALL),
    odds AS (SELECT doc_id, category, class_id, coalesce(m, 0) + bias AS z
      FROM (SELECT doc_id, category, class_id, bias FROM corpus, biases) LEFT JOIN margins USING (doc_id, class_id))
    SELECT doc_id, class_id, CAST(category = class_id + 1 AS INTEGER) AS y, round(1 / (1 + exp(-z)), 6) AS score,
      CAST(z > 0 AS INTEGER) AS pred FROM odds""",
)
def multinomial_naive_bayes(spark, folder):
    cells, weights, biases = _multinomial(spark, folder)
    return _round(nb.score_linear_terms(corpus(spark, folder), cells, weights, biases, CLASSES), "score")


@query(
    "I1 J7",
    f"""WITH {MULTI_SQL}, everything AS (SELECT class_id, term, weight FROM weights
      UNION ALL SELECT class_id, '<BIAS>', bias FROM biases)
    SELECT class_id, term, round(weight, 6) AS weight, CAST(row_number() OVER (PARTITION BY class_id
      ORDER BY round(abs(weight), 9) DESC, term) AS INTEGER) AS rank FROM everything QUALIFY rank <= 10""",
)
def top_weights(spark, folder):
    _, weights, biases = _multinomial(spark, folder)
    return _round(ex.top_weights(weights, biases, 10), "weight")


@query(
    "I2",
    f"""WITH {MULTI_SQL}, parts AS (SELECT doc_id, class_id, term, n * weight AS contribution
      FROM bag JOIN weights USING (term)
      UNION ALL SELECT d.doc_id, b.class_id, '<BIAS>', bias FROM corpus d, biases b)
    SELECT doc_id, class_id, term, round(contribution, 6) AS contribution,
      CAST(row_number() OVER (PARTITION BY doc_id, class_id ORDER BY round(abs(contribution), 9) DESC, term) AS INTEGER)
      AS rank FROM parts QUALIFY rank <= 10""",
)
def explain_linear(spark, folder):
    cells, weights, biases = _multinomial(spark, folder)
    return _round(ex.explain_linear(corpus(spark, folder), cells, weights, biases, 10), "contribution")


SHAP_SQL = f"""{MULTI_SQL},
    chosen AS (SELECT doc_id FROM corpus ORDER BY md5(concat('0:', doc_id)), doc_id LIMIT 20),
    means AS (SELECT term, sum(n) / 20.0::DOUBLE AS mean FROM bag WHERE doc_id IN (SELECT doc_id FROM chosen) GROUP BY term),
    mixed AS (SELECT w.*, coalesce(mean, 0) AS mean FROM weights w LEFT JOIN means USING (term)),
    bases AS (SELECT class_id, sum(weight * mean) AS shift, sum(weight * mean) + any_value(bias) AS base
      FROM mixed JOIN biases USING (class_id) GROUP BY class_id),
    met AS (SELECT doc_id, class_id, sum(weight * mean) AS met FROM bag JOIN mixed USING (term) GROUP BY ALL),
    phis AS (SELECT doc_id, class_id, term, weight * (n - mean) AS phi FROM bag JOIN mixed USING (term)
      UNION ALL SELECT doc_id, class_id, '<ABSENT>', coalesce(met, 0) - shift
      FROM (SELECT doc_id, class_id, shift FROM corpus, bases) LEFT JOIN met USING (doc_id, class_id))"""


def _shapley(spark, folder):
    cells, weights, biases = _multinomial(spark, folder)
    docs = corpus(spark, folder).select("doc_id")
    return docs, cells, ex.LinearShapley(weights, biases, ex.background_means(docs, cells, 20))


@query("I5 P11", f"WITH {SHAP_SQL} SELECT doc_id, class_id, term, round(phi, 6) + 0.0 AS phi FROM phis")
def shapley_linear(spark, folder):
    docs, cells, model = _shapley(spark, folder)
    return model.values(docs, cells).withColumn("phi", F.round("phi", 6) + 0.0)


@query(
    "I6",
    f"""WITH {SHAP_SQL}, total AS (SELECT count(*) AS n_docs FROM corpus),
    spread AS (SELECT term, sum(abs(n - mean)) AS present, count(*) AS df FROM bag
      JOIN (SELECT DISTINCT term, mean FROM mixed) USING (term) GROUP BY term),
    summary AS (SELECT class_id, term, round(abs(weight) * (present + ((SELECT n_docs FROM total) - df) * mean)
      / (SELECT n_docs FROM total), 9) AS mean_abs FROM mixed JOIN spread USING (term))
    SELECT class_id, term, round(mean_abs, 6) AS mean_abs, CAST(row_number() OVER (PARTITION BY class_id
      ORDER BY mean_abs DESC, term) AS INTEGER) AS rank FROM summary QUALIFY rank <= 20""",
)
def shapley_summary(spark, folder):
    docs, cells, model = _shapley(spark, folder)
    return _round(model.mean_absolute(docs, cells, 20), "mean_abs")


@query(
    "I7",
    f"""WITH {SHAP_SQL}, placed AS (SELECT doc_id, class_id, term, phi,
      row_number() OVER (PARTITION BY doc_id, class_id ORDER BY round(abs(phi), 9) DESC, term) AS rank,
      base + sum(phi) OVER (PARTITION BY doc_id, class_id) - coalesce(sum(phi) OVER (PARTITION BY doc_id, class_id
        ORDER BY round(abs(phi), 9) DESC, term ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS margin
      FROM phis JOIN bases USING (class_id))
    SELECT doc_id, class_id, CAST(rank AS INTEGER) AS rank, term, round(phi, 6) AS phi, round(margin, 6) AS margin
    FROM placed WHERE rank <= 16""",
)
def decision_path(spark, folder):
    docs, cells, model = _shapley(spark, folder)
    return _round(model.decision_path(model.values(docs, cells)), "phi", "margin")


@query(
    "I8",
    f"""WITH {SHAP_SQL}, totals AS (SELECT doc_id, class_id, sum(greatest(phi, 0)) AS up, sum(least(phi, 0)) AS down
      FROM phis GROUP BY ALL)
    SELECT doc_id, class_id, round(up, 6) AS up, round(down, 6) AS down, round(1 / (1 + exp(-base)), 6) AS base_probability,
      round(1 / (1 + exp(-(base + up + down))), 6) AS probability FROM totals JOIN bases USING (class_id)""",
)
def force_rows(spark, folder):
    docs, cells, model = _shapley(spark, folder)
    return _round(model.force_rows(model.values(docs, cells)), "up", "down", "base_probability", "probability")


# ---- fitted models


def _fit_and_score(spark, folder, make):
    rows = document_vectors(spark, folder).persist()
    train = rows.where(TRAIN)
    try:
        model = md.fit_binary_relevance(train, make(train.count()), CLASSES)
    finally:
        rows.unpersist()
    return model.predict(rows)


def _cells(docs, train, tokens, value, sizes):
    """Counts or weights in all ``docs`` of a family's terms known from ``train``."""
    column = tokens(F.col("text"))
    known = tm.fit_vocabulary(train, column)
    if value == "n":
        return tm.count_vectorize(docs, column, known, ("split", "category"))
    return tm.tfidf(docs, column, known, sum(sizes.values()), ("split", "category"))


def _placed(cells):
    """Staged places of the terms of ``cells`` in a vector."""
    return staged(tm.number_vocabulary(cells.groupBy("term").agg(F.count(F.lit(1)).alias("df"))), "places")


@query("I1 M2 J7")
def top_logistic_weights(spark, folder):
    """Strongest word n-grams of a logistic model on the counts of all of them, per class, bias included."""
    docs = corpus(spark, folder).where(TRAIN)
    cells = staged(_cells(docs, docs, SWEPT["ngrams"], "n", {}), "cells")
    places = _placed(cells)
    rows = lm.sparse_rows(cells, places, "n", lm.labelled(docs, CLASSES).withColumn("fold", F.lit(0)), ("label", "fold"))
    fits = wd.fit_wide(rows, places.count(), [lm.Problem(i, "logistic") for i in range(len(CLASSES))])
    named = F.broadcast(wd.strongest(fits, 10)).join(places.select("term", "position"), "position", "left")
    return named.select("class_id", "position", F.coalesce("term", F.lit("<BIAS>")).alias("term"), "weight", "rank")


@query("M1 M7")
def linear_svm(spark, folder):
    return _fit_and_score(spark, folder, md.linear_svm)


@query("M2 M7")
def logistic_regression(spark, folder):
    return _fit_and_score(spark, folder, md.logistic)


@query("M4 M7")
def decision_tree(spark, folder):
    return _fit_and_score(spark, folder, md.decision_tree)


@query("M6 E10")
def one_vs_rest_confusion(spark, folder):
    """Confusion matrices of argmax SVM, logistic and multiclass tree on the test split."""
    rows = document_vectors(spark, folder).persist()
    train, test = rows.where(TRAIN), rows.where("split = 'test'")
    n = train.count()
    tables = []
    for name, make in md.ESTIMATORS.items():
        model = md.fit_one_vs_rest(train.select("category", "features"), make(n))
        pairs = md.predict_label(model, test)
        tables.append(mt.confusion_matrix(pairs, range(4)).withColumn("algo", F.lit(name)))
    return tb.append_results(*tables)


SWEPT = {"words": WORDS, "ngrams": GRAMS, "chars": CHARS}
PERCENTS = (10, 25, 50, 75)
MASK_PART = 1 << 16


def sweep_tables(spark, folder, whole=True, selected=True):
    """Tables of a feature sweep: document vectors, counts and weights of words, word and character n-grams.

    Families are all features of each (``whole``) and, of counts, the best percentiles (``selected``).
    """
    docs = lm.labelled(corpus(spark, folder), CLASSES).withColumn("fold", F.lit(0))
    train = docs.where(TRAIN)
    sizes = sel.class_sizes(train)
    tables = {}
    if whole:
        vectors = lm.labelled(document_vectors(spark, folder), CLASSES)
        tables["vectors"] = (vectors, len(vectors.first().vec), {"vectors": None})
    for name, tokens in SWEPT.items():
        for kind, value in (("count", "n"), ("tfidf", "tfidf")):
            families = {f"{kind}-{name}": None} if whole else {}
            if kind == "tfidf" and not whole:
                continue
            cells = staged(_cells(docs, train, tokens, value, sizes), "cells")
            places = _placed(cells)
            width = places.count()
            if kind == "count" and selected:
                families |= _masks(cells, sizes, places, width, f"{kind}-{name}")
            rows = lm.sparse_rows(cells, places, value, docs, ("label", "fold", "split"))
            tables[f"{kind}-{name}"] = (rows, width, families)
    return tables


def _masks(cells, sizes, places, width, name):
    """Which places hold the best terms, for every percentile."""
    chosen = sel.select_percentiles(sel.anova_f(cells.where(TRAIN), sizes, "n"), PERCENTS)
    # in lists of bounded length, which reach the driver one partition at a time
    part = F.floor(F.col("position") / MASK_PART).cast("int")
    lists = chosen.join(places, "term").groupBy("percent", part.alias("part")).agg(F.collect_list((F.col("position") % MASK_PART).cast("int")).alias("at"))
    masks = {f"{name}-{p}": np.zeros(width, bool) for p in PERCENTS}
    for row in lists.toLocalIterator():
        masks[f"{name}-{row.percent}"][row.part * MASK_PART + np.array(row.at)] = True
    return masks


@query("M8")
def feature_sweep(spark, folder):
    """One SVM per feature family on all its terms, and one per percentile of each family of counts."""
    return va.feature_sweep(sweep_tables(spark, folder), CLASSES)


@query("V1 N4")
def cross_validate(spark, folder):
    """Five folds of naive Bayes, SVM, logistic regression and decision tree."""
    return va.cross_validate(document_vectors(spark, folder), va.standard_fitters(), CLASSES)


def cross_validate_all(spark, folder):
    """Base models and ensembles over five folds in one result table."""
    bases = {"nb": va.gaussian_fitter(), "svm": va.estimator_fitter(md.linear_svm)}
    fitters = va.standard_fitters() | {
        "Stacking": en.stacking_fitter(bases),
        "Bagging": en.bagging_fitter(10),
        "AdaBoost": en.adaboost_fitter(50),
    }
    return va.cross_validate(document_vectors(spark, folder), fitters, CLASSES)


@query("V3")
def grid_search_logistic(spark, folder):
    return va.grid_search_linear(document_vectors(spark, folder), va.logistic_grid(), CLASSES)


@query("V4")
def grid_search_svm(spark, folder):
    """Two losses and penalties, eight costs and nine tolerances over five folds."""
    return va.grid_search_linear(document_vectors(spark, folder), va.svm_grid(), CLASSES).drop("train_f1")


@query("V5")
def grid_search_tree(spark, folder):
    return va.grid_search(document_vectors(spark, folder), va.tree_grid(), md.decision_tree, CLASSES)


@query("E12 W9")
def learning_curve(spark, folder):
    rows = document_vectors(spark, folder)
    test = rows.where("split = 'test'")
    return va.learning_curve(rows.where(TRAIN), test, va.estimator_fitter(md.logistic), CLASSES)


def _ensemble(spark, folder, fitter):
    rows = document_vectors(spark, folder)
    return fitter(rows.where(TRAIN), CLASSES)(rows)


@query("N1")
def stacking(spark, folder):
    bases = {"nb": va.gaussian_fitter(), "svm": va.estimator_fitter(md.linear_svm)}
    return _ensemble(spark, folder, en.stacking_fitter(bases))


@query("N2")
def bagging(spark, folder):
    return _ensemble(spark, folder, en.bagging_fitter(10))


@query("N3")
def adaboost(spark, folder):
    return _ensemble(spark, folder, en.adaboost_fitter(50))


def _logistic(spark, folder):
    rows = document_vectors(spark, folder)
    train = rows.where(TRAIN)
    model = md.fit_binary_relevance(train, md.logistic(train.count()), CLASSES)
    parts = md.linear_table(model)
    return rows, [p[1] for p in parts], [p[2] for p in parts]


@query("I3")
def explain_local(spark, folder):
    """Local surrogates of the logistic model for every document."""
    rows, coefficients, biases = _logistic(spark, folder)
    return ex.explain_local(rows, coefficients, biases, ex.quartile_bins(rows.where(TRAIN)))


@query("I5")
def shapley_rows(spark, folder):
    """Sampled Shapley values of every document, class and position."""
    rows, coefficients, biases = _logistic(spark, folder)
    background = sm.sample_n(rows.select("doc_id", "vec"), 20, seed=0)
    return ex.shapley_sampled(rows, background, coefficients, biases)


@query("I5 I6")
def shapley_sampled(spark, folder):
    values = shapley_rows(spark, folder)
    return values.groupBy("class_id", "position", "base").agg(F.avg(F.abs("phi")).alias("mean_abs"))


def _ngram_logistic(spark, folder):
    """The corpus, its TF-IDF n-grams and a logistic model on all of them: (docs, cells, rows, fits, weights)."""
    docs = lm.labelled(corpus(spark, folder), CLASSES).withColumn("fold", F.lit(0))
    train = docs.where(TRAIN)
    cells = staged(_cells(docs, train, SWEPT["ngrams"], "tfidf", sel.class_sizes(train)), "cells")
    places = _placed(cells)
    width = places.count()
    rows = lm.sparse_rows(cells, places, "tfidf", docs, ("label", "fold", "split"))
    fits = wd.fit_wide(rows.where(TRAIN), width, [lm.Problem(i, "logistic") for i in range(len(CLASSES))])
    zeros = F.array(*[F.lit(0.0) for _ in CLASSES])
    weights = places.join(fits.table.select("position", "w"), "position", "left").select("term", "df", F.coalesce("w", zeros).alias("w"))
    return docs, cells, rows, fits, staged(weights, "weights")


@query("I5")
def shapley_ngrams(spark, folder):
    """Kernel SHAP values of every document's n-grams for the probabilities of the logistic model."""
    docs, cells, _, fits, weights = _ngram_logistic(spark, folder)
    return ks.kernel_shap(docs, cells, weights, fits.biases, sm.sample_n(docs.select("doc_id"), 20, seed=0))


@query("I6")
def shapley_ngram_summary(spark, folder):
    """The 20 n-grams of each class with the largest mean of absolute values over all documents."""
    values = shapley_ngrams(spark, folder).groupBy("class_id", "term").agg(F.sum(F.abs("phi")).alias("weight"))
    strong = ex.strongest(values, 20)
    return strong.select("class_id", "term", (F.col("weight") / corpus(spark, folder).count()).alias("mean_abs"), "rank")
