"""Metrics over a scored table whose scores come from hashes of the document keys.

Hash scores give exact ties and a known answer in SQL; fitted models feed the
same operators in ``models``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from presswork.catalog.registry import CLASSES, CORPUS_SQL, corpus, query, table
from presswork.catalog.tables import NAMES_SQL, _path
from presswork.operators import metrics as mt
from presswork.operators import sampling as sm
from presswork.operators import tables as tb
from presswork.sources import tables as src

ALGOS = ["hash scores A", "hash scores B"]


def scored(spark, folder, algo=ALGOS[0]):
    """(doc_id, class_id, y, score, pred): seeded hash score, 0.3 higher for the true class."""
    rows = tb.binarize_labels(corpus(spark, folder).select("doc_id", "category"), CLASSES).drop("category")
    seed = F.md5(F.concat_ws(":", "doc_id", "class_id", F.lit(algo)))
    thousandths = F.conv(F.substring(seed, 1, 7), 16, 10).cast("bigint") % 1000 + F.col("y") * 300
    rows = rows.withColumn("score", thousandths.cast("double") / 1000)
    return rows.withColumn("pred", (F.col("score") >= 0.5).cast("int"))


def scored_sql(algo=ALGOS[0], name="scored"):
    return f"""{name}_raw AS (SELECT doc_id, c - 1 AS class_id, CAST(category = c AS INTEGER) AS y
      FROM corpus, (SELECT CAST(unnest([1, 2, 3, 4]) AS INTEGER) AS c)),
    {name} AS (SELECT doc_id, class_id, y, score, CAST(score >= 0.5 AS INTEGER) AS pred FROM (
      SELECT *, (CAST('0x' || md5(concat_ws(':', doc_id, class_id, '{algo}'))[1:7] AS BIGINT) % 1000 + y * 300)::DOUBLE
        / 1000 AS score FROM {name}_raw))"""


SCORED_SQL = f"{CORPUS_SQL}, {scored_sql()}"
COUNTS = """sum(CASE WHEN y = 1 AND pred = 1 THEN 1 ELSE 0 END)::DOUBLE AS tp,
    sum(CASE WHEN y = 0 AND pred = 1 THEN 1 ELSE 0 END)::DOUBLE AS fp,
    sum(CASE WHEN y = 1 AND pred = 0 THEN 1 ELSE 0 END)::DOUBLE AS fn,
    sum(CASE WHEN y = 0 AND pred = 0 THEN 1 ELSE 0 END)::DOUBLE AS tn"""
PRECISION = "CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END"
RECALL = "CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END"
F1 = "CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END"
ACCURACY = "(tp + tn) / (tp + fp + fn + tn)"
MCC = """CASE WHEN (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn) = 0 THEN 0
    ELSE (tp * tn - fp * fn) / sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)) END"""
AUC = f"({RECALL} + CASE WHEN tn + fp = 0 THEN 0 ELSE tn / (tn + fp) END) / 2"


def steps_sql(by):
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    return f"""steps AS (SELECT {keys}score, sum(y) AS hits, count(*) AS cases FROM scored GROUP BY {keys}score),
    running AS (SELECT {keys}score, hits, sum(hits) OVER ({part}ORDER BY score DESC)::DOUBLE AS tp,
      sum(cases) OVER ({part}ORDER BY score DESC)::DOUBLE AS seen,
      sum(hits) OVER ({part.strip()})::DOUBLE AS positives FROM steps)"""


def _rounded(df, *names):
    for name in names:
        df = df.withColumn(name, F.round(name, 6))
    return df


def curve_sql(by):
    keys = f"{by}, " if by else ""
    return f"""WITH {SCORED_SQL}, {steps_sql(by)} SELECT {keys}score AS threshold, round(tp / seen, 6) AS precision,
    round(tp / positives, 6) AS recall FROM running WHERE tp - hits < positives"""


@query("E1", curve_sql("class_id"))
def pr_curve(spark, folder):
    return _rounded(mt.pr_curve(scored(spark, folder)), "precision", "recall")


@query("E3", curve_sql(None))
def micro_pr_curve(spark, folder):
    return _rounded(mt.pr_curve(scored(spark, folder), by=None), "precision", "recall")


AREA = "round(sum(hits / positives * tp / seen), 6) AS average_precision"


@query("E2", f"WITH {SCORED_SQL}, {steps_sql('class_id')} SELECT class_id, {AREA} FROM running GROUP BY class_id")
def average_precision(spark, folder):
    return _rounded(mt.average_precision(scored(spark, folder)), "average_precision")


@query("E3", f"WITH {SCORED_SQL}, {steps_sql(None)} SELECT {AREA} FROM running")
def micro_average_precision(spark, folder):
    return _rounded(mt.average_precision(scored(spark, folder), by=None), "average_precision")


@query(
    "E4 E5 E11",
    f"""WITH {SCORED_SQL}, counts AS (SELECT class_id, {COUNTS} FROM scored GROUP BY class_id)
    SELECT class_id, round({PRECISION}, 6) AS precision, round({RECALL}, 6) AS recall, round({F1}, 6) AS f1,
      round({ACCURACY}, 6) AS accuracy, round({MCC}, 6) AS mcc FROM counts""",
)
def class_metrics(spark, folder):
    return _rounded(mt.class_metrics(scored(spark, folder)), "precision", "recall", "f1", "accuracy", "mcc")


@query(
    "E4 E7 E8",
    f"""WITH {SCORED_SQL}, counts AS (SELECT {COUNTS} FROM scored)
    SELECT round({PRECISION}, 6) AS precision, round({RECALL}, 6) AS recall, round({F1}, 6) AS f1,
      round({AUC}, 6) AS roc_auc FROM counts""",
)
def micro_metrics(spark, folder):
    return _rounded(mt.micro_metrics(scored(spark, folder)), "precision", "recall", "f1", "roc_auc")


def sheet_sql(algo, tag):
    return f"""{scored_sql(algo, tag)},
    {tag}_counts AS (SELECT class_id::VARCHAR AS class_id, {COUNTS} FROM {tag} GROUP BY class_id),
    {tag}_all AS (SELECT {COUNTS} FROM {tag}),
    {tag}_steps AS (SELECT class_id, score, sum(y) AS hits, count(*) AS cases FROM {tag} GROUP BY class_id, score),
    {tag}_run AS (SELECT class_id, hits, sum(hits) OVER (PARTITION BY class_id ORDER BY score DESC)::DOUBLE AS tp,
      sum(cases) OVER (PARTITION BY class_id ORDER BY score DESC)::DOUBLE AS seen,
      sum(hits) OVER (PARTITION BY class_id)::DOUBLE AS positives FROM {tag}_steps),
    {tag}_msteps AS (SELECT score, sum(y) AS hits, count(*) AS cases FROM {tag} GROUP BY score),
    {tag}_mrun AS (SELECT hits, sum(hits) OVER (ORDER BY score DESC)::DOUBLE AS tp,
      sum(cases) OVER (ORDER BY score DESC)::DOUBLE AS seen, sum(hits) OVER ()::DOUBLE AS positives FROM {tag}_msteps),
    {tag}_sheet AS (
      SELECT '{algo}' AS algo, class_id, 'F1' AS metric, {F1} AS value FROM {tag}_counts
      UNION ALL SELECT '{algo}', class_id, 'MCC', {MCC} FROM {tag}_counts
      UNION ALL SELECT '{algo}', 'micro', 'F1', {F1} FROM {tag}_all
      UNION ALL SELECT '{algo}', 'micro', 'MCC', avg({MCC}) FROM {tag}_counts
      UNION ALL SELECT '{algo}', class_id::VARCHAR, 'P-R', sum(hits / positives * tp / seen) FROM {tag}_run GROUP BY class_id
      UNION ALL SELECT '{algo}', 'micro', 'P-R', sum(hits / positives * tp / seen) FROM {tag}_mrun)"""


SHEETS_SQL = f"""{CORPUS_SQL}, {sheet_sql(ALGOS[0], 'a')}, {sheet_sql(ALGOS[1], 'b')},
    sheet AS (SELECT algo, class_id, metric, round_even(value * 1000, 0) / 1000 AS value
      FROM (SELECT * FROM a_sheet UNION ALL SELECT * FROM b_sheet))"""


def _sheets(spark, folder):
    return tb.append_results(*[mt.score_sheet(scored(spark, folder, a), a) for a in ALGOS])


@query("E6 U2", f"WITH {SHEETS_SQL} SELECT algo, class_id, metric, value FROM sheet")
def score_sheet(spark, folder):
    return _sheets(spark, folder)


@query(
    "E6",
    f"WITH {SHEETS_SQL} SELECT algo, "
    + ", ".join(
        f"""max(CASE WHEN class_id = '{c}' AND metric = '{m}' THEN value END) AS "{m} {c}\""""
        for c in ("0", "1", "2", "3", "micro")
        for m in ("P-R", "F1", "MCC")
    )
    + " FROM sheet GROUP BY algo",
)
def wide_score_sheet(spark, folder):
    return mt.wide_sheet(_sheets(spark, folder))


CELLS = ", ".join(f"count(CASE WHEN predicted = {c} THEN 1 END) AS p{c}" for c in range(4))


@query(
    "E9",
    f"""WITH {SCORED_SQL}, pairs AS (SELECT doc_id, coalesce(min(CASE WHEN y = 1 THEN class_id END), 0) AS actual,
      coalesce(min(CASE WHEN pred = 1 THEN class_id END), 0) AS predicted FROM scored GROUP BY doc_id)
    SELECT actual, {CELLS} FROM pairs GROUP BY actual""",
)
def confusion_matrix(spark, folder):
    return mt.confusion_matrix(mt.first_positive(scored(spark, folder)), range(4))


BEST_SQL = """pairs AS (SELECT doc_id, coalesce(min(CASE WHEN y = 1 THEN class_id END), 0) AS actual,
      arg_min(class_id, (-score, class_id)) AS predicted FROM scored GROUP BY doc_id)"""


@query("E10", f"WITH {SCORED_SQL}, {BEST_SQL} SELECT actual, {CELLS} FROM pairs GROUP BY actual")
def label_confusion_matrix(spark, folder):
    return mt.confusion_matrix(mt.best_class(scored(spark, folder)), range(4))


@query(
    "I4 J6",
    f"""WITH {SCORED_SQL}, {BEST_SQL}, {NAMES_SQL}
    SELECT doc_id, p.class_name AS predicted_class, a.class_name AS true_class FROM pairs
    JOIN names p ON p.category = predicted + 1 JOIN names a ON a.category = actual + 1""",
)
def predicted_and_true_class(spark, folder):
    pairs = mt.best_class(scored(spark, folder))
    pairs = pairs.select("doc_id", F.col("predicted") + 1, F.col("actual") + 1).toDF("doc_id", "predicted", "actual")
    classes = src.read_classes(spark)
    named = tb.class_names(pairs, classes.withColumnRenamed("class_name", "predicted_class"), "predicted")
    named = tb.class_names(named, classes.withColumnRenamed("class_name", "true_class"), "actual")
    return named.select("doc_id", "predicted_class", "true_class")


NAMES = ["precision", "recall", "f1", "roc_auc"]


def fold_results(spark, folder):
    """Long results (algo, cv_fold, metric, value) of the hash-scored algorithms."""
    folds = sm.assign_folds(corpus(spark, folder).select("doc_id"), 5).withColumnRenamed("fold", "cv_fold")
    tables = []
    for algo in ALGOS:
        rows = scored(spark, folder, algo).join(folds, "doc_id")
        long = mt.long_metrics(mt.micro_metrics(rows, ["cv_fold"]), ["cv_fold"], NAMES)
        tables.append(long.select(F.lit(algo).alias("algo"), "cv_fold", "metric", "value"))
    return tb.append_results(*tables)


def _fold_sql():
    parts = []
    for algo, tag in zip(ALGOS, "ab"):
        for name, formula in zip(NAMES, (PRECISION, RECALL, F1, AUC)):
            parts.append(f"SELECT '{algo}' AS algo, cv_fold, 'test_{name}' AS metric, {formula} AS value FROM {tag}_fold")
    folds = "folds AS (SELECT doc_id, CAST(ntile(5) OVER (ORDER BY doc_id) - 1 AS INTEGER) AS cv_fold FROM corpus)"
    grouped = [
        f"{tag}_fold AS (SELECT cv_fold, {COUNTS} FROM {tag} JOIN folds USING (doc_id) GROUP BY cv_fold)" for tag in "ab"
    ]
    bases = [scored_sql(algo, tag) for algo, tag in zip(ALGOS, "ab")]
    return ",\n".join([CORPUS_SQL, folds, *bases, *grouped, "results AS (" + " UNION ALL ".join(parts) + ")"])


RESULTS_SQL = _fold_sql()


@query("W7 E7 E8 U2 P1", f"WITH {RESULTS_SQL} SELECT algo, cv_fold, metric, round(value, 6) AS value FROM results")
def fold_metrics(spark, folder):
    return _rounded(fold_results(spark, folder), "value")


@query(
    "P6",
    f"""WITH {RESULTS_SQL} SELECT algo, cv_fold, metric, round(value, 6) AS value FROM results
    WHERE metric = 'test_f1'""",
)
def one_metric(spark, folder):
    return _rounded(tb.metric_rows(fold_results(spark, folder), "test_f1"), "value")


@query("W10", f"WITH {RESULTS_SQL} SELECT DISTINCT metric FROM results ORDER BY metric")
def metric_names(spark, folder):
    return tb.metric_names(fold_results(spark, folder))


@query(
    "A9",
    f"""WITH {RESULTS_SQL} SELECT algo, metric, round(min(value), 6) AS low,
      round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.5), 6) AS median,
      round(quantile_cont(value, 0.75), 6) AS q3, round(max(value), 6) AS high FROM results GROUP BY algo, metric""",
)
def cv_box_stats(spark, folder):
    return _rounded(tb.cv_box_stats(fold_results(spark, folder)), "low", "q1", "median", "q3", "high")


@query(
    "V6",
    f"""WITH {RESULTS_SQL} SELECT algo, round(avg(value), 6) AS mean_value FROM results WHERE metric = 'test_f1'
    GROUP BY algo ORDER BY mean_value DESC, algo LIMIT 1""",
)
def best_algorithm(spark, folder):
    rows = tb.metric_rows(fold_results(spark, folder), "test_f1")
    means = rows.groupBy("algo").agg(F.round(F.avg("value"), 6).alias("mean_value"))
    return means.orderBy(F.desc("mean_value"), "algo").limit(1)


@query("S11 S6 N4", f"WITH {RESULTS_SQL} SELECT algo, cv_fold, metric, round(value, 6) AS value FROM results")
def save_and_load_cv_results(spark, folder):
    path = _path(spark, "results")
    results = _rounded(fold_results(spark, folder), "value")
    src.save_csv(results.select(F.monotonically_increasing_id().alias("id"), "*"), path)
    return src.load_cv_results(spark, path)
