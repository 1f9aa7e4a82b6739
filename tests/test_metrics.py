import pytest

from presswork.operators import metrics as mt

SCHEMA = "doc_id bigint, class_id int, y int, score double, pred int"


def test_tied_scores_are_one_step(spark):
    df = spark.createDataFrame([(i, 0, int(i < 3), 0.5, 1) for i in range(12)], SCHEMA)
    points = mt.pr_curve(df).collect()
    assert [(p.precision, p.recall) for p in points] == [(0.25, 1.0)]
    assert mt.average_precision(df).first().average_precision == 0.25


def test_average_precision_with_ties(spark):
    rows = [(0, 1, 0.9), (1, 0, 0.8), (2, 1, 0.8), (3, 1, 0.4), (4, 0, 0.1)]
    df = spark.createDataFrame([(d, 0, y, s, int(s > 0.5)) for d, y, s in rows], SCHEMA)
    expected = (1 / 3) * 1 + (1 / 3) * (2 / 3) + (1 / 3) * (3 / 4)
    assert mt.average_precision(df).first().average_precision == pytest.approx(expected)
    assert mt.average_precision(df, by=None).first().average_precision == pytest.approx(expected)


def test_nothing_predicted(spark):
    df = spark.createDataFrame([(i, 0, i % 2, 0.1, 0) for i in range(4)], SCHEMA)
    row = mt.class_metrics(df).first()
    assert (row.f1, row.mcc, row.precision, row.recall) == (0.0, 0.0, 0.0, 0.0)


def test_all_zero_rows_count_as_class_zero_and_doubles_as_the_lowest(spark):
    preds = {1: [0, 0, 0, 0], 2: [0, 1, 1, 0]}
    df = spark.createDataFrame(
        [(d, c, int(c == 2), float(p), p) for d, row in preds.items() for c, p in enumerate(row)], SCHEMA
    )
    got = {r.doc_id: (r.actual, r.predicted) for r in mt.first_positive(df).collect()}
    assert got == {1: (2, 0), 2: (2, 1)}
    matrix = mt.confusion_matrix(mt.first_positive(df), range(4)).first()
    assert tuple(matrix) == (2, 1, 1, 0, 0)


def test_misclassification_needs_the_whole_row(spark):
    rows = [(1, 0, 1, 0.9, 1), (1, 1, 0, 0.1, 0), (2, 0, 1, 0.9, 1), (2, 1, 0, 0.9, 1)]
    assert mt.misclassification(spark.createDataFrame(rows, SCHEMA)).first().error == 0.5
