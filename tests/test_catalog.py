"""Every query with a SQL twin against DuckDB on the smallest tables."""

import pytest
from check import compare, connect

from presswork.catalog import load

FOLDER = "/root/testdata/sf0.001"
CATALOG = load()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


# minutes of model fits each; compared with SQL by tools/check.py
SLOW = {
    "feature_sweep_keys",
    "cross_validated_keys",
    "logistic_grid_keys",
    "svm_grid_keys",
    "svm_grid_optimum",
    "feature_sweep_percentile_keys",
    "learning_curve_keys",
    "stacking_tally",
    "bagging_tally",
    "adaboost_tally",
}


@pytest.mark.parametrize("name", [n for n, q in CATALOG.items() if q.sql and n not in SLOW])
def test_query_equals_sql(spark, con, name):
    entry = CATALOG[name]
    verdict = compare(entry.run(spark, FOLDER).toPandas(), con.execute(entry.sql).df())
    assert verdict.startswith("ok"), verdict


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert entry(spark).count() == 80
    assert set(oracle_sql()) <= set(queries())
