"""Every SQL-checked query equals its DuckDB oracle (sf0.001; the driver
repeats this at sf0.01), and every rows-only query runs."""

import pytest

import __spark_entry__ as entry
from oracle_harness import compare, duck
from conftest import SF_SMALL

SQL = entry.oracle_sql()
QUERIES = entry.queries()
ML = {"gbt_scores", "gbt_raw_scores", "forest_scores", "ridge_scores", "lasso_scores", "model_comparison",
      "permutation_importance"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[name])
    ok, msgs = compare(rows, df.columns, cur.fetchall(), [d[0] for d in cur.description])
    spark.catalog.clearCache()
    assert ok, msgs


def test_every_query_is_registered_with_sql_or_is_a_model():
    from pricewise.plans.queries import REGISTRY
    assert set(REGISTRY) - set(SQL) == ML


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "final_price" in df.columns


@pytest.mark.parametrize("name", ["ridge_scores", "lasso_scores"])
def test_model_queries_run(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() > 0
