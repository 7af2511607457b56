"""Queries and fits that need the sales several times compute them once."""

import pytest

from conftest import SF_SMALL
from pricewise.operators.models import REFERENCE_SPECS, fit_models
from pricewise.operators.split import seeded_sample
from pricewise.plans import context, fixtures, queries
from pricewise.plans.fixtures import SALE_KEY


def counted(df, seen):
    """``df``; every row that is computed adds 1 to ``seen``."""
    def run(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    return df.mapInArrow(run, df.schema)


def rows(spark, n):
    return spark.range(n).selectExpr(
        "id l_orderkey", "id l_partkey", "id l_suppkey", "id l_linenumber", "id % 5 vehicle_age", "id % 12 + 1 sale_month",
        "(id % 49 + 1) * 1000 odometer", "id % 9 / 2.0D condition", "'2015-02' year_month", "'m' || id % 3 make",
        "'n' || id % 4 model", "'b' || id % 2 body", "1000.0D + id % 97 sellingprice")


def test_fit_computes_training_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)
    a, b = fit_models(counted(rows(spark, 400), seen), [REFERENCE_SPECS["ridge"], REFERENCE_SPECS["lasso"]], SALE_KEY)
    assert seen.value == 400 and a.linear.design.names == b.linear.design.names


@pytest.mark.parametrize("n", [50, 400, 1000])
def test_sample_computes_rows_once(spark, n):
    seen = spark.sparkContext.accumulator(0)
    got = seeded_sample(counted(rows(spark, 400), seen), n, SALE_KEY).collect()
    assert seen.value == 400 and len(got) == min(n, 400)


@pytest.mark.parametrize("name", ["seasonality_factors", "seasonality_factors_out_of_fold", "seasonality_holdout",
                                  "seasonality_lookup", "seasonality_factors_sparse", "ridge_scores"])
def test_sales_computed_once(spark, monkeypatch, name):
    seen, total = spark.sparkContext.accumulator(0), fixtures.sale_view(spark, SF_SMALL).count()

    def view(spark, sf):
        return counted(fixtures.sale_view(spark, sf), seen)
    monkeypatch.setattr(context, "sale_view", view)
    monkeypatch.setattr(queries, "sparse_sale_view", view)
    monkeypatch.setattr(queries, "_FITTED", {})
    queries.REGISTRY[name](spark, SF_SMALL).collect()
    assert seen.value == total
