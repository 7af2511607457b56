"""Sinks, sources, model persistence and the streaming quote job."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from pricewise.operators.models import REFERENCE_SPECS, ModelSpec, PriceModel, fit_model
from pricewise.operators.quote import quote
from pricewise.operators.split import split
from pricewise.plans.context import Chain
from pricewise.plans.fixtures import SALE_KEY
from pricewise.sources.series import load_index, load_or_build_factors
from pricewise.sources.sinks import scratch_path, update_run_record, write_run_record, write_table
from pricewise.streaming import start_quote_stream


def test_load_or_build_factors_and_backfill(spark):
    c = Chain(spark, SF_SMALL)
    path = scratch_path(spark, "factors-lob")
    built = load_or_build_factors(
        spark, path, lambda: c.factors.drop("recommendation_eligible_months", "has_recommendation"))
    again = load_or_build_factors(spark, path, lambda: (_ for _ in ()).throw(AssertionError("rebuilt")))
    assert built.count() == again.count() == c.factors.count()
    a = {(r["body"], r["sale_month"]): r["has_recommendation"] for r in again.collect()}
    b = {(r["body"], r["sale_month"]): r["has_recommendation"] for r in c.factors.collect()}
    assert a == b
    spark.catalog.clearCache()


def test_index_csv_round_trip(spark, tmp_path):
    c = Chain(spark, SF_SMALL)
    idx = c.index.select("year_month", F.col("price").alias("cpi_used_cars"), "cpi_multiplier")
    path = scratch_path(spark, "index-csv")
    write_table(idx, path, fmt="csv")
    back = load_index(spark, path, "year_month string, cpi_used_cars double, cpi_multiplier double")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, idx.collect()))
    spark.catalog.clearCache()


def test_run_record_partial_update(spark):
    path = scratch_path(spark, "record")
    write_run_record(spark, {"metrics": {"mae": 1.0}, "segment_metrics": [{"segment": "x", "n": 1}]},
                     path)
    seg = spark.createDataFrame([("Budget", 12), ("Luxury", 30)], "segment string, n bigint")
    out = update_run_record(spark, path, "segment_metrics", seg, path + "-updated")
    rec = spark.read.json(out).first()
    assert rec["metrics"]["mae"] == 1.0
    assert [s["segment"] for s in rec["segment_metrics"]] == ["Budget", "Luxury"]
    assert update_run_record(spark, path + "-missing", "segment_metrics", seg, path + "-x") is None


def test_model_save_load_predicts_the_same(spark):
    c = Chain(spark, SF_SMALL)
    train, test = split(c.frame, SALE_KEY)
    model = fit_model(train, REFERENCE_SPECS["lasso"])
    path = scratch_path(spark, "model")
    model.save(path)
    again = PriceModel.load(spark, path)
    a = sorted(map(tuple, model.transform(test).select(*SALE_KEY, "prediction").collect()))
    b = sorted(map(tuple, again.transform(test).select(*SALE_KEY, "prediction").collect()))
    assert a == b
    spark.catalog.clearCache()


def test_streaming_quotes_equal_batch(spark):
    c = Chain(spark, SF_SMALL)
    vehicles = c.vehicles()
    src = scratch_path(spark, "requests")
    vehicles.write.parquet(src)
    schema = ", ".join(f"{n} {t}" for n, t in vehicles.dtypes)
    q = start_quote_stream(spark, src, schema, c.baseline.transform, c.index, c.factors,
                           sink="memory", query_name="quotes_test")
    q.processAllAvailable()
    q.stop()
    streamed = spark.sql("SELECT * FROM quotes_test")
    batch = quote(vehicles, c.baseline.transform, c.index, c.factors)
    cols = [*SALE_KEY, "final_price", "verdict"]
    assert sorted(map(tuple, streamed.select(*cols).collect())) == \
        sorted(map(tuple, batch.select(*cols).collect()))
    spark.catalog.clearCache()


def test_series_files_skip_missing_and_take_last_value(spark, tmp_path):
    from pricewise.operators.index import monthly_last
    from pricewise.sources.series import read_series_csv
    p = tmp_path / "oil.csv"
    p.write_text("observation_date,DCOIL\n2020-01-02,10.5\n2020-01-31,.\n2020-01-30,11.0\n"
                 "2020-02-03,12.0\n2020-03-02,.\n")
    long, skipped = read_series_csv(spark, {"oil": str(p), "gone": str(tmp_path / "missing.csv")})
    assert skipped == ["gone"]
    got = {r["year_month"]: r["value"] for r in monthly_last(long).collect()}
    # last non-null value in date order; a month with only nulls keeps a null row
    assert got == {"2020-01": 11.0, "2020-02": 12.0, "2020-03": None}
