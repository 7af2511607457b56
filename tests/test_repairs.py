"""Record repair against the csv module, one-hot scoring, metrics and sessions."""

import csv
import random

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from pricewise.functions.dates import parse_sale_time, utc_text
from pricewise.operators.clean import split_csv_record
from pricewise.config import FEATURE_COLUMNS
from pricewise.operators.index import align, asof_lookup, enrich, read_series_csv, strict_lookup
from pricewise.operators.metrics import regression_metrics, segment_metrics
from pricewise.operators.models import (REFERENCE_SPECS, ModelSpec, fit_models, impurity_importance,
                                        permutation_importance)
from pricewise.operators.split import split as split_rows
from pricewise.plans.context import Chain
from pricewise.plans.fixtures import SALE_KEY
from pricewise.plans.queries import compare_models
from pricewise.sources.series import load_or_build_factors


def split(spark, lines):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    return [r.f for r in df.select("i", split_csv_record(F.col("line")).alias("f")).orderBy("i").collect()]


def test_split_equals_csv_reader(spark):
    rng = random.Random(11)
    lines = ['a,"b"c,d', 'a,"b,c"d,e', '"a,""b"" c",d', 'a"b,c', '"x', 'a,"x,y', '"",,""', ",", '"a""', 'a,"b""c"d"e,f']
    lines += ["".join(rng.choice('ab",  ') for _ in range(rng.randrange(1, 14))) for _ in range(400)]
    want = [next(csv.reader([x])) for x in lines]
    assert split(spark, lines) == want


def test_very_many_escaped_quotes(spark):
    line = 'a,"' + '""' * 100_000 + '",b,' + "c" * 300_000
    got = split(spark, [line])[0]
    assert got == ["a", '"' * 100_000, "b", "c" * 300_000]


def test_metrics_without_spread_or_with_zero(spark):
    df = spark.createDataFrame([(5.0, 4.0), (5.0, 6.0)], "sellingprice double, prediction double")
    assert regression_metrics(df).first().r2 is None
    zero = spark.createDataFrame([(0.0, 4.0), (0.0, 6.0)], "sellingprice double, prediction double")
    r = regression_metrics(zero, extended=True).first()
    assert r.mape_percent is None and r.mae == 5.0 and r.mae_relative_percent is None
    assert segment_metrics(zero, min_rows=1).count() == 0


def test_align_one_series_and_strict_lookup(spark):
    s = spark.createDataFrame([("p", "2015-01", 1.0), ("p", "2015-02", None)], "series string, year_month string, value double")
    assert [tuple(r) for r in align(s, ["p"]).collect()] == [("2015-01", 1.0)]
    index = spark.createDataFrame([("2015-01", 1.0), ("2015-02", None)], "year_month string, cpi_multiplier double")
    facts = spark.createDataFrame([("2015-01",), ("2015-02",), ("2016-01",)], "year_month string")
    with pytest.raises(ValueError, match="2015-02, 2016-01"):
        strict_lookup(facts, index)
    assert strict_lookup(facts.limit(1), index).count() == 1
    assert spark.sparkContext._jsc.getPersistentRDDs().size() >= 0


def test_one_hot_model_keeps_columns(spark):
    from pricewise.operators.models import REFERENCE_SPECS, fit_model
    from pricewise.plans.context import Chain
    frame = Chain(spark, SF_SMALL).frame
    model = fit_model(frame, REFERENCE_SPECS["ridge"])
    cols = ["year_month", "make", "model", "body"]
    before = sorted(tuple(r) for r in frame.select(*cols).collect())
    after = sorted(tuple(r) for r in model.transform(frame).select(*cols).collect())
    assert before == after


def test_index_month_must_be_unique(spark):
    index = spark.createDataFrame([("2015-01", 1.0), ("2015-01", 2.0)], "year_month string, cpi_multiplier double")
    facts = spark.createDataFrame([("2015-01",)], "year_month string")
    for job in (lambda: enrich(facts, index).collect(), lambda: strict_lookup(facts, index).collect(),
                lambda: asof_lookup(facts, index, ["cpi_multiplier"]).collect()):
        with pytest.raises(Exception, match="index month occurs twice"):
            job()


SMALL_SPECS = [
    ModelSpec("Boosted trees", "gbt", "ordinal", dict(maxIter=4, stepSize=0.3, maxDepth=4, maxBins=255)),
    ModelSpec("Boosted trees (sampled)", "gbt", "onehot",
              dict(maxIter=3, stepSize=0.3, maxDepth=3, subsamplingRate=0.85, featureSubsetStrategy="0.85")),
    ModelSpec("Random forest", "forest", "onehot", dict(numTrees=4, maxDepth=5, featureSubsetStrategy="all")),
]


def test_ensembles_comparison_and_importance(spark):
    """Predictions lie in the target's range and repeat; the squared error of the log price,
    which the fits minimise, is below the variance on the training rows."""
    from pricewise.operators.baseline import scalar_median
    c = Chain(spark, SF_SMALL)
    train, test = split_rows(c.frame, SALE_KEY)
    train, test = train.persist(), test.persist()
    median = scalar_median(train, "sellingprice", "m").first()["m"]
    models = fit_models(train, SMALL_SPECS)
    logs = F.log1p("sellingprice")
    lo, hi = train.agg(F.min("sellingprice"), F.max("sellingprice")).first()
    for m, again in zip(models, fit_models(train, SMALL_SPECS)):
        error, spread = m.transform(train).agg(F.avg((logs - F.log1p("prediction")) ** 2), F.var_pop(logs)).first()
        assert error < spread
        a = sorted(tuple(r) for r in m.transform(test).select(*SALE_KEY, "prediction").collect())
        assert all(lo * 0.99 <= r[-1] <= hi * 1.01 for r in a)
        b = sorted(tuple(r) for r in again.transform(test).select(*SALE_KEY, "prediction").collect())
        assert [r[-1] for r in a] == pytest.approx([r[-1] for r in b], rel=1e-9)
    rows = compare_models(test, models, median).collect()
    assert {r.model for r in rows} == {s.name for s in SMALL_SPECS} | {"Median baseline"}
    assert sorted(r.rank for r in rows if r.segment == "all") == [1, 2, 3, 4]
    assert {r.n for r in rows if r.segment == "all"} == {test.count()}
    imp = permutation_importance(models[0], test, SALE_KEY, FEATURE_COLUMNS, repeats=2).collect()
    assert {r.feature for r in imp} == set(FEATURE_COLUMNS)
    gain = impurity_importance(models[0], spark).agg(F.sum("importance")).first()[0]
    assert gain == pytest.approx(1.0)
    spark.catalog.clearCache()


def test_quote_chain_with_a_one_hot_model(spark):
    """The chain keeps every body, also rare ones, when the price model is one-hot."""
    from pricewise.operators.quote import quote
    c = Chain(spark, SF_SMALL)
    model = fit_models(c.frame, [REFERENCE_SPECS["ridge"]])[0]
    q = quote(c.vehicles(), model.transform, c.index, c.factors, c.cfg, factors_checked=True)
    base = quote(c.vehicles(), c.baseline.transform, c.index, c.factors, c.cfg, factors_checked=True)
    cols = [*SALE_KEY, "body", "seasonal_factor", "verdict"]
    assert sorted(tuple(r) for r in q.select(*cols).collect()) == \
        sorted(tuple(r) for r in base.select(*cols).collect())
    spark.catalog.clearCache()


def test_existing_session_keeps_its_partitions(spark):
    from pricewise.session import get_session
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        assert get_session("local[4]").conf.get("spark.sql.shuffle.partitions") == "16"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_sale_time_letter_case_and_short_parts(spark):
    texts = ["tue dec 6 2014 9:5:3 GMT-0800 (PST)", "TUE DEC 06 2014 09:05:03 GMT-0800", "Xue Dec 6 2014 09:05:03 GMT-0800"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    got = [r.t for r in df.select("i", utc_text(parse_sale_time(F.col("x"))).alias("t")).orderBy("i").collect()]
    assert got == ["2014-12-06 17:05:03+0000", "2014-12-06 17:05:03+0000", None]


def test_align_month_held_twice(spark):
    s = spark.createDataFrame([("p", "2015-01", 9.0, 1), ("p", "2015-01", 1.0, 2), ("q", "2015-01", 5.0, 1)],
                              "series string, year_month string, value double, at int")
    assert [tuple(r) for r in align(s, ["p", "q"], order_col="at").collect()] == [("2015-01", 1.0, 5.0)]
    with pytest.raises(Exception, match="holds a month twice"):
        align(s, ["p", "q"]).collect()


def test_unfinished_factor_table_is_built_again(spark, tmp_path):
    path = str(tmp_path / "factors")
    c = Chain(spark, SF_SMALL)
    c.factors.write.parquet(path)
    (tmp_path / "factors" / "_SUCCESS").unlink()
    built = []
    again = load_or_build_factors(spark, path, lambda: built.append(1) or c.factors)
    from pricewise.sources import snapshots
    folder = tmp_path / "factors" / snapshots.manifest(spark, path)["snapshot"]
    assert built and (folder / "_SUCCESS").exists()
    rows = [(r["body"], r["sale_month"]) for r in again.collect()]
    assert sorted(rows) == sorted((r["body"], r["sale_month"]) for r in c.factors.collect())
    names = sorted(p.name for p in folder.glob("part-*"))
    stored = [(r["body"], r["sale_month"]) for n in names
              for r in spark.read.parquet(f"{folder}/{n}").collect()]
    assert stored == sorted(stored)
    spark.catalog.clearCache()


def test_series_files_with_other_errors_are_not_skipped(spark, tmp_path):
    (tmp_path / "one.csv").write_text("observation_date\n2015-01-01\n")
    long, skipped = read_series_csv(spark, {"one": str(tmp_path / "one.csv")})
    assert long is None and skipped == ["one"]
    with pytest.raises(Exception):
        read_series_csv(spark, {"x": "nosuchscheme://a/b.csv"})
