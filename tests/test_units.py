"""Inline edge cases the driver tables do not contain."""

import pytest
from pyspark.sql import functions as F

from pricewise.config import RAW_SALE_COLUMNS, SeasonalityConfig
from pricewise.functions.dates import parse_sale_time, utc_text
from pricewise.functions.labels import verdict
from pricewise.functions.numeric import coerce_number, safe_int
from pricewise.functions.text import normalize_category
from pricewise.operators.clean import clean_sales, repair_records
from pricewise.operators.encoders import level_counts
from pricewise.operators.features import require_columns
from pricewise.operators.index import asof_lookup, base_ratio, strict_lookup
from pricewise.operators.metrics import segment_metrics
from pricewise.operators.seasonality import lookup_factors, seasonality_factors


def one_col(spark, values, name="x", typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {typ}")


def line(fields):
    return ",".join(fields)


BASE = ["2012", "Kia", "Sorento", "LX", "SUV", "automatic", "vin1", "ca", "4.5", "16639", "white",
        "black", "dealer", "20500", "21500", "Tue Dec 16 2014 12:30:00 GMT-0800 (PST)"]


def test_record_repair_field_counts(spark):
    rows = [
        ("ok", line(BASE)),
        ("comma", line(BASE[:3] + ["LX", " Premium"] + BASE[4:])),
        ("quoted", line(BASE[:3] + ['"LX, Premium"'] + BASE[4:])),
        ("short", line(BASE[:-1])),
        ("long", line(BASE[:3] + ["a", "b", "c"] + BASE[4:])),
        ("trailing_empty", line(BASE[:-1] + [""])),
    ]
    df = spark.createDataFrame(rows, "line_id string, line string")
    out = {r["line_id"]: r for r in repair_records(df).collect()}
    assert out["ok"]["status"] == "ok" and out["ok"]["trim"] == "LX"
    assert out["comma"]["status"] == "repaired" and out["comma"]["trim"] == "LX, Premium"
    assert out["comma"]["body"] == "SUV" and out["comma"]["saledate"] == BASE[-1]
    assert out["quoted"]["status"] == "ok" and out["quoted"]["trim"] == "LX, Premium"
    assert out["short"]["status"] == "bad" and out["short"]["n_fields"] == 15
    assert out["long"]["status"] == "bad" and out["long"]["n_fields"] == 18
    assert out["trailing_empty"]["status"] == "ok" and out["trailing_empty"]["saledate"] == ""
    with pytest.raises(Exception, match="fields, 16 are needed"):
        repair_records(df, mode="strict").collect()


def test_numeric_coercion(spark):
    vals = ["12", " 12 ", "1e3", "abc", "", "nan", "inf", "1d", None]
    got = [r[0] for r in one_col(spark, vals).select(coerce_number(F.col("x"))).collect()]
    assert got == [12.0, 12.0, 1000.0, None, None, None, None, None, None]


def test_category_normalisation(spark):
    vals = [" Sedan\t", "Navitgation  System", "   ", None, "  Two   Words "]
    got = [r[0] for r in one_col(spark, vals).select(normalize_category(F.col("x"))).collect()]
    assert got == ["sedan", "navigation system", None, None, "two words"]


def test_sale_time_parse(spark):
    vals = ["Tue Dec 16 2014 12:30:00 GMT-0800 (PST)",
            "Tue Dec 16 2014 12:30:00 GMT-0800",
            "Tue Dec 16 2014 12:30:00 GMT-0800 (pst)",
            "junk",
            "Wed Dec 31 2014 20:00:00 GMT-0800 (PST)",
            "Xyz Dec 16 2014 12:30:00 GMT-0800 (PST)",
            "Mon Dec 16 2014 12:30:00 GMT-0800 (PST)"]   # wrong but valid weekday name
    got = [r[0] for r in one_col(spark, vals).select(utc_text(parse_sale_time(F.col("x")))).collect()]
    assert got == ["2014-12-16 20:30:00+0000", "2014-12-16 20:30:00+0000", None, None,
                   "2015-01-01 04:00:00+0000", None, "2014-12-16 20:30:00+0000"]


def test_safe_int(spark):
    df = one_col(spark, [3.0, None], typ="double")
    assert [r[0] for r in df.select(safe_int(F.col("x"))).collect()] == [3, None]
    with pytest.raises(Exception, match="non-integer"):
        one_col(spark, [3.5], typ="double").select(safe_int(F.col("x"))).collect()


def test_clean_sales_drops_missing_price_and_fills_transmission(spark):
    rec = dict(zip(RAW_SALE_COLUMNS, BASE))
    bad_price = dict(rec, sellingprice="n/a")
    no_trans = dict(rec, transmission="  ")
    df = spark.createDataFrame([rec, bad_price, no_trans])
    out = clean_sales(df.select(*RAW_SALE_COLUMNS)).collect()
    assert len(out) == 2
    assert sorted(r["transmission"] for r in out) == ["automatic", "unknown"]
    assert out[0]["sellingprice"] == 21500 and out[0]["make"] == "kia"


def test_segments_inclusive_both_ends(spark):
    prices = [500.0] * 10 + [5000.0] * 10 + [150000.0] * 10 + [499.99] * 10 + [20000.5] * 9
    df = spark.createDataFrame([(p, p) for p in prices], "sellingprice double, prediction double")
    seg = {r["segment"]: r["n"] for r in segment_metrics(df).collect()}
    # 5,000 counts in Budget and Economy; 499.99 in none; the group of 9 is dropped
    assert seg == {"Budget": 20, "Economy": 10, "Luxury": 10}


def test_asof_cases(spark):
    idx = spark.createDataFrame([("2020-02", 1.0), ("2020-03", 1.1), ("2020-06", 1.3)],
                                "year_month string, cpi_multiplier double")
    facts = spark.createDataFrame([("2020-03",), ("2020-05",), ("2019-12",), ("2021-01",), (None,)],
                                  "year_month string")
    got = {r["year_month"]: (r["resolved_month"], r["cpi_multiplier"])
           for r in asof_lookup(facts, idx, ["cpi_multiplier"]).collect()}
    assert got == {"2020-03": ("2020-03", 1.1), "2020-05": ("2020-03", 1.1),
                   "2019-12": ("2020-02", 1.0), "2021-01": ("2020-06", 1.3), None: (None, None)}


def test_base_ratio_requires_base_year(spark):
    idx = spark.createDataFrame([("2020-02", 2.0)], "year_month string, price double")
    with pytest.raises(Exception, match="base year 1998"):
        base_ratio(idx, "price", 1998).collect()


def test_strict_lookup_lists_missing_months(spark):
    idx = spark.createDataFrame([("2020-02", 1.0)], "year_month string, cpi_multiplier double")
    facts = spark.createDataFrame([("2020-04",), ("2020-02",), ("2020-03",), ("2020-04",)],
                                  "year_month string")
    with pytest.raises(ValueError, match="2020-03, 2020-04$"):
        strict_lookup(facts, idx)


def _rows(spark, spec):
    """spec: list of (body, month, ratio, count)."""
    data = []
    for body, month, ratio, n in spec:
        data += [(body, month, ratio)] * n
    return spark.createDataFrame(data, "body string, sale_month bigint, price_ratio double")


def test_factor_rules(spark):
    cfg = SeasonalityConfig()
    rows = _rows(spark, [("a", 1, 1.0, 1000), ("a", 2, 2.0, 999), ("a", 3, 1.0, 100),
                         ("a", 4, 1.0, 99), ("b", 5, 1.0, 3), ("c", 1, 1.0, 150), ("c", 2, 1.0, 150)])
    f = {(r["body"], r["sale_month"]): r for r in seasonality_factors(rows, cfg).collect()}
    assert len(f) == 36
    assert [f[("a", m)]["confidence"] for m in (1, 2, 3, 4, 5)] == ["high", "medium", "medium", "low",
                                                                  "no_data"]
    assert f[("a", 5)]["seasonal_factor"] == 1.0 and not f[("a", 5)]["is_observed"]
    # raw factor 2 / 1 = 2 is shrunk by 999 / 1999 then clipped to 1.15
    assert f[("a", 2)]["seasonal_factor"] == 1.15 and f[("a", 2)]["best_month"] == 2
    # body with one observed month: no recommendation, best = worst = that month
    assert f[("b", 1)]["has_recommendation"] is False and f[("b", 1)]["best_month"] == 5
    # tie between months -> smallest month for both best and worst
    assert f[("c", 1)]["best_month"] == 1 and f[("c", 1)]["worst_month"] == 1
    assert f[("c", 1)]["has_recommendation"] is True
    for r in f.values():
        assert 0.85 <= r["seasonal_factor"] <= 1.15


def test_lookup_defaults_and_month_check(spark):
    fac = seasonality_factors(_rows(spark, [("sedan", 3, 1.0, 200)]))
    facts = spark.createDataFrame([(" SEDAN ", 3), ("wagon", 3)], "body string, sale_month bigint")
    got = {r["body"]: r for r in lookup_factors(facts, fac).collect()}
    assert got[" SEDAN "]["sf_observations"] == 200
    assert got["wagon"]["sf_confidence"] == "no_data" and got["wagon"]["sf_seasonal_factor"] == 1.0
    assert got["wagon"]["sf_best_month"] == 3
    bad = spark.createDataFrame([("sedan", 13)], "body string, sale_month bigint")
    with pytest.raises(Exception, match="1 to 12 expected"):
        lookup_factors(bad, fac).collect()


def test_rare_levels(spark):
    df = spark.createDataFrame([("x",)] * 49 + [("y",)] * 50, "make string")
    got = {r["level"]: r["is_rare"] for r in level_counts(df, ["make"]).collect()}
    assert got == {"x": True, "y": False}


def test_verdict_thresholds(spark):
    df = spark.createDataFrame([(10, 2.0), (10, 2.0001), (10, -2.0), (10, -2.5), (0, 5.0)],
                               "n bigint, d double")
    got = [r[0] for r in df.select(verdict(F.col("n"), F.col("d"))).collect()]
    assert got == ["average", "strong", "average", "weak", "no_data"]


def test_required_columns_sorted():
    class D:
        columns = ["b"]
    with pytest.raises(ValueError, match="no column a, c"):
        require_columns(D(), ["c", "a", "b"])


def test_strict_lookup_fail_fast_and_keep(spark):
    idx = spark.createDataFrame([("2020-02", 1.0)], "year_month string, cpi_multiplier double")
    facts = spark.createDataFrame([("2020-02",), ("2020-03",)], "year_month string")
    kept = {r["year_month"]: r["cpi_multiplier"] for r in strict_lookup(facts, idx, on_missing="keep").collect()}
    assert kept == {"2020-02": 1.0, "2020-03": None}
    with pytest.raises(Exception, match="no index value for month 2020-03"):
        strict_lookup(facts, idx, on_missing="fail_fast").collect()


def test_approx_median_returns_an_element(spark):
    from pricewise.operators.median import grouped_median
    df = spark.createDataFrame([("a", float(v)) for v in [1, 2, 3, 4]], "g string, v double")
    exact = grouped_median(df, ["g"], "v").first()["median"]
    approx = grouped_median(df, ["g"], "v", accuracy=10_000).first()["median"]
    assert exact == 2.5 and approx in (2.0, 3.0)


def test_loose_bounds_variant(spark):
    from pricewise.config import LOOSE_BOUNDS
    from pricewise.operators.features import apply_bounds
    df = spark.createDataFrame([(1000.0, 0, 40), (1000.0, 600_000, 1), (400.0, 10, 1)],
                               "sellingprice double, odometer bigint, vehicle_age bigint")
    # price range and odometer <= 500,000 only: odometer 0 and age 40 are kept
    assert apply_bounds(df, LOOSE_BOUNDS).count() == 1
