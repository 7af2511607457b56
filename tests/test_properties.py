"""Properties that must hold on any input, plans, and a golden projection."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pricewise.config import FORWARD_PROJECTION_MONTHS
from pricewise.operators.baseline import scalar_median
from pricewise.operators.index import asof_lookup, base_ratio
from pricewise.operators.median import grouped_median
from pricewise.operators.seasonality import seasonality_factors
from pricewise.operators.split import seeded_sample
from pricewise.plans.context import Chain
from pricewise.plans.fixtures import SALE_KEY
from pricewise.plans.queries import REGISTRY


def test_median_of_hot_groups_ties_and_nulls(spark):
    rnd = random.Random(7)
    data = []
    for g, n in [("hot", 3001), ("even", 40), ("one", 1), ("two", 2), (None, 4)]:
        data += [(g, rnd.choice([None, "x"]), float(rnd.randint(0, 50)) / 7.0) for _ in range(n)]
    data += [("ties", "x", 2.0)] * 5000 + [("ties", "x", 1.0)] * 4999 + [(None, None, 1.0), (None, None, 3.0)]
    data += [("nulls", "x", None), ("nulls", "x", 3.0), ("none", "x", None)]
    want = {}
    for g, h, v in data:
        want.setdefault((g, h), []).append(v)
    want = {k: (statistics.median(x for x in v if x is not None) if any(x is not None for x in v) else None, len(v))
            for k, v in want.items()}
    df = spark.createDataFrame(data, "g string, h string, v double")
    for parts in (1, 3, 7):
        got = {(r["g"], r["h"]): (r["median"], r["n"])
               for r in grouped_median(df, ["g", "h"], "v", partitions=parts).collect()}
        assert got.keys() == want.keys()
        for k, (m, n) in want.items():
            assert got[k][1] == n
            assert got[k][0] == (m if m is None else pytest.approx(m, rel=1e-15))
    assert grouped_median(df.limit(0), ["g"], "v").count() == 0
    spark.catalog.clearCache()


def test_factors_invariant_to_partitions(spark):
    c = Chain(spark, SF_SMALL)
    rows = c.rows
    a = sorted(tuple(r) for r in seasonality_factors(rows).collect())
    b = sorted(tuple(r) for r in seasonality_factors(rows.repartition(7)).collect())
    assert a == b
    spark.catalog.clearCache()


def test_factor_table_shape(spark):
    f = REGISTRY["seasonality_factors"](spark, SF_SMALL)
    per = f.groupBy("body").count().collect()
    assert all(r["count"] == 12 for r in per)
    assert f.where((F.col("seasonal_factor") < 0.85) | (F.col("seasonal_factor") > 1.15)).count() == 0
    assert f.where((F.col("confidence") == "no_data") & (F.col("seasonal_factor") != 1.0)).count() == 0
    spark.catalog.clearCache()


def test_joins_keep_row_count(spark):
    c = Chain(spark, SF_SMALL)
    n = c.sales.count()
    assert REGISTRY["index_asof"](spark, SF_SMALL).count() == n
    assert REGISTRY["enrich_left"](spark, SF_SMALL).count() == n
    assert REGISTRY["seasonality_lookup"](spark, SF_SMALL).count() == n
    spark.catalog.clearCache()


def test_sample_size_exact_and_stable(spark):
    c = Chain(spark, SF_SMALL)
    a = seeded_sample(c.frame, 500, SALE_KEY, 42)
    b = seeded_sample(c.frame.repartition(5), 500, SALE_KEY, 42)
    assert a.count() == 500
    assert sorted(map(tuple, a.select(*SALE_KEY).collect())) == \
        sorted(map(tuple, b.select(*SALE_KEY).collect()))
    assert seeded_sample(c.frame, 10 ** 9, SALE_KEY).count() == c.frame.count()
    spark.catalog.clearCache()


def test_scalar_median(spark):
    df = spark.createDataFrame([(float(i),) for i in [5, 1, 9, 3, 7, 2]], "v double")
    for parts in (1, 4):
        assert scalar_median(df, "v", "m", parts).first()["m"] == 4.0
    assert scalar_median(df.limit(0), "v").first() is None


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_plans_broadcast_and_stay_in_jvm(spark):
    for name in ("quote_chain", "index_asof", "seasonality_lookup"):
        df = REGISTRY[name](spark, SF_SMALL)
        df.write.format("noop").mode("overwrite").save()
        plan = _plan(df)
        assert "BroadcastHashJoin" in plan, name
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
    spark.catalog.clearCache()


def test_bounds_filter_pushed_to_scan(spark):
    from pricewise.config import TEST_BOUNDS
    from pricewise.operators.features import apply_bounds
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select(
        F.col("l_extendedprice").alias("sellingprice"), (F.col("l_quantity") * 1000).alias("odometer"))
    df = apply_bounds(li, TEST_BOUNDS.__class__(price=(5_000, 100_000), odometer=None, age=None))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_extendedprice), GreaterThanOrEqual(l_extendedprice,5000.0)" in plan


# Published index rows (cpi_used_cars of 2015 and of the
# projection months) and the published projection for a base price of 12,716.52
CPI_2015 = [146.104, 146.316, 146.672, 147.024, 147.327, 147.489,
            147.462, 147.41, 147.611, 147.481, 147.466, 147.272]
CPI_PROJECTION = {"2016-01": 146.706, "2017-01": 148.166, "2018-01": 147.787, "2019-01": 147.792,
                  "2020-01": 147.877, "2020-06": 146.449, "2021-01": 149.944, "2021-06": 154.225,
                  "2021-12": 167.676, "2022-01": 168.179, "2022-06": 171.871, "2022-12": 177.501,
                  "2023-01": 177.861, "2023-09": 179.508, "2024-01": 179.147, "2025-01": 178.538,
                  "2026-01": 179.2, "2026-04": 179.174}
PUBLISHED = {  # year_month: (multiplier, stage2 price, delta %)
    "2015-01": (0.993, 12627.0, -0.7), "2016-01": (0.9971, 12679.0, -0.3),
    "2017-01": (1.007, 12806.0, 0.7), "2018-01": (1.0044, 12773.0, 0.4),
    "2019-01": (1.0045, 12773.0, 0.4), "2020-01": (1.005, 12781.0, 0.5),
    "2020-06": (0.9953, 12657.0, -0.5), "2021-01": (1.0191, 12959.0, 1.9),
    "2021-06": (1.0482, 13329.0, 4.8), "2021-12": (1.1396, 14492.0, 14.0),
    "2022-01": (1.143, 14535.0, 14.3), "2022-06": (1.1681, 14854.0, 16.8),
    "2022-12": (1.2064, 15341.0, 20.6), "2023-01": (1.2088, 15372.0, 20.9),
    "2023-09": (1.22, 15514.0, 22.0), "2024-01": (1.2176, 15483.0, 21.8),
    "2025-01": (1.2134, 15430.0, 21.3), "2026-01": (1.2179, 15488.0, 21.8),
    "2026-06": (1.2177, 15485.0, 21.8),
}
BASE_PRICE = 12716.52


def test_golden_projection(spark):
    rows = [(f"2015-{m:02d}", v) for m, v in enumerate(CPI_2015, 1)] + list(CPI_PROJECTION.items())
    idx = base_ratio(spark.createDataFrame(rows, "year_month string, cpi double"), "cpi", 2015)
    months = spark.createDataFrame([(m,) for m in FORWARD_PROJECTION_MONTHS], "year_month string")
    p = asof_lookup(months.withColumn("base", F.lit(BASE_PRICE)), idx, ["cpi_multiplier"])
    got = {r["year_month"]: (r["m"], r["p"], r["d"], r["resolved_month"]) for r in p.select(
        "year_month", "resolved_month", F.round("cpi_multiplier", 4).alias("m"),
        F.round(F.col("base") * F.col("cpi_multiplier"), 0).alias("p"),
        F.round((F.col("cpi_multiplier") - 1) * 100, 1).alias("d")).collect()}
    for ym, (m, price, d) in PUBLISHED.items():
        assert got[ym][:3] == (m, price, d), ym
    assert got["2026-06"][3] == "2026-04"   # carried forward


def test_quote_chain_independent_of_partition_count(spark):
    cols = [*SALE_KEY, "final_price", "seasonal_factor", "verdict", "resolved_month"]
    got = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got.append(sorted(map(tuple, REGISTRY["quote_chain"](spark, SF_SMALL).select(*cols).collect())))
            spark.catalog.clearCache()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got[0] == got[1]


def test_shuffle_join_fallback_gives_the_same_quotes(spark, monkeypatch):
    """With every size check failing and auto-broadcast off, all lookups run
    as shuffle joins and still produce the same quotes."""
    from pricewise.operators import dims
    cols = [*SALE_KEY, "final_price", "seasonal_factor", "verdict"]
    want = sorted(map(tuple, REGISTRY["quote_chain"](spark, SF_SMALL).select(*cols).collect()))
    spark.catalog.clearCache()
    monkeypatch.setattr(dims, "DEFAULT_MAX_BROADCAST_ROWS", 0)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = REGISTRY["quote_chain"](spark, SF_SMALL)
        got = sorted(map(tuple, df.select(*cols).collect()))
        plan = _plan(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.catalog.clearCache()
    assert got == want
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
