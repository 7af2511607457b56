"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver tables (or what Spark derives from them) in
full. Computed columns are aliased to the names used by the SQL oracle.
Doubles whose last bits depend on summation order are rounded to 6 decimals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricewise.config import (FEATURE_COLUMNS, FORWARD_PROJECTION_MONTHS, PREDICTION_FLOOR,
                              DEFAULT_BOUNDS, LOOSE_BOUNDS, RANDOM_STATE, RAW_SALE_COLUMNS, SEGMENT_MIN_ROWS)
from pricewise.functions.dates import parse_sale_time, utc_text, year_month
from pricewise.functions.numeric import coerce_number, r6, safe_int
from pricewise.functions.text import normalize_category, normalize_key
from pricewise.operators.baseline import fit_group_baseline, fit_group_baselines, median_baseline, scalar_median
from pricewise.operators.clean import accounting, clean_sales, repair_records
from pricewise.operators.dims import checked_broadcast, written
from pricewise.operators.encoders import level_counts, ordinal_codes, scaling_stats
from pricewise.operators.evaluation import (body_summary, catalogue, holdout_evaluation,
                                            listed_that_exist, models_for, unobserved_cells)
from pricewise.operators.features import (FEATURE_INPUT, apply_bounds, at_reference_point, feature_rows,
                                          modeling_frame, restore_point, unclipped_age)
from pricewise.operators.index import (align, asof_lookup, base_ratio, build_index, enrich, forward_fill,
                                       missing_months, monthly_last, read_series_csv, snapshot)
from pricewise.operators.metrics import (metric_columns, regression_metrics, segment_metrics,
                                         segments_column)
from pricewise.operators.models import (RAW_SPEC, REFERENCE_SPECS, ModelSpec, PriceModel, coefficients, first_split,
                                        fit_model, fit_models, impurity_importance, level_stump,
                                        numeric_coefficients, permutation_importance)
from pricewise.operators.quote import quote
from pricewise.operators.seasonality import backfill_factor_columns, lookup_factors
from pricewise.operators.split import bucket, is_test, key_text, seeded_sample, split
from pricewise.plans.context import KEYED_COLUMNS, RATIO_COLUMNS, Chain
from pricewise.plans.fixtures import (INDEX_BASE_YEAR, INDEX_SERIES, SALE_KEY, gappy_price_index,
                                      price_series, sale_view, series_long,
                                      sparse_sale_view)
from pricewise.sources.records import read_records
from pricewise.sources.sinks import scratch_path, write_table
from pricewise.sources.tables import fingerprint, read_table

REGISTRY: dict = {}


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


# ------------------------------------------------------------------ flagship
@register("quote_chain")
def q_quote_chain(spark: SparkSession, sf: str) -> DataFrame:
    c = Chain(spark, sf, persist_sales=True)
    q = quote(c.vehicles(), c.baseline.transform, c.index, c.factors, c.cfg, factors_checked=True)
    return q.select(
        *SALE_KEY, "body", "target_month", "year_month", "resolved_month", "is_carried",
        "vehicle_age", r6(F.col("stage1_price")).alias("stage1_price"),
        r6(F.col("cpi_multiplier")).alias("cpi_multiplier"),
        r6(F.col("stage2_price")).alias("stage2_price"), "seasonal_factor",
        r6(F.col("final_price")).alias("final_price"),
        r6(F.col("index_delta")).alias("index_delta"),
        r6(F.col("index_delta_pct")).alias("index_delta_pct"),
        r6(F.col("seasonal_delta")).alias("seasonal_delta"),
        r6(F.col("seasonal_delta_pct")).alias("seasonal_delta_pct"),
        "best_month_name", r6(F.col("best_gap_points")).alias("best_gap_points"),
        "verdict", "hint_month")


@register("seasonality_factors")
def q_seasonality_factors(spark: SparkSession, sf: str) -> DataFrame:
    return Chain(spark, sf, persist_sales=RATIO_COLUMNS).factors


# ------------------------------------------------------------------ sources, cleaning
def raw_records(spark: SparkSession, sf: str) -> DataFrame:
    """Raw 16-field sale records built from part rows and whole document texts.

    part: the trim field carries an unquoted comma (17 fields -> repaired),
    a quoted comma (16 fields) or none. documents: the whole text is the trim
    field, quoted with "" escapes for even ids, unquoted (newlines -> space)
    for odd ids, so texts with two or more commas are malformed records.
    """
    p = read_table(spark, sf, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size",
                                       "p_retailprice"])
    cents = F.round(F.col("p_retailprice") * 100).cast("bigint").cast("string")
    trim_p = (F.when(F.col("p_partkey") % 3 == 0, F.replace("p_name", F.lit(" "), F.lit(", ")))
              .when(F.col("p_partkey") % 3 == 1,
                    F.concat(F.lit('"'), F.replace("p_name", F.lit(" "), F.lit(", ")), F.lit('"')))
              .otherwise(F.col("p_name")))
    lp = p.select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("line_id"),
                  F.concat_ws(",", (F.lit(1990) + F.col("p_size") % 30).cast("string"), "p_brand",
                              "p_name", trim_p, "p_type", F.lit("automatic"),
                              F.concat(F.lit("vin"), F.col("p_partkey").cast("string")), F.lit("ca"),
                              (F.col("p_size") % 5 + 1).cast("string"),
                              (F.col("p_size") * 1000).cast("string"), F.lit("black"), F.lit("gray"),
                              F.lit("dealer"), cents, cents, F.lit(SAMPLE_SALE_TIME)).alias("line"))
    d = read_table(spark, sf, "documents", ["doc_id", "text", "lang", "source", "n_chars"])
    trim_d = F.when(F.col("doc_id") % 2 == 0,
                    F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))) \
        .otherwise(F.replace("text", F.lit("\n"), F.lit(" ")))
    ld = d.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("line_id"),
                  F.concat_ws(",", F.lit("2012"), "source", "lang", trim_d, F.lit("sedan"),
                              F.lit("automatic"), F.concat(F.lit("doc"), F.col("doc_id").cast("string")),
                              F.lit("ca"), F.lit("3"), F.col("n_chars").cast("string"), F.lit("black"),
                              F.lit("gray"), F.lit("dealer"), F.lit("10000"), F.lit("10000"),
                              F.lit(SAMPLE_SALE_TIME)).alias("line"))
    return lp.unionByName(ld)


SAMPLE_SALE_TIME = "Tue Dec 16 2014 12:30:00 GMT-0800 (PST)"


@register("record_repair")
def q_record_repair(spark: SparkSession, sf: str) -> DataFrame:
    r = repair_records(raw_records(spark, sf))
    return r.select("line_id", "n_fields", "status", "year", "make", "model", "trim", "body",
                    "vin", "sellingprice")


@register("raw_file_repair")
def q_raw_file_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Raw records written to text files and read back: quoted document texts run over many lines."""
    path = scratch_path(spark, "raw-files")
    header = ",".join(RAW_SALE_COLUMNS)
    lines = raw_records(spark, sf).select(F.col("line").alias("value"))
    lines.write.text(f"{path}/records")
    r = read_records(spark, f"{path}/records", header=False)
    spark.createDataFrame([(header,)], "value string").write.text(f"{path}/header")
    none = read_records(spark, f"{path}/header")        # a file with nothing but its header
    r = repair_records(r.unionByName(none), id_col="record_id")
    return r.select("n_fields", "status", "year", "make", "model", "trim", "body", "vin", "sellingprice")


@register("clean_sales")
def q_clean_sales(spark: SparkSession, sf: str) -> DataFrame:
    """The cleaning job: raw records -> repaired fields -> typed clean sales."""
    clean = clean_sales(repair_records(raw_records(spark, sf)))
    return clean.select("line_id", *[c for c in RAW_SALE_COLUMNS if c != "saledate"],
                        utc_text(F.col("saledate")).alias("saledate"))


@register("cleaning_accounting")
def q_cleaning_accounting(spark: SparkSession, sf: str) -> DataFrame:
    """Records read, written and removed by the cleaning job, in one scan."""
    kept = ((F.col("status") != "bad") & coerce_number(F.col("sellingprice")).isNotNull()
            & coerce_number(F.col("odometer")).isNotNull())
    return accounting(repair_records(raw_records(spark, sf)), kept)


@register("numeric_coercion")
def q_numeric_coercion(spark: SparkSession, sf: str) -> DataFrame:
    ev = read_table(spark, sf, "events", ["event_id", "props"]).select(
        F.lit("events").alias("source"), F.col("event_id").alias("id"),
        F.regexp_extract("props", r":(.*)\}", 1).alias("raw"))
    p = read_table(spark, sf, "part", ["p_partkey", "p_name", "p_brand", "p_size", "p_retailprice"])
    texts = F.array(F.col("p_retailprice").cast("string"),
                    F.concat(F.col("p_size").cast("string"), F.lit("d")),
                    F.regexp_extract("p_brand", "#(.*)", 1),
                    F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit("e1 ")))
    pt = p.select(F.lit("part").alias("source"), F.col("p_partkey").alias("id"),
                  F.explode(F.concat(F.split("p_name", " "), texts)).alias("raw"))
    u = ev.unionByName(pt)
    return u.select("source", "id", "raw", coerce_number(F.col("raw")).alias("value"))


@register("category_normalise")
def q_category_normalise(spark: SparkSession, sf: str) -> DataFrame:
    p = read_table(spark, sf, "part", ["p_partkey", "p_name", "p_brand"])
    k = F.col("p_partkey") % 4
    raw = (F.when(k == 0, F.concat(F.lit(" "), F.upper("p_name"), F.lit("\t")))
           .when(k == 1, F.concat(F.lit("\u00a0"), F.replace("p_name", F.lit(" "), F.lit("   "))))
           .when(k == 2, F.concat(F.lit("Navitgation  "), F.col("p_brand")))
           .otherwise(F.lit("   ")))
    a = p.select(F.lit("part").alias("source"), F.col("p_partkey").cast("string").alias("id"),
                 normalize_category(raw).alias("value"))
    d = read_table(spark, sf, "documents", ["doc_id", "source"])
    b = d.select(F.lit("documents").alias("source"), F.col("doc_id").cast("string").alias("id"),
                 normalize_category(F.concat(F.lit("\t"), F.upper("source"), F.lit("  "))).alias("value"))
    li = read_table(spark, sf, "lineitem", SALE_KEY + ["l_returnflag"])
    c = li.select(F.lit("transmission").alias("source"), key_text(SALE_KEY).alias("id"),
                  F.coalesce(normalize_category(F.nullif("l_returnflag", F.lit("N"))),
                             F.lit("unknown")).alias("value"))
    return a.unionByName(b).unionByName(c)


def sale_time_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Sale-time text in the raw format, made from ship dates and event times:
    varying hour, zone offset, suffix, and some invalid weekday names."""
    li = read_table(spark, sf, "lineitem", SALE_KEY + ["l_shipdate"])
    local = F.expr("timestampadd(HOUR, CAST(l_partkey % 24 AS INT), l_shipdate)")
    off = F.element_at(F.array(F.lit("-0800"), F.lit("+0100"), F.lit("-0500")),
                       (F.col("l_suppkey") % 3 + 1).cast("int"))
    suffix = F.element_at(F.array(F.lit(" (PST)"), F.lit(""), F.lit(" (pst)"), F.lit(" (EST)")),
                          (F.col("l_linenumber") % 4 + 1).cast("int"))
    wd = F.when(F.col("l_orderkey") % 50 == 0, F.lit("Xyz")).otherwise(F.date_format(local, "EEE"))
    a = li.select(key_text(SALE_KEY).alias("id"),
                  F.concat(wd, F.lit(" "), F.date_format(local, "MMM dd yyyy HH:mm:ss"), F.lit(" GMT"),
                           off, suffix).alias("text"))
    ev = read_table(spark, sf, "events", ["event_id", "ts"])
    off_e = F.element_at(F.array(F.lit("+0000"), F.lit("-0800"), F.lit("+0530")),
                         (F.col("event_id") % 3 + 1).cast("int"))
    b = ev.select(F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("id"),
                  F.concat(F.date_format("ts", "EEE MMM dd yyyy HH:mm:ss"), F.lit(" GMT"), off_e)
                  .alias("text"))
    return a.unionByName(b)


@register("sale_time_parse")
def q_sale_time_parse(spark: SparkSession, sf: str) -> DataFrame:
    t = sale_time_texts(spark, sf).select("id", parse_sale_time(F.col("text")).alias("ts"))
    return t.select("id", utc_text(F.col("ts")).alias("saledate_utc"),
                    F.year("ts").cast("bigint").alias("sale_year"),
                    F.month("ts").cast("bigint").alias("sale_month"),
                    year_month(F.col("ts")).alias("year_month"))


@register("integer_cast")
def q_integer_cast(spark: SparkSession, sf: str) -> DataFrame:
    li = read_table(spark, sf, "lineitem", SALE_KEY + ["l_quantity"])
    return li.select(*SALE_KEY, safe_int(F.col("l_quantity"), "quantity").alias("quantity"),
                     safe_int(F.col("l_quantity") * 1000, "odometer").alias("odometer"))


@register("clean_accounting")
def q_clean_accounting(spark: SparkSession, sf: str) -> DataFrame:
    s = sale_view(spark, sf)
    ok = F.lit(True)
    for c in FEATURE_INPUT:
        ok = ok & F.col(c).isNotNull()
    return accounting(s, ok)


@register("feature_rows")
def q_feature_rows(spark: SparkSession, sf: str) -> DataFrame:
    # the row key rides along so that rows stay distinguishable
    return feature_rows(sale_view(spark, sf), keep=SALE_KEY, integer_price=False)


@register("modeling_frame")
def q_modeling_frame(spark: SparkSession, sf: str) -> DataFrame:
    return modeling_frame(sale_view(spark, sf), DEFAULT_BOUNDS, key=SALE_KEY)


MODELING_SAMPLE_ROWS = 10_000       # of the sampling operator; a parameter of the original


@register("modeling_sample")
def q_modeling_sample(spark: SparkSession, sf: str) -> DataFrame:
    frame = modeling_frame(sale_view(spark, sf), DEFAULT_BOUNDS, key=SALE_KEY)
    return seeded_sample(frame, MODELING_SAMPLE_ROWS, SALE_KEY, RANDOM_STATE)


# ------------------------------------------------------------------ index
def orders_index(spark: SparkSession, sf: str) -> DataFrame:
    """Single-series index: monthly mean order price, 1998 = 1.0 on average."""
    return base_ratio(price_series(spark, sf), "price", INDEX_BASE_YEAR)


@register("index_last_value")
def q_index_last_value(spark: SparkSession, sf: str) -> DataFrame:
    ev = read_table(spark, sf, "events", ["event_id", "ts", "event_type", "value"])
    return monthly_last(ev.withColumnRenamed("event_type", "series"), date_col="ts",
                        tiebreak="event_id", period_format="yyyy-MM-dd HH", period_col="period")


EVENT_SERIES = ["click", "error", "purchase", "signup", "view"]


@register("index_from_events")
def q_index_from_events(spark: SparkSession, sf: str) -> DataFrame:
    """The whole index chain on hourly event values: last value per hour and type,
    alignment, forward fill, and the ratio of purchases to their mean in 2024."""
    ev = read_table(spark, sf, "events", ["event_id", "ts", "event_type", "value"])
    last = monthly_last(ev.withColumnRenamed("event_type", "series"), date_col="ts",
                        tiebreak="event_id", period_format="yyyy-MM-dd HH")
    idx = build_index(last, EVENT_SERIES, "purchase", 2024)
    return idx.select(F.col("year_month").alias("period"), *EVENT_SERIES,
                      r6(F.col("cpi_multiplier")).alias("multiplier"))


@register("index_align")
def q_index_align(spark: SparkSession, sf: str) -> DataFrame:
    wide = forward_fill(align(series_long(spark, sf), INDEX_SERIES), INDEX_SERIES)
    return wide.select("year_month", r6(F.col("price")).alias("price"),
                       r6(F.col("quantity")).alias("quantity"), "volume")


@register("index_base_ratio")
def q_index_base_ratio(spark: SparkSession, sf: str) -> DataFrame:
    idx = orders_index(spark, sf)
    return idx.select("year_month", r6(F.col("price")).alias("price"),
                      r6(F.col("cpi_multiplier")).alias("cpi_multiplier"))


@register("enrich_left")
def q_enrich_left(spark: SparkSession, sf: str) -> DataFrame:
    s = sale_view(spark, sf).select(*SALE_KEY, "year_month", "sellingprice")
    e = enrich(s, checked_broadcast(orders_index(spark, sf)))
    return e.select(*SALE_KEY, "year_month", r6(F.col("price")).alias("price"),
                    r6(F.col("cpi_multiplier")).alias("cpi_multiplier"))


@register("enrich_missing_audit")
def q_enrich_missing_audit(spark: SparkSession, sf: str) -> DataFrame:
    s = sale_view(spark, sf).select("year_month")
    m = missing_months(s, checked_broadcast(orders_index(spark, sf)))
    return m.select(F.col("rows_without_index").cast("bigint").alias("rows_without_index"),
                    F.array_join("missing_months", ",").alias("missing_months"))


@register("index_asof")
def q_index_asof(spark: SparkSession, sf: str) -> DataFrame:
    s = sale_view(spark, sf).select(*SALE_KEY, "year_month", "sellingprice")
    a = asof_lookup(s, gappy_price_index(spark, sf), ["cpi_multiplier"])
    return a.select(*SALE_KEY, "year_month", "resolved_month", "is_carried",
                    r6(F.col("cpi_multiplier")).alias("cpi_multiplier"),
                    r6(F.col("sellingprice") * F.col("cpi_multiplier")).alias("adjusted_price"))


@register("index_snapshot")
def q_index_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Index snapshot for every ship month; months after the index resolve to
    its last month. The multiplier is reported at 4 decimals; the price level
    (a mean of cent amounts, which can sit exactly on a 4-decimal tie) at 6."""
    months = read_table(spark, sf, "lineitem", ["l_shipdate"]).select(
        year_month(F.col("l_shipdate")).alias("year_month")).distinct()
    snap = asof_lookup(months, orders_index(spark, sf), ["price", "cpi_multiplier"])
    return snap.select("year_month", "resolved_month",
                       F.round("cpi_multiplier", 4).alias("cpi_multiplier"),
                       r6(F.col("price")).alias("price"))


@register("macro_snapshot")
def q_macro_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """All indicators at every ship month and two months outside the index; one indicator starts late."""
    late = series_long(spark, sf).where("series = 'volume' AND year_month >= '1996-01'").withColumn("series", F.lit("late"))
    names = INDEX_SERIES + ["late"]
    index = build_index(series_long(spark, sf).unionByName(late), names, "price", INDEX_BASE_YEAR)
    ship = read_table(spark, sf, "lineitem", ["l_shipdate"]).select(year_month(F.col("l_shipdate")).alias("year_month"))
    months = ship.distinct().unionByName(spark.createDataFrame([("1980-01",), ("2050-12",)], "year_month string"))
    snap = snapshot(months, index, ["quantity", "volume", "late", "cpi_multiplier"])
    return snap.select("year_month", "resolved_month", "quantity", "volume", "late", "cpi_multiplier")


@register("index_from_files")
def q_index_from_files(spark: SparkSession, sf: str) -> DataFrame:
    """The index chain from series files (the first day of each month), one of which does not exist."""
    path = scratch_path(spark, "series")
    for name in INDEX_SERIES:
        s = series_long(spark, sf).where(F.col("series") == name)
        s.select(F.concat("year_month", F.lit("-01")).alias("observation_date"), F.col("value").alias(name.upper())) \
            .write.option("header", True).csv(f"{path}/{name}")
    long, skipped = read_series_csv(spark, {**{n: f"{path}/{n}" for n in INDEX_SERIES}, "oil": f"{path}/oil"})
    index = build_index(monthly_last(long), INDEX_SERIES, "price", INDEX_BASE_YEAR)
    return index.select("year_month", r6(F.col("price")).alias("price"), r6(F.col("quantity")).alias("quantity"), "volume",
                        r6(F.col("cpi_multiplier")).alias("cpi_multiplier"), F.lit(",".join(skipped)).alias("skipped"))


def test_predictions(c: Chain) -> DataFrame:
    """Group-baseline (fitted on the training split) predictions for the test
    split of the modelling frame, at the reference month."""
    train, test = split(c.frame, SALE_KEY)
    model = fit_group_baseline(train)
    return restore_point(model.transform(at_reference_point(test, c.cfg)))


@register("index_projection")
def q_index_projection(spark: SparkSession, sf: str) -> DataFrame:
    c = Chain(spark, sf)
    base = scalar_median(test_predictions(c), "prediction", "m").first()["m"]
    ship = read_table(spark, sf, "lineitem", ["l_shipdate"]).select(
        year_month(F.col("l_shipdate")).alias("year_month")).distinct()
    fixed = spark.range(len(FORWARD_PROJECTION_MONTHS)).select(
        F.element_at(F.array(*[F.lit(m) for m in FORWARD_PROJECTION_MONTHS]),
                     (F.col("id") + 1).cast("int")).alias("year_month"))
    scenario = ship.union(fixed).distinct().withColumn("stage1_baseline", F.lit(base).cast("double"))
    p = asof_lookup(scenario, orders_index(spark, sf), ["cpi_multiplier"])
    return p.select("year_month", "resolved_month",
                    F.round("cpi_multiplier", 4).alias("cpi_multiplier"),
                    F.round("stage1_baseline", 0).alias("stage1_baseline"),
                    F.round(F.col("stage1_baseline") * F.col("cpi_multiplier"), 0).alias("stage2_price"),
                    F.round((F.col("cpi_multiplier") - 1.0) * 100, 1).alias("delta_pct"))


# Report precision of the original metrics: money errors and percentages at
# 2 decimals, R² at 4; other doubles at 6 (sums whose last bits depend on order).
_REPORT_2 = ("mae", "rmse", "mape_percent", "mae_relative_percent", "mae_change",
             "mae_change_percent")


def _r6_all(df: DataFrame) -> DataFrame:
    def fmt(c: str):
        base = c.split("_", 1)[1] if c.startswith(("stage1_", "stage2_")) else c
        if base in _REPORT_2 or base in ("baseline_mae", "stage3_mae"):
            return F.round(F.col(c), 2).alias(c)
        if base == "r2":
            return F.round(F.col(c), 4).alias(c)
        return r6(F.col(c)).alias(c)
    return df.select(*[fmt(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@register("index_backtest")
def q_index_backtest(spark: SparkSession, sf: str) -> DataFrame:
    c = Chain(spark, sf)
    scored = test_predictions(c)
    median = scalar_median(scored, "prediction", "m").first()
    t = asof_lookup(scored, c.index, ["cpi_multiplier"])
    t = t.withColumn("stage2", F.col("prediction") * F.col("cpi_multiplier"))
    m1 = metric_columns("sellingprice", "prediction")
    m2 = metric_columns("sellingprice", "stage2")
    out = t.agg(F.count(F.lit(1)).alias("test_rows"),
                *[x.alias("stage1_" + n) for x, n in zip(m1, ["mae", "rmse", "r2", "mape_percent"])],
                *[x.alias("stage2_" + n) for x, n in zip(m2, ["mae", "rmse", "r2", "mape_percent"])],
                F.min("cpi_multiplier").alias("multiplier_min"),
                F.max("cpi_multiplier").alias("multiplier_max"),
                F.avg("cpi_multiplier").alias("multiplier_mean"),
                F.lit(median["m"] if median else None).cast("double").alias("stage1_median"))
    return _r6_all(out)


# ------------------------------------------------------------------ split, baselines, metrics
@register("split_holdout")
def q_split_holdout(spark: SparkSession, sf: str) -> DataFrame:
    li = read_table(spark, sf, "lineitem", SALE_KEY)
    return li.select(*SALE_KEY, bucket(SALE_KEY).alias("bucket"), is_test(SALE_KEY).alias("is_test"))


@register("group_baseline")
def q_group_baseline(spark: SparkSession, sf: str) -> DataFrame:
    c = Chain(spark, sf)
    p = c.baseline.transform(c.frame)
    floored = F.greatest(F.col("prediction"), F.lit(PREDICTION_FLOOR))
    return p.select(*SALE_KEY, "make", "body", r6(F.col("prediction")).alias("prediction"),
                    r6(floored).alias("floored_prediction"),
                    r6(F.col("sellingprice") / floored).alias("price_ratio"))


@register("median_baseline")
def q_median_baseline(spark: SparkSession, sf: str) -> DataFrame:
    c = Chain(spark, sf)
    train, test = split(c.frame, SALE_KEY)
    scored = median_baseline(train, test)
    return _r6_all(regression_metrics(scored, extended=True))


@register("regression_metrics")
def q_regression_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _r6_all(regression_metrics(test_predictions(Chain(spark, sf)), extended=True))


@register("segment_metrics")
def q_segment_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _r6_all(segment_metrics(test_predictions(Chain(spark, sf))))


# ------------------------------------------------------------------ seasonality
@register("seasonality_rows")
def q_seasonality_rows(spark: SparkSession, sf: str) -> DataFrame:
    r = Chain(spark, sf, persist_sales=KEYED_COLUMNS).rows
    return r.select(*SALE_KEY, "body", "sale_month", "year_month",
                    *[r6(F.col(x)).alias(x) for x in ("normalized_price", "reference_prediction",
                                                      "price_ratio")])


@register("seasonality_backfill")
def q_seasonality_backfill(spark: SparkSession, sf: str) -> DataFrame:
    """Factor table stored without the two recommendation columns, read back
    and completed."""
    fac = Chain(spark, sf, persist_sales=RATIO_COLUMNS).factors.drop("recommendation_eligible_months", "has_recommendation")
    path = scratch_path(spark, "factors")
    write_table(fac, path, order_by=["body", "sale_month"])
    back = backfill_factor_columns(spark.read.parquet(path))
    return back.select("body", "sale_month", "observations", "recommendation_eligible_months",
                       "has_recommendation")


@register("seasonality_lookup")
def q_seasonality_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Every sale looked up by (body as typed, sale month); line 7 rows carry
    an unseen body, others padded capitals."""
    c = Chain(spark, sf, persist_sales=KEYED_COLUMNS)
    s = c.sales.select(*SALE_KEY, "sale_month", "sellingprice",
                       F.when(F.col("l_linenumber") == 7, F.lit("Wagon"))
                       .otherwise(F.concat(F.lit(" "), F.upper("body"), F.lit(" "))).alias("body_input"))
    j = lookup_factors(s, c.factors, "body_input", "sale_month", size_checked=True)
    return j.select(*SALE_KEY, "sale_month", F.col("sf_seasonal_factor").alias("seasonal_factor"),
                    F.col("sf_confidence").alias("confidence"),
                    F.col("sf_observations").alias("observations"),
                    F.col("sf_best_month").alias("best_month"),
                    F.col("sf_worst_month").alias("worst_month"),
                    r6(F.col("sellingprice") * F.col("sf_seasonal_factor")).alias("adjusted_price"))


@register("seasonality_holdout")
def q_seasonality_holdout(spark: SparkSession, sf: str) -> DataFrame:
    c = Chain(spark, sf, persist_sales=KEYED_COLUMNS)
    return _r6_all(holdout_evaluation(c.written_rows, SALE_KEY, c.cfg))


@register("seasonality_summary")
def q_seasonality_summary(spark: SparkSession, sf: str) -> DataFrame:
    return body_summary(Chain(spark, sf, persist_sales=RATIO_COLUMNS).factors, top_n=12)


# Bodies shown as examples in the seasonal report (a display parameter)
EXAMPLE_BODIES = ["compact", "coupe", "large", "suv"]


@register("example_bodies")
def q_example_bodies(spark: SparkSession, sf: str) -> DataFrame:
    f = listed_that_exist(Chain(spark, sf, persist_sales=RATIO_COLUMNS).factors, EXAMPLE_BODIES)
    return f.select("body", "sale_month", "month_name", "seasonal_factor", "seasonal_delta_pct",
                    "observations", "confidence")


@register("seasonality_factors_sparse")
def q_seasonality_factors_sparse(spark: SparkSession, sf: str) -> DataFrame:
    """The factor table where some months have no sale and one body few."""
    c = Chain(spark, sf)
    c._cache["sales"] = written(sparse_sale_view(spark, sf).select(*RATIO_COLUMNS), "sparse-sales")
    return c.factors


OUT_OF_FOLD = 5


@register("seasonality_factors_out_of_fold")
def q_seasonality_factors_out_of_fold(spark: SparkSession, sf: str) -> DataFrame:
    """The factor table from predictions of models that never saw the row they score."""
    c = Chain(spark, sf, persist_sales=KEYED_COLUMNS)
    c._cache["baseline"] = fit_group_baselines(c.frame, SALE_KEY, OUT_OF_FOLD)
    return c.factors


@register("unobserved_months")
def q_unobserved_months(spark: SparkSession, sf: str) -> DataFrame:
    return unobserved_cells(sparse_sale_view(spark, sf))


@register("catalogue")
def q_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    p = read_table(spark, sf, "part", ["p_brand", "p_name"])
    return catalogue(p.select(F.col("p_brand").alias("make"), F.col("p_name").alias("model")))


@register("catalogue_choices")
def q_catalogue_choices(spark: SparkSession, sf: str) -> DataFrame:
    """Models offered for every brand and for a brand nobody sells."""
    p = read_table(spark, sf, "part", ["p_brand", "p_name"]).select(F.col("p_brand").alias("make"), F.col("p_name").alias("model"))
    asked = p.select("make").distinct().unionByName(spark.createDataFrame([("Brand#00",)], "make string"))
    return models_for(p, asked)


@register("body_list")
def q_body_list(spark: SparkSession, sf: str) -> DataFrame:
    return sale_view(spark, sf).select(normalize_key(F.col("body")).alias("body")).where("body is not null").distinct()


# ------------------------------------------------------------------ encoders, linear fit
@register("rare_levels")
def q_rare_levels(spark: SparkSession, sf: str) -> DataFrame:
    c = Chain(spark, sf)
    return level_counts(c.frame, ["year_month", "make", "model", "body"])


@register("ordinal_codes")
def q_ordinal_codes(spark: SparkSession, sf: str) -> DataFrame:
    c = Chain(spark, sf)
    return ordinal_codes(c.frame, ["year_month", "make", "model", "body"])


@register("scaled_numerics")
def q_scaled_numerics(spark: SparkSession, sf: str) -> DataFrame:
    c = Chain(spark, sf)
    return _r6_all(scaling_stats(c.frame, ["vehicle_age", "sale_month", "odometer", "condition"]))


@register("log_linear_by_body")
def q_log_linear_by_body(spark: SparkSession, sf: str) -> DataFrame:
    """Per body: least-squares fit of log1p(price) on odometer."""
    f = Chain(spark, sf).frame
    y, x = F.log1p("sellingprice"), F.col("odometer").cast("double")
    out = f.groupBy("body").agg(F.count(F.lit(1)).alias("n"),
                                F.regr_slope(y, x).alias("slope"),
                                F.regr_intercept(y, x).alias("intercept"),
                                F.regr_r2(y, x).alias("r2"))
    return out.select("body", "n", F.round("slope", 12).alias("slope"),
                      r6(F.col("intercept")).alias("intercept"), r6(F.col("r2")).alias("r2"))


# ------------------------------------------------------------------ models with a closed form
def _coefficients(spark: SparkSession, sf: str, key: str) -> DataFrame:
    coef = numeric_coefficients(Chain(spark, sf).frame, REFERENCE_SPECS[key])
    return coef.select("feature", F.round("coefficient", 8).alias("coefficient"))


@register("linear_coefficients")
def q_linear_coefficients(spark: SparkSession, sf: str) -> DataFrame:
    return _coefficients(spark, sf, "linear")


@register("ridge_coefficients")
def q_ridge_coefficients(spark: SparkSession, sf: str) -> DataFrame:
    return _coefficients(spark, sf, "ridge")


@register("lasso_coefficients")
def q_lasso_coefficients(spark: SparkSession, sf: str) -> DataFrame:
    return _coefficients(spark, sf, "lasso")


@register("tree_stump")
def q_tree_stump(spark: SparkSession, sf: str) -> DataFrame:
    """The best single split of the makes (in code order) by squared error of log1p(price)."""
    t = level_stump(Chain(spark, sf).frame, "make")
    return t.select("level", "code", F.round("log_price", 8).alias("log_price"))


@register("boosted_first_split")
def q_boosted_first_split(spark: SparkSession, sf: str) -> DataFrame:
    """Root split of the boosted trees' first tree over all eight columns at the reference settings."""
    t = first_split(Chain(spark, sf).frame, REFERENCE_SPECS["gbt"])
    return t.select("feature", "threshold", "side", F.round("leaf_value", 8).alias("leaf_value"),
                    F.round("gain", 6).alias("gain"))


def _one_hot_coefficients(spark: SparkSession, sf: str, key: str, **params) -> DataFrame:
    ref = REFERENCE_SPECS[key]
    spec = ModelSpec(ref.name, ref.kind, ref.encoding, {**ref.params, **params}, categorical=["body"])
    coef = coefficients(Chain(spark, sf).frame, spec)
    return coef.select("feature", "level", F.round("coefficient", 8).alias("coefficient"))


@register("ridge_one_hot_coefficients")
def q_ridge_one_hot_coefficients(spark: SparkSession, sf: str) -> DataFrame:
    """Ridge on the scaled numbers and the one-hot bodies."""
    return _one_hot_coefficients(spark, sf, "ridge")


LASSO_ALPHA = 0.002         # of the check: small enough that some coefficients stay


@register("lasso_one_hot_coefficients")
def q_lasso_one_hot_coefficients(spark: SparkSession, sf: str) -> DataFrame:
    """Lasso on the same columns with a penalty that leaves some coefficients."""
    return _one_hot_coefficients(spark, sf, "lasso", alpha=LASSO_ALPHA)


# ------------------------------------------------------------------ trained models (rows-only check)
# Models trained by this application, by the files they were trained on: trained once at the
# reference settings on all training rows, scored by every query that needs them.
_FITTED: dict[tuple, dict[str, PriceModel]] = {}


def trained(spark: SparkSession, sf: str, train: DataFrame, keys: list[str]) -> dict[str, PriceModel]:
    """Models of ``REFERENCE_SPECS`` fitted on ``train``, the training split of ``sf``."""
    files = fingerprint(spark, sf, ["lineitem", "part", "orders"])
    have = _FITTED.setdefault((spark.sparkContext.applicationId, files), {})
    todo = [k for k in keys if k not in have]
    if todo:
        have.update(zip(todo, fit_models(train, [REFERENCE_SPECS[k] for k in todo], SALE_KEY, write=False)))
    return {k: have[k] for k in keys}


def _scores(spark: SparkSession, sf: str, key: str) -> DataFrame:
    c = Chain(spark, sf, persist_sales=KEYED_COLUMNS)
    train, test = split(c.frame, SALE_KEY)
    model = trained(spark, sf, train, [key])[key]
    return model.transform(test).select(*SALE_KEY, "sellingprice",
                                        r6(F.col("prediction")).alias("prediction"))


@register("gbt_scores")
def q_gbt_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _scores(spark, sf, "gbt")


@register("forest_scores")
def q_forest_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _scores(spark, sf, "forest")


def raw_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the older training job: unclipped age, price range and odometer bound only, no model or month."""
    s = sale_view(spark, sf).withColumns({
        "vehicle_age": unclipped_age(F.col("saledate"), F.col("year")),
        "transmission": F.coalesce("transmission", F.lit("unknown"))})
    used = [*RAW_SPEC.numeric, *RAW_SPEC.categorical, "sellingprice"]
    return apply_bounds(s.select(*SALE_KEY, *used).dropna(how="any", subset=used), LOOSE_BOUNDS)


@register("raw_frame")
def q_raw_frame(spark: SparkSession, sf: str) -> DataFrame:
    return raw_frame(spark, sf)


@register("gbt_raw_scores")
def q_gbt_raw_scores(spark: SparkSession, sf: str) -> DataFrame:
    """The older job: raw price, row and column samples per tree, stopped 20 rounds after the best error on a
    share of the training rows."""
    train, test = split(written(raw_frame(spark, sf), "raw-frame"), SALE_KEY)
    model = fit_model(train, RAW_SPEC, SALE_KEY, validation_percent=20, write=False)
    return model.transform(test).select(*SALE_KEY, "sellingprice", r6(F.col("prediction")).alias("prediction"))


@register("ridge_scores")
def q_ridge_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _scores(spark, sf, "ridge")


@register("lasso_scores")
def q_lasso_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _scores(spark, sf, "lasso")


def compare_models(test: DataFrame, models: list[PriceModel], baseline: float | None) -> DataFrame:
    """Metrics of the median baseline and each model, over all rows and by price segment.

    The test rows are read once and carry one prediction per model; one
    aggregate gives every figure. ``rank`` orders the models by MAE within a segment.
    """
    wide = test.withColumn("_p0", F.lit(baseline).cast("double"))
    names = [("Median baseline", 0.0)] + [(m.spec.name, round(m.train_seconds, 2)) for m in models]
    for i, m in enumerate(models, 1):
        wide = m.transform(wide, out=f"_p{i}")
    scores = F.array(*[F.struct(F.lit(name).alias("model"), F.lit(sec).alias("train_seconds"),
                                F.col(f"_p{i}").alias("prediction")) for i, (name, sec) in enumerate(names)])
    long = wide.select("sellingprice", F.explode(scores).alias("s")).select("sellingprice", "s.*")
    found = F.transform(segments_column(F.col("sellingprice")), lambda s: s["segment"])
    long = long.withColumn("segment", F.explode(F.concat(F.array(F.lit("all")), found)))
    out = long.groupBy("model", "train_seconds", "segment").agg(
        F.count(F.lit(1)).alias("n"), *metric_columns("sellingprice", "prediction", extended=True))
    out = out.where((F.col("segment") == "all") | (F.col("n") >= SEGMENT_MIN_ROWS))
    return out.withColumn("rank", F.row_number().over(Window.partitionBy("segment").orderBy("mae", "model")))


@register("model_comparison")
def q_model_comparison(spark: SparkSession, sf: str) -> DataFrame:
    """Median baseline and the six models on one split, overall and by price segment."""
    c = Chain(spark, sf, persist_sales=KEYED_COLUMNS)
    train, test = split(c.frame, SALE_KEY)
    models = trained(spark, sf, train, list(REFERENCE_SPECS))
    median = scalar_median(train, "sellingprice", "m").first()
    return compare_models(test, list(models.values()), median["m"] if median else None)


@register("permutation_importance")
def q_permutation_importance(spark: SparkSession, sf: str) -> DataFrame:
    """Top 15 features by permutation importance (all test rows, 5 repeats) with the
    boosted trees' impurity importance alongside."""
    c = Chain(spark, sf, persist_sales=KEYED_COLUMNS)
    train, test = split(c.frame, SALE_KEY)
    model = trained(spark, sf, train, ["gbt"])["gbt"]
    perm = permutation_importance(model, test, SALE_KEY, FEATURE_COLUMNS)
    imp = impurity_importance(model, spark).withColumnRenamed("importance", "impurity_importance")
    out = perm.join(imp, "feature", "left")
    return out.orderBy(F.col("importance").desc(), "feature").limit(15)
