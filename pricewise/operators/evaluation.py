"""Evaluation of the seasonal rule: hold-out, body summary, coverage, catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewise.config import DEFAULT_SEASONALITY, SeasonalityConfig
from pricewise.functions.labels import month_name
from pricewise.functions.text import normalize_key
from pricewise.operators.dims import checked_broadcast
from pricewise.operators.seasonality import month_grid, seasonality_factors
from pricewise.operators.split import is_test


def holdout_evaluation(rows: DataFrame, keys: list[str],
                       cfg: SeasonalityConfig = DEFAULT_SEASONALITY) -> DataFrame:
    """Factors fitted on the training split; MAE on the test split without
    and with the factor (unseen body/month -> 1.0). One row."""
    flagged = rows.withColumn("_test", is_test(keys))
    fac = seasonality_factors(flagged.where(~F.col("_test")), cfg)
    fac = checked_broadcast(fac.select("body", "sale_month", "seasonal_factor"))
    t = flagged.join(fac, ["body", "sale_month"], "left")
    factor = F.coalesce(F.col("seasonal_factor"), F.lit(1.0))
    base_err = F.abs(F.col("normalized_price") - F.col("reference_prediction"))
    seas_err = F.abs(F.col("normalized_price") - F.col("reference_prediction") * factor)
    out = t.agg(F.count_if(~F.col("_test")).alias("training_rows"),
                F.count_if(F.col("_test")).alias("test_rows"),
                F.avg(F.when(F.col("_test"), base_err)).alias("baseline_mae"),
                F.avg(F.when(F.col("_test"), seas_err)).alias("stage3_mae"))
    return out.withColumns({
        "mae_change": F.col("stage3_mae") - F.col("baseline_mae"),
        "mae_change_percent": (F.try_divide(F.col("stage3_mae"), F.col("baseline_mae")) - 1.0) * 100,
    })


def body_summary(factors: DataFrame, top_n: int = 12) -> DataFrame:
    """Per body: totals, observed months, best/worst; top ``top_n`` by total,
    with the recommendation coverage of all bodies on every row."""
    per = factors.groupBy("body").agg(
        F.max("body_observations").alias("total_observations"),
        F.sum(F.col("is_observed").cast("bigint")).alias("observed_months"),
        F.max("best_month_name").alias("best_month"), F.max("best_factor").alias("best_factor"),
        F.max("worst_month_name").alias("worst_month"), F.max("worst_factor").alias("worst_factor"),
        F.bool_or("has_recommendation").alias("has_recommendation"))
    cov = per.agg(F.count(F.lit(1)).alias("n"), F.count_if("has_recommendation").alias("yes")).first()
    top = per.orderBy(F.col("total_observations").desc(), F.col("body").asc()).limit(top_n)
    return top.withColumns({"bodies_total": F.lit(cov["n"]).cast("bigint"),
                            "bodies_with_recommendation": F.lit(cov["yes"]).cast("bigint"),
                            "bodies_without_recommendation": F.lit(cov["n"] - cov["yes"]).cast("bigint")})


def unobserved_cells(sales: DataFrame) -> DataFrame:
    """(body, month) cells of the 12-month grid with no sale (anti join)."""
    s = sales.select(normalize_key(F.col("body")).alias("body"), "sale_month")
    observed = s.distinct()
    bodies = s.select("body").distinct()
    grid = month_grid(bodies)
    missing = grid.join(observed, ["body", "sale_month"], "left_anti")
    return missing.select("body", "sale_month", month_name(F.col("sale_month")).alias("month_name"))


def catalogue(df: DataFrame) -> DataFrame:
    """Distinct (make, model) rows; a make may have any number of models."""
    return df.select("make", "model").distinct()


def models_for(catalogue: DataFrame, makes: DataFrame) -> DataFrame:
    """(make, model) choices per requested make: its own models, or all models if the make is not in the catalogue."""
    known = makes.select("make").distinct().join(catalogue.select("make").distinct(), "make", "left_semi")
    own = known.join(catalogue.select("make", "model").distinct(), "make")
    unknown = makes.select("make").distinct().join(known, "make", "left_anti")
    # a list of requests, and every model once: the report offers all of them for each unknown make
    return own.unionByName(unknown.crossJoin(catalogue.select("model").distinct()).select("make", "model"))


def evaluate_segments(model, frame: DataFrame, keys: list[str], record: str, y: str = "sellingprice") -> DataFrame | None:
    """Score the test split, measure overall and by price segment, and publish the updated run record.

    ``record`` is a published one-row table (``snapshots``) with ``segment_metrics``; the record is read,
    its two fields replaced and the new one published in one step. None (and no scoring) without a record.
    """
    from pricewise.operators.metrics import regression_metrics, segment_metrics
    from pricewise.operators.split import split
    from pricewise.sources import snapshots
    spark = frame.sparkSession
    if snapshots.manifest(spark, record) is None:
        return None
    scored = model.transform(split(frame, keys)[1]).select(y, "prediction")
    segments, overall = segment_metrics(scored, y=y), regression_metrics(scored, y=y)
    old = snapshots.read_snapshot(spark, record).drop("segment_metrics", "metrics")
    new = old.join(F.broadcast(overall.agg(F.first(F.struct(*overall.columns)).alias("metrics")))) \
        .join(F.broadcast(segments.agg(F.sort_array(F.collect_list(F.struct(*segments.columns))).alias("segment_metrics"))))
    snapshots.publish(new, record)          # one row each
    return snapshots.read_snapshot(spark, record)


def listed_that_exist(factors: DataFrame, bodies: list[str]) -> DataFrame:
    """Factor rows of the listed bodies that exist in the table (semi join
    against a literal list), in no particular order."""
    spark = factors.sparkSession
    wanted = spark.createDataFrame([(b,) for b in bodies], "body string")
    return factors.join(F.broadcast(wanted), "body", "left_semi")  # the list is a parameter
