"""Seasonal factors by body and sale month.

rows:    sales at a fixed reference month, scored, floored, index-normalised
factors: body medians -> relative ratios -> body x month medians -> grid of
         12 months per body -> shrink + clip -> best / worst month -> labels
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewise.config import (DEFAULT_SEASONALITY, FEATURE_COLUMNS, TARGET_COLUMN,
                              SeasonalityConfig)
from pricewise.functions.labels import check_month, confidence, month_name
from pricewise.functions.numeric import clip
from pricewise.functions.text import normalize_key
from pricewise.operators.dims import broadcast_ok, checked_broadcast, written
from pricewise.operators.features import apply_bounds, at_reference_point, restore_point
from pricewise.operators.index import strict_lookup
from pricewise.operators.median import middle_values

Predictor = Callable[[DataFrame], DataFrame]   # adds a ``prediction`` column

ROW_COLUMNS = ["body", "sale_month", "year_month", "normalized_price",
               "reference_prediction", "price_ratio"]
FACTOR_COLUMNS = ["body", "sale_month", "month_name", "seasonal_factor", "seasonal_delta_pct",
                  "raw_factor", "observations", "confidence", "is_observed", "body_observations",
                  "recommendation_eligible_months", "has_recommendation", "best_month",
                  "best_month_name", "best_factor", "worst_month", "worst_month_name",
                  "worst_factor"]


def seasonality_rows(sales: DataFrame, predict: Predictor, index: DataFrame,
                     cfg: SeasonalityConfig = DEFAULT_SEASONALITY,
                     on_missing: str = "raise", keep: list[str] | None = None) -> DataFrame:
    """Index-normalised price relative to a reference-month prediction.

    ``keep`` lists extra columns (e.g. the row key) carried through."""
    required = FEATURE_COLUMNS + [TARGET_COLUMN]
    keep = list(keep or [])
    df = sales.select(*keep, *required).dropna(how="any", subset=required)
    df = apply_bounds(df, cfg.bounds)
    df = df.withColumn("body", normalize_key(F.col("body")))
    scored = restore_point(predict(at_reference_point(df, cfg)))
    # only what the rows need is carried into the (materialised) lookup
    scored = scored.select(*keep, "body", "sale_month", "year_month", TARGET_COLUMN,
                           F.greatest(F.col("prediction"), F.lit(cfg.prediction_floor))
                           .alias("reference_prediction"))
    scored = strict_lookup(scored, index, "cpi_multiplier", on_missing=on_missing)
    norm = F.col(TARGET_COLUMN) / F.col("cpi_multiplier")
    return scored.select(
        *keep, "body", "sale_month", "year_month", norm.alias("normalized_price"),
        "reference_prediction", (norm / F.col("reference_prediction")).alias("price_ratio"))


def month_grid(bodies: DataFrame) -> DataFrame:
    """Every body x months 1..12 (12 rows per body)."""
    return bodies.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(12).cast("bigint")))
                         .alias("sale_month"))


def seasonality_factors(rows: DataFrame, cfg: SeasonalityConfig = DEFAULT_SEASONALITY) -> DataFrame:
    """Shrunken, clipped body x month factors with best/worst month (18 columns).

    ``rows`` are read twice, so they should be cheap to read."""
    # one pass for both levels: a null month stands for the whole body. Dividing by a body's
    # median keeps the order of its ratios, so the middle ratios are the middle relative ratios.
    levels = rows.select("body", F.explode(F.array(F.lit(None).cast("bigint"), F.col("sale_month").cast("bigint")))
                         .alias("sale_month"), "price_ratio")
    middle = written(middle_values(levels, ["body", "sale_month"], "price_ratio"), "body-months")
    body = middle.where("sale_month is null").select(
        "body", (F.col("lo") * 0.5 + F.col("hi") * 0.5).alias("body_median"), F.col("n").alias("body_observations"))
    cells = middle.where("sale_month is not null").join(body, "body").select(
        "body", "sale_month", "n", (F.col("lo") / F.col("body_median") * 0.5
                                    + F.col("hi") / F.col("body_median") * 0.5).alias("raw"))
    grid = month_grid(body.select("body", "body_observations"))
    g = grid.join(cells, ["body", "sale_month"], "left")
    n = F.coalesce(F.col("n"), F.lit(0)).cast("bigint")
    raw = F.coalesce(F.col("raw"), F.lit(1.0))
    weight = n / (n + F.lit(cfg.shrinkage))
    factor = F.when(n > 0, clip(F.lit(1.0) + (raw - F.lit(1.0)) * weight,
                                cfg.factor_min, cfg.factor_max)).otherwise(F.lit(1.0))
    g = g.select("body", "sale_month", "body_observations", n.alias("observations"),
                 raw.alias("raw"), factor.alias("factor"))
    per_body = _recommendations(g, cfg)
    out = g.join(per_body, "body")
    return out.select(
        "body", "sale_month",
        month_name(F.col("sale_month")).alias("month_name"),
        F.round("factor", 4).alias("seasonal_factor"),
        F.round((F.col("factor") - 1.0) * 100, 1).alias("seasonal_delta_pct"),
        F.round("raw", 4).alias("raw_factor"),
        "observations",
        confidence(F.col("observations"), cfg.min_rec_observations, cfg.shrinkage).alias("confidence"),
        (F.col("observations") > 0).alias("is_observed"),
        "body_observations", "recommendation_eligible_months", "has_recommendation",
        "best_month", month_name(F.col("best_month")).alias("best_month_name"),
        F.round("best_factor", 4).alias("best_factor"),
        "worst_month", month_name(F.col("worst_month")).alias("worst_month_name"),
        F.round("worst_factor", 4).alias("worst_factor"),
    )


def _recommendations(g: DataFrame, cfg: SeasonalityConfig) -> DataFrame:
    """Per body: eligible months, flag, arg-max / arg-min month on the unrounded factor.

    Candidates are months with >= min observations; if none, months with any
    observation. Ties go to the smallest month.
    """
    lo = cfg.min_rec_observations
    best = "max_by({v}, struct(factor, -sale_month)) FILTER (WHERE {c})"
    worst = "min_by({v}, struct(factor, sale_month)) FILTER (WHERE {c})"
    elig, obs = f"observations >= {lo}", "observations > 0"
    ref = F.lit(cfg.reference_month).cast("bigint")
    agg = g.groupBy("body").agg(
        F.sum((F.col("observations") >= lo).cast("bigint")).alias("recommendation_eligible_months"),
        F.coalesce(F.expr(best.format(v="sale_month", c=elig)),
                   F.expr(best.format(v="sale_month", c=obs)), ref).alias("best_month"),
        F.coalesce(F.expr(best.format(v="factor", c=elig)),
                   F.expr(best.format(v="factor", c=obs)), F.lit(1.0)).alias("best_factor"),
        F.coalesce(F.expr(worst.format(v="sale_month", c=elig)),
                   F.expr(worst.format(v="sale_month", c=obs)), ref).alias("worst_month"),
        F.coalesce(F.expr(worst.format(v="factor", c=elig)),
                   F.expr(worst.format(v="factor", c=obs)), F.lit(1.0)).alias("worst_factor"),
    )
    return agg.withColumn("has_recommendation",
                          F.col("recommendation_eligible_months") >= cfg.min_rec_months)


def backfill_factor_columns(factors: DataFrame, cfg: SeasonalityConfig = DEFAULT_SEASONALITY
                            ) -> DataFrame:
    """Loaded factor table: normalise keys, derive the two recommendation
    columns when the stored table lacks them."""
    from pyspark.sql import Window
    df = factors.withColumn("body", normalize_key(F.col("body").cast("string"))) \
        .withColumn("sale_month", F.col("sale_month").cast("bigint"))
    if "recommendation_eligible_months" not in df.columns:
        w = Window.partitionBy("body")
        df = df.withColumn("recommendation_eligible_months",
                           F.sum((F.col("observations") >= cfg.min_rec_observations)
                                 .cast("bigint")).over(w))
    if "has_recommendation" not in df.columns:
        df = df.withColumn("has_recommendation",
                           F.col("recommendation_eligible_months") >= cfg.min_rec_months)
    return df


def lookup_factors(facts: DataFrame, factors: DataFrame, body_col: str = "body",
                   month_col: str = "sale_month", size_checked: bool = False) -> DataFrame:
    """Composite-key lookup with neutral defaults for unseen (body, month).

    Months outside 1..12 fail the job. Defaults: factor 1.0, no_data, the
    own month as best and worst month. ``size_checked`` marks a factor table
    already materialised and counted by ``checked_broadcast``.
    """
    f = facts.withColumn("_body", normalize_key(F.col(body_col))) \
        .withColumn("_month", check_month(F.col(month_col)).cast("bigint"))
    cols = [c for c in FACTOR_COLUMNS if c not in ("body", "sale_month")]
    fac = factors.select(F.col("body").alias("_body"), F.col("sale_month").alias("_month"),
                         *[F.col(c).alias(f"_f_{c}") for c in cols])
    # 12 rows per body; broadcast after a size check
    if size_checked:
        fac = F.broadcast(fac) if broadcast_ok(factors) else fac
    else:
        fac = checked_broadcast(fac)
    j = f.join(fac, ["_body", "_month"], "left")
    matched = F.col("_f_month_name").isNotNull()
    mname = month_name(F.col("_month"))
    defaults = {
        "month_name": mname, "seasonal_factor": F.lit(1.0), "seasonal_delta_pct": F.lit(0.0),
        "raw_factor": F.lit(None).cast("double"), "observations": F.lit(0).cast("bigint"),
        "confidence": F.lit("no_data"), "is_observed": F.lit(False),
        "body_observations": F.lit(None).cast("bigint"),
        "recommendation_eligible_months": F.lit(0).cast("bigint"),
        "has_recommendation": F.lit(False), "best_month": F.col("_month"),
        "best_month_name": mname, "best_factor": F.lit(1.0), "worst_month": F.col("_month"),
        "worst_month_name": mname, "worst_factor": F.lit(1.0),
    }
    for c in cols:
        j = j.withColumn(f"sf_{c}", F.when(matched, F.col(f"_f_{c}")).otherwise(defaults[c]))
    return j.drop(*[f"_f_{c}" for c in cols], "_body", "_month")
