"""Batch quoting: a table of vehicles priced at any target month.

stage1 = model price at the fixed reference month
stage2 = stage1 x index multiplier of the target month (as-of, clamped)
final  = stage2 x seasonal factor of (body, target month)

The chain is one narrow map stage over the quotes plus equi joins against
three small tables (predictions by group, month calendar, factor table).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewise.config import DEFAULT_SEASONALITY, SeasonalityConfig
from pricewise.functions.labels import verdict
from pricewise.functions.numeric import clip
from pricewise.operators.features import at_reference_point, restore_point
from pricewise.operators.index import asof_lookup
from pricewise.operators.seasonality import Predictor, lookup_factors


def quote(vehicles: DataFrame, predict: Predictor, index: DataFrame, factors: DataFrame,
          cfg: SeasonalityConfig = DEFAULT_SEASONALITY, max_age: int = 30,
          factors_checked: bool = False) -> DataFrame:
    df = vehicles.withColumn(
        "vehicle_age", clip(F.col("target_year") - F.col("model_year"), 0, max_age).cast("bigint")
    ).withColumn(
        "year_month", F.format_string("%04d-%02d", F.col("target_year").cast("int"),
                                      F.col("target_month").cast("int"))
    ).withColumn("sale_month", F.col("target_month").cast("bigint"))
    scored = restore_point(predict(at_reference_point(df, cfg))) \
        .withColumnRenamed("prediction", "stage1_price")
    scored = asof_lookup(scored, index, ["cpi_multiplier"])
    scored = scored.withColumn("stage2_price", F.col("stage1_price") * F.col("cpi_multiplier"))
    scored = lookup_factors(scored, factors, "body", "target_month", size_checked=factors_checked)
    factor = F.col("sf_seasonal_factor")
    has_rec = F.col("sf_has_recommendation")
    delta_pct = (factor - 1.0) * 100
    out = scored.withColumns({
        "seasonal_factor": factor,
        "final_price": F.col("stage2_price") * factor,
        "index_delta": F.col("stage2_price") - F.col("stage1_price"),
        "index_delta_pct": (F.col("cpi_multiplier") - 1.0) * 100,
        "seasonal_delta": F.col("stage2_price") * factor - F.col("stage2_price"),
        "seasonal_delta_pct": delta_pct,
        "best_month_name": F.when(has_rec, F.col("sf_best_month_name")),
        "best_gap_points": F.when(has_rec, (F.col("sf_best_factor") - factor) * 100),
        "verdict": verdict(F.col("sf_observations"), delta_pct, ),
    })
    out = out.withColumn("hint_month", F.when((F.col("verdict") == "weak") & has_rec,
                                              F.col("sf_best_month_name")))
    return out.drop(*[c for c in out.columns if c.startswith("sf_")])
