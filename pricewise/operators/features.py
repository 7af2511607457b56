"""Feature rows and the modelling frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewise.config import (DEFAULT_BOUNDS, FEATURE_COLUMNS, TARGET_COLUMN, Bounds,
                              SeasonalityConfig, DEFAULT_SEASONALITY)
from pricewise.functions.dates import year_month
from pricewise.functions.numeric import safe_int

FEATURE_ROW = ["vehicle_age", "year_month", "sale_month", "make", "model", "odometer",
               "condition", "body", "sellingprice"]
FEATURE_INPUT = ["year", "make", "model", "body", "condition", "odometer", "saledate",
                 "sellingprice"]


def require_columns(df: DataFrame, required: list[str]) -> None:
    """Fail before any job if ``df`` lacks columns; the error names them in alphabetical order."""
    present = frozenset(df.columns)
    absent = [c for c in sorted(required) if c not in present]
    if absent:
        raise ValueError("the table has no column " + ", ".join(dict.fromkeys(absent)))


def feature_rows(clean: DataFrame, keep: list[str] | None = None,
                 integer_price: bool = True) -> DataFrame:
    """Clean sales -> feature rows (age floored at 0, UTC date parts).

    ``integer_price=False`` keeps a price with cents as double instead of the
    checked integer cast."""
    require_columns(clean, FEATURE_INPUT)
    keep = list(keep or [])
    df = clean.select(*keep, *FEATURE_INPUT).dropna(how="any", subset=FEATURE_INPUT)
    sale_year = F.year("saledate")
    return df.select(*keep,
        safe_int(F.greatest(sale_year - F.col("year"), F.lit(0)), "vehicle_age").alias("vehicle_age"),
        year_month(F.col("saledate")).alias("year_month"),
        F.month("saledate").cast("bigint").alias("sale_month"),
        "make", "model",
        safe_int(F.col("odometer"), "odometer").alias("odometer"),
        F.col("condition").cast("double").alias("condition"),
        "body",
        (safe_int(F.col("sellingprice"), "sellingprice") if integer_price
         else F.col("sellingprice").cast("double")).alias("sellingprice"),
    )


def unclipped_age(saledate: Column, model_year: Column) -> Column:
    """Sale year minus model year as it is; negative when the model year lies ahead."""
    return (F.year(saledate) - model_year).cast("bigint")


def apply_bounds(df: DataFrame, bounds: Bounds = DEFAULT_BOUNDS,
                 price_col: str = TARGET_COLUMN) -> DataFrame:
    """Inclusive range filter; a conjunction Catalyst pushes to the scan."""
    cond = F.col(price_col).between(*bounds.price)
    if bounds.odometer is not None:
        lo, hi = bounds.odometer
        cond = cond & ((F.col("odometer") <= hi) if lo is None else F.col("odometer").between(lo, hi))
    if bounds.age is not None:
        cond = cond & F.col("vehicle_age").between(*bounds.age)
    if bounds.month is not None:
        cond = cond & F.col("sale_month").between(*bounds.month)
    return df.where(cond)


def modeling_frame(features: DataFrame, bounds: Bounds = DEFAULT_BOUNDS,
                   key: list[str] | None = None) -> DataFrame:
    """Required-column check, drop nulls, outlier bounds."""
    required = FEATURE_COLUMNS + [TARGET_COLUMN]
    require_columns(features, required)
    cols = (key or []) + required
    df = features.select(*cols).dropna(how="any", subset=required)
    return apply_bounds(df, bounds)


def at_reference_point(df: DataFrame, cfg: SeasonalityConfig = DEFAULT_SEASONALITY) -> DataFrame:
    """Score every row as if sold in the reference month. The original
    sale_month / year_month are kept aside and restored by ``restore_point``."""
    return (df.withColumn("_sale_month", F.col("sale_month"))
            .withColumn("_year_month", F.col("year_month"))
            .withColumn("sale_month", F.lit(cfg.reference_month).cast("bigint"))
            .withColumn("year_month", F.lit(cfg.reference_year_month)))


def restore_point(df: DataFrame) -> DataFrame:
    return (df.withColumn("sale_month", F.col("_sale_month"))
            .withColumn("year_month", F.col("_year_month"))
            .drop("_sale_month", "_year_month"))
