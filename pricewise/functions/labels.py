"""Label expressions: month names, confidence, seasonal verdict."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricewise.config import (MONTH_NAMES, MIN_RECOMMENDATION_OBSERVATIONS,
                              SHRINKAGE_OBSERVATIONS, VERDICT_THRESHOLD_PCT)


def month_name(month: Column) -> Column:
    """1..12 -> 'Jan'..'Dec' (locale-free; null outside 1..12)."""
    names = F.array(*[F.lit(n) for n in MONTH_NAMES])
    return F.when(month.between(1, 12), F.element_at(names, month.cast("int")))


def confidence(n: Column, low: int = MIN_RECOMMENDATION_OBSERVATIONS,
               high: int = SHRINKAGE_OBSERVATIONS) -> Column:
    return (F.when(n == 0, "no_data").when(n < low, "low")
            .when(n < high, "medium").otherwise("high"))


def verdict(observations: Column, delta_pct: Column,
            threshold: float = VERDICT_THRESHOLD_PCT) -> Column:
    """no_data / strong / weak / average for a seasonal delta in percent."""
    return (F.when(F.coalesce(observations, F.lit(0)) == 0, "no_data")
            .when(delta_pct > threshold, "strong")
            .when(delta_pct < -threshold, "weak")
            .otherwise("average"))


def check_month(month: Column) -> Column:
    """Column-level argument check: month must be within 1..12."""
    return F.when(month.isNotNull() & month.between(1, 12), month).otherwise(
        F.raise_error(F.concat(F.lit("no such month (1 to 12 expected): "),
                               F.coalesce(month.cast("string"), F.lit("null")))))
