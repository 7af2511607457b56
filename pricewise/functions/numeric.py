"""Numeric coercion and arithmetic helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal / scientific number text. Java's parser also accepts
# '1d', 'NaN', 'Infinity' — those are refused here so that they become null
# as in a lenient numeric parser, and NaN never enters a comparison.
_NUMBER_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def coerce_number(col: Column) -> Column:
    """Text -> double; anything that is not a plain number becomes null."""
    s = F.regexp_replace(col, r"^\s+|\s+$", "")
    return F.when(s.rlike(_NUMBER_TEXT), s.try_cast("double"))


def safe_int(col: Column, name: str = "value") -> Column:
    """Nullable integer cast that refuses fractions instead of truncating."""
    return (F.when(col.isNull(), F.lit(None).cast("bigint"))
            .when(col == F.floor(col), col.cast("bigint"))
            .otherwise(F.raise_error(F.concat(
                F.lit(f"cannot cast non-integer {name} to integer: "),
                col.cast("string")))).cast("bigint"))


def clip(col: Column, lo, hi) -> Column:
    return F.least(F.greatest(col, F.lit(lo)), F.lit(hi))


def r6(col: Column) -> Column:
    """6-decimal rounding for values whose last bits depend on summation order."""
    return F.round(col, 6)
