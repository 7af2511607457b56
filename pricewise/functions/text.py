"""String normalisation expressions (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricewise.config import CATEGORY_TYPOS

# (?U) makes \s Unicode-aware, so tab, NBSP and other spaces are stripped too;
# Spark's trim() only removes ASCII spaces.
_EDGE_SPACE = r"(?U)^\s+|\s+$"
_INNER_SPACE = r"(?U)\s+"


def strip_unicode(col: Column) -> Column:
    return F.regexp_replace(col, _EDGE_SPACE, "")


def normalize_category(col: Column, typos: dict[str, str] = CATEGORY_TYPOS) -> Column:
    """strip -> lower -> collapse whitespace -> fix typos -> '' becomes null."""
    out = F.regexp_replace(F.lower(strip_unicode(col)), _INNER_SPACE, " ")
    for wrong, right in typos.items():
        out = F.replace(out, F.lit(wrong), F.lit(right))
    return F.nullif(out, F.lit(""))


def normalize_key(col: Column) -> Column:
    """Lookup-key normalisation of body names: lower + strip."""
    return strip_unicode(F.lower(col))
