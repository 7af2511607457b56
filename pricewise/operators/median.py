"""Exact grouped medians by bracketing, with one method for every group size.

Mergeable quantile sketches give each group two values that enclose its middle
ranks. A second pass counts the rows below the bracket and keeps only the rows
inside, equal values counted together before the shuffle. So an exchange carries
sketches and about 4 / ``ACCURACY`` of the rows, however large a group is, and
the running count that finds the middle ranks reads only those. Null keys form a
group like any other; null values count as rows but take no part in the median.

With ``accuracy`` the built-in ``percentile_approx`` is used instead: bounded
memory, and an element of the data (no interpolation on even counts).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricewise.operators.dims import written

ACCURACY = 10_000       # rank error of a sketch: 1 / ACCURACY of a group's rows


def middle_values(df: DataFrame, keys: list[str], value: str, count_col: str = "n") -> DataFrame:
    """One row per group: ``keys``, row count, and the two middle values ``lo`` and ``hi`` (equal on odd counts).

    ``df`` is read twice, so it should be cheap to read. Starts one job (the
    sketches, one row per group, are written).
    """
    margin = 2.0 / ACCURACY
    sketches = df.groupBy(*keys).agg(
        F.percentile_approx(value, [0.5 - margin, 0.5 + margin], ACCURACY).alias("_b"),
        F.count(F.lit(1)).alias(count_col), F.count(value).alias("_all"))
    sketches = written(sketches.select(*[F.col(k).alias(f"_k_{k}") for k in keys], count_col, "_all",
                                       F.col("_b")[0].alias("_from"), F.col("_b")[1].alias("_to")), "median-brackets")

    def same(left: DataFrame, right: DataFrame):
        cond = F.lit(True)
        for k in keys:
            cond = cond & left[k].eqNullSafe(right[f"_k_{k}"])
        return cond

    x = F.col(value)
    cells = df.join(sketches, same(df, sketches)).where(x <= F.col("_to"))
    cells = cells.select(*keys, "_all", F.when(x >= F.col("_from"), x).alias("_x")) \
        .groupBy(*keys, "_all", "_x").agg(F.count(F.lit(1)).alias("_w"))       # a null _x: rows below the bracket
    run = Window.partitionBy(*keys).orderBy(F.col("_x").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum("_w").over(run)
    ranked = cells.select(*keys, "_x", "_all", "_w", end.alias("_end")).where("_x is not null")

    def at(rank):
        return F.max(F.when((rank >= F.col("_end") - F.col("_w")) & (rank < F.col("_end")), F.col("_x").cast("double")))

    found = ranked.groupBy(*keys).agg(at(F.floor((F.col("_all") - 1) / 2)).alias("lo"),
                                      at(F.floor(F.col("_all") / 2)).alias("hi"))
    out = sketches.join(found, same(found, sketches), "left")
    lost = (F.col("_all") > 0) & (F.col("lo").isNull() | F.col("hi").isNull())
    checked = F.when(lost, F.raise_error(F.lit("a bracket does not hold its group's middle"))).otherwise(F.col("lo"))
    return out.select(*[F.col(f"_k_{k}").alias(k) for k in keys], count_col, checked.alias("lo"), "hi")


def grouped_median(df: DataFrame, keys: list[str], value: str, out: str = "median",
                   count_col: str = "n", accuracy: int | None = None,
                   partitions: int | None = None) -> DataFrame:
    """One row per group: ``keys``, median of ``value`` as ``out``, row count as ``count_col``.

    ``partitions`` spreads the rows first (for frames of too few partitions)."""
    if accuracy is not None:
        return df.groupBy(*keys).agg(
            F.percentile_approx(value, 0.5, accuracy).cast("double").alias(out),
            F.count(F.lit(1)).alias(count_col))
    df = df.select(*keys, value)
    m = middle_values(df.repartition(partitions) if partitions else df, keys, value, count_col)
    return m.select(*keys, (F.col("lo") * 0.5 + F.col("hi") * 0.5).alias(out), count_col)
