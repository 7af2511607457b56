"""Monthly economic index: series collapse, outer alignment, forward fill,
base-period ratio, left enrichment, strict lookup and as-of lookup with clamp.

Index tables are month dimensions (12 rows per calendar year), so the
single-partition windows used on them are bounded by the calendar span, not
by the data volume. Fact tables only ever meet them through equi joins.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricewise.functions.dates import month_start, year_month
from pricewise.operators import dims

MONTH = "year_month"


# ---------------------------------------------------------------- A1 / S3
def monthly_last(series: DataFrame, date_col: str = "observation_date",
                 value_col: str = "value", series_col: str = "series",
                 tiebreak: str | None = None, period_format: str = "yyyy-MM",
                 period_col: str = MONTH) -> DataFrame:
    """Last non-null value per (series, period) in date order.

    ``max_by`` with a total order (date, tiebreak) is deterministic, unlike
    ``last()``. Periods whose values are all null keep a null row.
    """
    order = F.struct(date_col, tiebreak) if tiebreak else F.col(date_col)
    tmp = series.select(series_col, F.date_format(date_col, period_format).alias(period_col),
                        value_col, order.alias("_ord"))
    return (tmp.groupBy(series_col, period_col)
            .agg(F.expr(f"max_by({value_col}, _ord) FILTER (WHERE {value_col} IS NOT NULL)")
                 .alias(value_col)))


def read_series_csv(spark, paths: dict[str, str], tries: int = 2) -> tuple[DataFrame | None, list[str]]:
    """Indicator files (``observation_date,<ID>``, '.' = null) -> long frame.

    A series whose file is missing (each of ``tries`` times it is looked up) or
    has fewer than two columns is skipped and reported in the returned list
    instead of failing the whole index. Any other error is raised.
    """
    frames, skipped = [], []
    for name, path in paths.items():
        df = None
        for _ in range(tries):
            try:
                df = (spark.read.option("header", True).option("nullValue", ".")
                      .option("mode", "FAILFAST").csv(path))
                break
            except AnalysisException as ex:
                if ex.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                    raise
        if df is None:
            skipped.append(name)
            continue
        if len(df.columns) < 2:
            skipped.append(name)
            continue
        date_c, value_c = df.columns[:2]
        frames.append(df.select(F.lit(name).alias("series"),
                                F.to_date(date_c).alias("observation_date"),
                                F.col(value_c).try_cast("double").alias("value")))
    if not frames:
        return None, skipped
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out, skipped


# ---------------------------------------------------------------- J2 + W1
def align(series_long: DataFrame, names: list[str], start: str | None = None,
          series_col: str = "series", value_col: str = "value",
          order_col: str | None = None) -> DataFrame:
    """Full outer alignment of k monthly series by one pivot (one shuffle).

    Rows where every series is null are dropped; ``start`` trims older months.
    A month that a series holds twice takes the value that is last by
    ``order_col``; without one a month must be unique, else the job fails.
    """
    if order_col:
        value = F.max_by(value_col, order_col)
    else:
        value = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.concat(
            F.lit("a series holds a month twice: "), F.first(MONTH)))).otherwise(F.max(value_col))
    wide = series_long.groupBy(MONTH).pivot(series_col, names).agg(value)
    wide = wide.where(F.coalesce(*[F.col(n) for n in names]).isNotNull())
    if start:
        wide = wide.where(F.col(MONTH) >= F.lit(start))
    return wide


def forward_fill(wide: DataFrame, names: list[str], order_col: str = MONTH) -> DataFrame:
    """Carry the last non-null value forward; leading nulls stay null."""
    w = Window.orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    return wide.select(order_col, *[F.last(n, ignorenulls=True).over(w).alias(n)
                                    for n in names])


# ---------------------------------------------------------------- A2
def base_ratio(index: DataFrame, value_col: str, base_year: int,
               out: str = "cpi_multiplier") -> DataFrame:
    """value / mean(value over the months of ``base_year``); error if the base is empty."""
    # Mean of the (at most 12) base-year values, summed in sorted order: the
    # result does not depend on partitioning or engine, down to the last bit.
    in_base = F.when(F.substring(MONTH, 1, 4) == F.lit(f"{base_year:04d}"), F.col(value_col))
    vals = F.array_sort(F.collect_list(in_base).over(Window.partitionBy(F.lit(0))))
    joined = index.withColumn("_vals", vals)
    joined = joined.withColumn("_base", F.when(F.size("_vals") > 0, F.aggregate(
        "_vals", F.lit(0.0), lambda acc, x: acc + x) / F.size("_vals"))).drop("_vals")
    ratio = F.when(F.col("_base").isNull(), F.raise_error(
        F.lit(f"base year {base_year} has no {value_col} value"))).otherwise(
        F.col(value_col) / F.col("_base"))
    return joined.withColumn(out, ratio).drop("_base")


def build_index(series_long: DataFrame, names: list[str], price_series: str,
                base_year: int, start: str | None = None) -> DataFrame:
    """A1 -> J2 -> W1 -> A2: the monthly index with its multiplier column."""
    wide = forward_fill(align(series_long, names, start), names)
    return base_ratio(wide, price_series, base_year)


def unique_months(index: DataFrame) -> DataFrame:
    """The index as it is; a month that occurs twice fails the job."""
    n = F.count(MONTH).over(Window.partitionBy(MONTH))
    checked = F.when(n > 1, F.raise_error(F.concat(F.lit("index month occurs twice: "), F.col(MONTH)))) \
        .otherwise(F.col(MONTH))
    return index.withColumn(MONTH, checked)


# ---------------------------------------------------------------- J1 / J4
def enrich(sales: DataFrame, index: DataFrame) -> DataFrame:
    """Left equi join of sales with every index column on year_month."""
    checked = unique_months(index)
    return sales.join(F.broadcast(checked) if dims.broadcast_ok(index) else checked, MONTH, "left")


def missing_months(sales: DataFrame, index: DataFrame, value_col: str = "cpi_multiplier") -> DataFrame:
    """One row: rows without an index value and the sorted list of their months."""
    j = sales.select(MONTH).join(index.select(MONTH, value_col), MONTH, "left")
    return j.agg(F.count_if(F.col(value_col).isNull()).alias("rows_without_index"),
                 F.array_sort(F.collect_set(F.when(F.col(value_col).isNull(), F.col(MONTH))))
                 .alias("missing_months"))


def strict_lookup(sales: DataFrame, index: DataFrame, value_col: str = "cpi_multiplier",
                  on_missing: str = "raise") -> DataFrame:
    """Exact-month lookup of ``value_col``.

    ``raise``     the distinct months of the facts are held against the index
                  first; if any has no value the call fails with the sorted
                  list of them (bounded by the calendar). Facts are joined
                  once, later, and are not kept.
    ``fail_fast`` no extra action: the first unmatched row fails its task.
    ``keep``      unmatched rows keep a null value.
    """
    checked = unique_months(index.select(MONTH, value_col))
    j = sales.join(F.broadcast(checked) if dims.broadcast_ok(index) else checked, MONTH, "left")
    if on_missing == "keep":
        return j
    if on_missing == "fail_fast":
        return j.withColumn(value_col, F.when(F.col(value_col).isNull(), F.raise_error(F.concat(
            F.lit("no index value for month "), F.col(MONTH))))
            .otherwise(F.col(value_col)))
    if on_missing != "raise":
        raise ValueError("on_missing must be 'raise', 'fail_fast' or 'keep'")
    known = index.where(F.col(value_col).isNotNull()).select(MONTH)
    missing = [r[0] for r in sales.select(MONTH).distinct().join(known, MONTH, "left_anti")
               .orderBy(MONTH).collect()]
    if missing:
        raise ValueError("no index value for months: " + ", ".join(str(m) for m in missing))
    return j


# ---------------------------------------------------------------- J3
def dense_calendar(index: DataFrame, cols: list[str]) -> DataFrame:
    """Gap-free month calendar between the first and last index month.

    Every calendar month carries the columns of the latest index month at or
    before it (``resolved_month``). Size = months spanned by the index.
    """
    bounds = index.agg(F.min(MONTH).alias("_lo"), F.max(MONTH).alias("_hi"))
    cal = bounds.select(F.explode(F.sequence(month_start(F.col("_lo")), month_start(F.col("_hi")),
                                             F.expr("interval 1 month"))).alias("_d"))
    cal = cal.select(year_month(F.col("_d")).alias(MONTH))
    present = index.select(F.col(MONTH).alias("_m"))
    cal = cal.join(present, cal[MONTH] == present["_m"], "left")
    w = Window.orderBy(MONTH).rowsBetween(Window.unboundedPreceding, 0)
    cal = cal.withColumn("resolved_month", F.last("_m", ignorenulls=True).over(w)).drop("_m")
    idx = index.select(F.col(MONTH).alias("resolved_month"), *cols)
    return cal.join(idx, "resolved_month", "left")


def asof_lookup(facts: DataFrame, index: DataFrame, cols: list[str],
                month_col: str = MONTH) -> DataFrame:
    """Backward as-of lookup with clamp, as an equi join.

    Exact month if present, else the latest index month before it, else (for
    months before the index) the earliest one. Months after the index resolve
    to its last month. Adds ``resolved_month``, ``is_carried`` and ``cols``.

    The dense calendar has one row per month spanned by the index (12 per
    year), so it is broadcast after a size check; the fact side is never
    shuffled. The two range bounds are read once to the driver.
    """
    # the job that writes the calendar gives its size and the range bounds
    cal = dims.checked_broadcast(dense_calendar(unique_months(index.select(MONTH, *cols)), cols),
                                 lo=F.min(MONTH), hi=F.max(MONTH))
    first = cal.observations
    if first["lo"] is None:
        raise ValueError("as-of lookup needs a non-empty index")
    # greatest/least skip nulls: a null month must stay unresolved
    key = F.when(F.col(month_col).isNotNull(),
                 F.least(F.greatest(F.col(month_col), F.lit(first["lo"])), F.lit(first["hi"])))
    f = facts.withColumn("_key", key)
    keyed = cal.select(F.col(MONTH).alias("_key"), "resolved_month", *cols)
    out = f.join(F.broadcast(keyed) if dims.broadcast_ok(cal) else keyed, "_key", "left")
    return out.drop("_key").withColumn("is_carried", F.col("resolved_month") != F.col(month_col))


def snapshot(months: DataFrame, index: DataFrame, cols: list[str], digits: int = 4) -> DataFrame:
    """Every indicator of the (as-of) month of each row, rounded; null where the indicator has no value yet."""
    found = asof_lookup(months, index, cols)
    return found.select(*[c for c in found.columns if c not in cols], *[F.round(c, digits).alias(c) for c in cols])
