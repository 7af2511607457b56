"""Feature encoders: rare-level one-hot, ordinal codes, standard scaling.

The fitted state of each encoder is a small DataFrame (levels, codes,
moments) computed by one aggregate, so it can be checked against SQL and
applied with an equi join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricewise.config import RARE_LEVEL_MIN_COUNT
from pricewise.operators.dims import broadcast_ok
from pricewise.sources.sinks import scratch_path

RARE = "__rare__"


def _long_levels(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, level) rows for every categorical cell, via one stack."""
    pairs = ", ".join(f"'{c}', CAST({c} AS STRING)" for c in columns)
    return df.selectExpr(f"stack({len(columns)}, {pairs}) AS (feature, level)")


def level_counts(df: DataFrame, columns: list[str],
                 min_count: int = RARE_LEVEL_MIN_COUNT) -> DataFrame:
    """Level frequency per feature; levels under ``min_count`` rows share one
    infrequent column of the one-hot encoding."""
    counts = _long_levels(df, columns).groupBy("feature", "level").agg(
        F.count(F.lit(1)).alias("n"))
    rare = F.col("n") < min_count
    return counts.select("feature", "level", "n", rare.alias("is_rare"),
                         F.when(rare, F.lit(RARE)).otherwise(F.col("level")).alias("encoded_level"))


def level_numbers(levels: DataFrame) -> DataFrame:
    """``number`` 0, 1, ... in alphabetical order of the (distinct) levels of each feature.

    Levels are range partitioned; the counts before a partition give its first
    numbers, so no feature has to be sorted by one task.
    """
    spark = levels.sparkSession
    path = scratch_path(spark, "levels")
    order = Window.partitionBy("feature", "_part").orderBy("level")
    levels.select("feature", "level").repartitionByRange("feature", "level") \
        .withColumn("_part", F.spark_partition_id()).write.parquet(path)
    parts = spark.read.schema("feature string, level string, _part int").parquet(path)
    before = Window.partitionBy("feature").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = parts.groupBy("feature", "_part").agg(F.count("*").alias("_n")).select(     # a row per feature and partition
        "feature", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    return parts.join(first, ["feature", "_part"]).select(
        "feature", "level", (F.col("_first") + F.row_number().over(order) - 1).cast("bigint").alias("number"))


def ordinal_codes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Alphabetical codes 0..k-1 per feature (unseen levels map to -1)."""
    return level_numbers(_long_levels(df, columns).distinct()).withColumnRenamed("number", "code")


def scaling_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean and population standard deviation per numeric feature (one pass)."""
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__sd")]
    wide = df.agg(*aggs)
    cells = ", ".join(f"'{c}', {c}__mean, {c}__sd" for c in columns)
    return wide.selectExpr(f"stack({len(columns)}, {cells}) AS (feature, mean, sd)")


def rare_mapped(df: DataFrame, levels: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``{c}_enc`` columns: the level as text, rare ones as the shared infrequent level.

    The caller's own columns stay as they are."""
    out = df
    for c in columns:
        m = levels.where((F.col("feature") == c) & F.col("is_rare")).select(
            F.col("level").alias(f"_r_{c}"))
        m = F.broadcast(m) if broadcast_ok(levels) else m
        out = out.join(m, out[c].cast("string") == m[f"_r_{c}"], "left") \
            .withColumn(f"{c}_enc", F.when(F.col(f"_r_{c}").isNotNull(), F.lit(RARE))
                        .otherwise(F.col(c).cast("string"))).drop(f"_r_{c}")
    return out
