"""Index and factor-table sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewise.config import DEFAULT_SEASONALITY, SeasonalityConfig
from pricewise.operators.index import read_series_csv  # noqa: F401  (S3, re-exported)
from pricewise.operators.seasonality import backfill_factor_columns
from pricewise.sources import snapshots

INDEX_SCHEMA = ("year_month string, cpi_used_cars double, fedfunds double, consumer_sentiment double, "
                "unemployment double, total_vehicle_sales double, recession double, "
                "credit_spread double, cpi_multiplier double")


def load_index(spark: SparkSession, path: str, schema: str = INDEX_SCHEMA) -> DataFrame:
    """Stored month index (CSV with header) with a string month key."""
    df = spark.read.option("header", True).schema(schema).csv(path)
    return df.withColumn("year_month", F.col("year_month").cast("string"))


def load_or_build_factors(spark: SparkSession, path: str, build,
                          cfg: SeasonalityConfig = DEFAULT_SEASONALITY) -> DataFrame:
    """Read the published factor table, or build and publish it when there is none.

    ``build`` is a zero-argument callable returning the factor DataFrame. A
    build that dies is not seen by later readers. Older tables without the
    recommendation columns are completed; so are tables written as plain folders.
    """
    if snapshots.manifest(spark, path) is None:
        if _finished(spark, path):
            return backfill_factor_columns(spark.read.parquet(path), cfg)
        snapshots.publish(build(), path, order_by=["body", "sale_month"])
    return backfill_factor_columns(snapshots.read_snapshot(spark, path), cfg)


def _finished(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
