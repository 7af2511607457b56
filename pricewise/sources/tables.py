"""Column-pruned table scans (parquet is the default storage)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    """Read one table; with ``columns`` only those reach the parquet reader."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def fingerprint(spark: SparkSession, sf_dir: str, names: list[str]) -> tuple:
    """Path, size and time of every file of the named tables: changes whenever their data do."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    files = []
    for name in names:
        root = jvm.org.apache.hadoop.fs.Path(table_path(sf_dir, name))
        found = root.getFileSystem(conf).listFiles(root, True)
        while found.hasNext():
            f = found.next()
            files.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(files))
