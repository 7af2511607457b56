"""Table sinks, run records and their partial update.

Scratch outputs go below the shared ``spark.checkpoint.dir`` (never a
machine-local folder on a cluster).
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewise.session import checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


def write_table(df: DataFrame, path: str, fmt: str = "parquet", header: bool = True,
                order_by: list[str] | None = None) -> str:
    """Overwrite sink (parquet by default; csv with a header row).

    With ``order_by`` the rows are sorted over all files, in the order of the file names."""
    w = (df.orderBy(*order_by) if order_by else df).write.mode("overwrite")
    if fmt == "csv":
        w = w.option("header", header)
    w.format(fmt).save(path)
    return path


def write_run_record(spark: SparkSession, record: dict, path: str) -> str:
    """One JSON document (nested lists allowed) as a one-row table."""
    df = spark.read.json(spark.sparkContext.parallelize([json.dumps(record)]))
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def update_run_record(spark: SparkSession, path: str, field: str, value: DataFrame,
                      out_path: str) -> str | None:
    """Replace one field of a stored run record with the rows of ``value``
    (as an array of structs) and write the result to a new path (a path
    being read cannot be overwritten). Returns None if no record exists."""
    try:
        rec = spark.read.json(path)
    except AnalysisException as ex:
        if ex.getCondition() != "PATH_NOT_FOUND":
            raise
        print(f"run record not found, skipped: {path}")
        return None
    arr = value.agg(F.collect_list(F.struct(*value.columns)).alias(field))
    out = rec.drop(field).crossJoin(arr) if field in rec.columns else rec.crossJoin(arr)
    out.coalesce(1).write.mode("overwrite").json(out_path)
    return out_path
