"""Helpers shared by the operators: shared scratch tables, row packing, hot-key-safe reads."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewise.session import checkpoint_dir

ROW = "__row"       # all columns of an input row, packed so that no added name can clash


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder of ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a shared table and read it back.

    The lineage ends at the files, so a lost executor costs no recomputation
    of what lies before them, and every reader sees the same rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


BROADCAST_ROWS = 50_000     # rows of a written table of numbers that are broadcast; beyond, the join is shuffled


def small(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written table of narrow rows, hinted for broadcast if it has at most ``rows`` rows."""
    return F.broadcast(table) if table.limit(rows + 1).count() <= rows else table


def drop_cut(df: DataFrame) -> None:
    """Delete a table written by ``cut`` that nothing will read again."""
    path = getattr(df, "_scratch", None)
    if path:
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def pack(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct column named ``ROW``."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(ROW)


def unpack(df: DataFrame, columns: Sequence[str], *extra: str) -> DataFrame:
    """The columns packed by ``pack``, then the named further ones."""
    return df.select(*[F.col(ROW)[c].alias(c) for c in columns], *extra)


BATCH_ROWS = 1000       # rows of whole texts handed to Python at a time


def small_batches(spark: SparkSession) -> None:
    """Lower Spark's row count per Arrow batch (10,000 by default): whole texts can be long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def text_bytes(col: str = "text") -> Column:
    """The UTF-8 bytes of a text column."""
    return F.col(col).cast("binary")
