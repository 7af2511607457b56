"""Small dimension tables: written once, broadcast only after a size check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pricewise.sources.sinks import scratch_path

# Rows up to which a derived dimension is broadcast (checked, not assumed).
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
# Size of its files up to which it is broadcast, whatever their number.
MAX_BROADCAST_BYTES = 32 << 20


def written(df: DataFrame, label: str, **observed: Column) -> DataFrame:
    """``df`` as a table in the shared folder, read back: one job, no executor keeps it.

    Its row count and the ``observed`` aggregates come out of the same job
    (``observations`` of the result, by name; the count is ``rows``).
    """
    spark, path, seen = df.sparkSession, scratch_path(df.sparkSession, label), Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in observed.items()]).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.observations = seen.get
    return out


def file_bytes(df: DataFrame) -> int:
    """Size of the files below a frame that is read from a table, from its statistics (no job)."""
    return int(str(df._jdf.queryExecution().analyzed().stats().sizeInBytes()))


def checked_broadcast(df: DataFrame, max_rows: int | None = None, **observed: Column) -> DataFrame:
    """``df`` written to a table and broadcast only if it has at most ``max_rows`` rows and ``MAX_BROADCAST_BYTES``.

    The size check and the later joins read the same rows and the upstream plan
    runs once. Beyond the limit the frame is returned unhinted and the join
    stays a shuffle join (with AQE skew handling).
    """
    limit = DEFAULT_MAX_BROADCAST_ROWS if max_rows is None else max_rows
    df = written(df, "dimension", **observed)
    ok = df.observations["rows"] <= limit and file_bytes(df) <= MAX_BROADCAST_BYTES
    out = F.broadcast(df) if ok else df
    out._broadcast_ok = ok      # consumers of projections of ``out`` re-apply the verdict
    out.observations = df.observations
    return out


def broadcast_ok(df: DataFrame) -> bool:
    """True if ``df`` came out of ``checked_broadcast`` under the limit."""
    return bool(getattr(df, "_broadcast_ok", False))
