"""Quote requests as a stream: each micro-batch of vehicles is priced
through the same chain as the batch ``quote`` (stream-static joins against
the fitted group baseline, the month calendar and the factor table, all
small broadcast dimensions). Stateless, so no watermark is needed; the
checkpoint location makes the sink exactly-once across restarts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pricewise.config import DEFAULT_SEASONALITY, SeasonalityConfig
from pricewise.operators.quote import quote
from pricewise.session import checkpoint_dir


def quote_stream(requests: DataFrame, predict, index: DataFrame, factors: DataFrame,
                 cfg: SeasonalityConfig = DEFAULT_SEASONALITY) -> DataFrame:
    """Streaming DataFrame of priced quotes for a streaming request frame."""
    if not requests.isStreaming:
        raise ValueError("requests must be a streaming DataFrame (spark.readStream...)")
    return quote(requests, predict, index, factors, cfg)


def start_quote_stream(spark: SparkSession, source_dir: str, schema: str, predict,
                       index: DataFrame, factors: DataFrame, *, query_name: str, sink: str = "parquet",
                       path: str | None = None,
                       cfg: SeasonalityConfig = DEFAULT_SEASONALITY,
                       max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Read request files from ``source_dir`` as they land and write quotes.

    The stream checkpoint lives below the shared ``spark.checkpoint.dir``, in a
    folder named by ``query_name``, so streams of different names never share one.
    ``sink="memory"`` registers an in-memory table named ``query_name``.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    out = quote_stream(reader.parquet(source_dir), predict, index, factors, cfg)
    w = (out.writeStream.outputMode("append").queryName(query_name)
         .option("checkpointLocation", f"{checkpoint_dir(spark).rstrip('/')}/streams/{query_name}"))
    if sink == "memory":
        return w.format("memory").start()
    if path is None:
        raise ValueError("a file sink needs a path")
    return w.format(sink).start(path)
