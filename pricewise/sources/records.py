"""CSV records from files, cut in parallel; a record may run over several lines.

Spark hands out byte splits of the files, line by line. Whether a line starts a
record depends on the quotes before it, so each split is first reduced to a
function of two states (outside a record, inside a quoted field): where it ends
up from either. Composing these functions from split to split gives every split
its state at the start; then all splits cut their records at the same time. A
record that crosses split borders comes as pieces, which are put together.

Quoting is as in Python's ``csv.reader``: a quote opens a field only at its
start, two quotes inside stand for one, and blank lines are no records.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewise.operators.clean import repair_records
from pricewise.sources.sinks import scratch_path

_INSIDE = re.compile(r'(?:[^"]+|"")*+"')       # up to the quote that closes a field


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line that starts inside a quoted field (or outside any record) ends inside one."""
    if '"' not in line:
        return inside
    at = 0
    while True:
        if inside:
            m = _INSIDE.match(line, at)
            if not m:
                return True
            at = m.end()
        elif line.startswith('"', at):
            inside, at = True, at + 1
            continue
        at = line.find(",", at) + 1         # what follows a closing quote belongs to the field
        if not at:
            return False
        inside = False


_SPLIT = "path string, start long, from_out boolean, from_in boolean"
_PIECE = "path string, start long, place long, piece string, is_open boolean, is_next boolean"


def _lines(spark: SparkSession, path) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value")


def _rows(batches):
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    types = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(zip(*rows), fields)],
                                      names=[n for n, _ in fields])


def split_states(spark: SparkSession, path) -> dict[tuple[str, int], bool]:
    """Whether each split (file, first byte) starts inside a quoted field. One row per split reaches the driver."""
    def reduce(batches):
        now, state = None, None
        for file, start, line in _rows(batches):
            if now != (file, start):
                if now is not None:
                    yield _batch([(*now, *state)], _SPLIT)
                now, state = (file, start), (False, True)
            if '"' in line:
                state = tuple(ends_inside(line, s) for s in state)
        if now is not None:
            yield _batch([(*now, *state)], _SPLIT)

    states, at, file = {}, False, None
    for r in sorted(_lines(spark, path).mapInArrow(reduce, _SPLIT).collect()):
        at = at if r["path"] == file else False
        file = r["path"]
        states[r["path"], r["start"]] = at
        at = r["from_in"] if at else r["from_out"]
    return states


def read_records(spark: SparkSession, path, header: bool = True) -> DataFrame:
    """One row per CSV record: ``record_id`` (file, split and place) and ``line`` (its text without the last line end).

    With ``header`` the first record of every file is left out. A record that
    the end of a file leaves open ends there. A task holds one record at a time.
    """
    starts = spark.sparkContext.broadcast(split_states(spark, path))

    def cut(batches):
        """Records of each split; pieces that the split before or after shares are marked."""
        now, place, held, inside, first, out = None, 0, [], False, False, []

        def close(is_open: bool):
            nonlocal held, place, first
            text = "\n".join(held)
            if text not in ("", "\r") or first or is_open:
                out.append((*now, place, text, is_open, first))
                place += 1
            held, first = [], False

        for file, start, line in _rows(batches):
            if now != (file, start):
                if held:
                    close(inside)
                now, place = (file, start), 0
                inside = first = starts.value[file, start]
            inside = ends_inside(line, inside)
            held.append(line)
            if not inside:
                close(False)
            if len(out) >= 1000:
                yield _batch(out, _PIECE)
                out = []
        if held:
            close(inside)
        if out:
            yield _batch(out, _PIECE)

    table = scratch_path(spark, "record-pieces")
    _lines(spark, path).mapInArrow(cut, _PIECE).write.parquet(table)
    pieces = spark.read.schema(_PIECE.replace("long", "bigint")).parquet(table)
    whole = pieces.where("not is_open and not is_next")
    # at most two pieces a split: a record starts at an open piece that continues none
    from pyspark.sql import Window
    order = Window.partitionBy("path").orderBy("start", "place")
    parts = pieces.where("is_open or is_next").withColumn(
        "record", F.sum(F.when(F.col("is_next"), 0).otherwise(1)).over(order))
    joined = parts.groupBy("path", "record").agg(F.sort_array(F.collect_list(F.struct("start", "place", "piece"))).alias("p")) \
        .select("path", F.col("p")[0]["start"].alias("start"), F.col("p")[0]["place"].alias("place"),
                F.array_join(F.transform("p", lambda x: x["piece"]), "\n").alias("piece"))
    found = whole.select("path", "start", "place", "piece").unionByName(joined)
    if header:
        top = found.groupBy(F.col("path").alias("_path")).agg(F.min(F.struct("start", "place")).alias("_top"))
        found = found.join(top, F.col("path") == F.col("_path")).where(F.struct("start", "place") > F.col("_top"))
    return found.select(F.concat_ws(":", "path", F.col("start").cast("string"), F.col("place").cast("string")).alias("record_id"),
                        F.regexp_replace("piece", "\r\\z", "").alias("line"))


def read_sales(spark: SparkSession, path, mode: str = "quarantine", **params) -> DataFrame:
    """Raw sale files to repaired records (see ``repair_records``), keyed by ``record_id``."""
    return repair_records(read_records(spark, path), id_col="record_id", mode=mode, **params)
