"""Benchmark decontamination with broadcast n-gram sets.

Every benchmark text gives its windows of ``window`` consecutive normalised
words (an item of fewer words, but not none, is one window). The distinct
windows are counted first; they are cut by hash into blocks of at most
``max_windows``, and each block is broadcast as a hash set. Document scans map
words to benchmark word numbers, compare rolling hashes of whole documents at
once, and verify each hit word by word. Beyond one block the documents take one
pass per block, cut by a written table, so memory stays bounded by the block.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import ROW, cut, pack, small_batches, text_bytes, unpack

WINDOW = 10
MAX_WINDOWS = 500_000       # windows broadcast at a time
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_MULT = np.uint64(0x9E3779B97F4A7C15)


def words_of(data: bytes | None) -> list[bytes]:
    """Normalised words: A-Z lower-cased, runs of digits, letters and non-ASCII."""
    return _WORD.findall((data or b"").lower())


def benchmark_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text",
                      window: int = WINDOW) -> DataFrame:
    """Distinct ``(item, window)``: words joined by one space."""
    src = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("item"), text_bytes(text).alias("b"))

    def run(batches):
        for batch in batches:
            items, grams = [], []
            for item, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                w = words_of(data)
                for i in range(max(1, len(w) - window + 1) if w else 0):
                    items.append(item)
                    grams.append(b" ".join(w[i:i + window]))
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(grams, pa.binary())],
                                             names=["item", "gram"])

    return src.mapInArrow(run, "item string, gram binary").distinct()


class Windows:
    """One block of windows, ready to scan documents."""

    def __init__(self, grams: list[tuple[bytes, list[str]]]):
        self.number: dict[bytes, int] = {}
        by_len: dict[int, list[tuple[np.ndarray, list[str]]]] = {}
        for gram, items in grams:
            ids = np.array([self.number.setdefault(w, len(self.number) + 1) for w in gram.split(b" ")], np.uint32)
            by_len.setdefault(len(ids), []).append((ids, items))
        self.exact = {n: {ids.tobytes(): items for ids, items in v} for n, v in by_len.items()}
        self.hashes = {n: np.sort(self._roll(np.concatenate([ids for ids, _ in v]), n)[::n])
                       for n, v in by_len.items()}

    @staticmethod
    def _roll(ids: np.ndarray, n: int) -> np.ndarray:
        """Hash of each run of ``n`` word numbers."""
        size = len(ids) - n + 1
        h = np.zeros(size, np.uint64)
        for k in range(n):
            h = (h + ids[k:k + size].astype(np.uint64)) * _MULT
            h ^= h >> np.uint64(29)
        return h

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Mark of each word that lies in a window, and the items hit."""
        hit = np.zeros(len(words) + 1, np.int64)
        items: set[str] = set()
        get = self.number.get
        ids = np.fromiter((get(w, 0) for w in words), np.uint32, len(words))
        gaps = np.r_[0, np.cumsum(ids == 0)]
        for n, table in self.hashes.items():
            if len(ids) < n:
                continue
            at = np.flatnonzero(gaps[n:] == gaps[:-n])      # windows of known words only
            if not len(at):
                continue
            h = self._roll(ids, n)[at]
            pos = np.searchsorted(table, h)
            pos[pos == len(table)] = 0
            for i in at[table[pos] == h].tolist():
                found = self.exact[n].get(ids[i:i + n].tobytes())
                if found is not None:
                    items.update(x for x in found if x is not None)
                    hit[i] += 1
                    hit[i + n] -= 1
        return np.cumsum(hit[:-1]) > 0, items


def _runs(mark: np.ndarray) -> list[int]:
    """Starts and ends of the runs of true values, flattened."""
    edge = np.flatnonzero(np.diff(np.r_[False, mark, False].astype(np.int8)))
    return edge.tolist()


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
         bench_text: str = "text", window: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """Packed rows of ``docs`` with what was found in their whole texts.

    Added to the packed row: ``runs`` (word positions where hit stretches
    start and end, alternating), ``items`` (distinct item ids as strings) and
    ``n_words``. Null or empty texts have no words and no hits; an empty
    benchmark hits nothing; null item ids mark words but name no item.
    """
    spark = docs.sparkSession
    small_batches(spark)
    grams = cut(benchmark_windows(benchmark, item_id, bench_text, window)
                .groupBy("gram").agg(F.sort_array(F.collect_set("item")).alias("items")), "windows")
    total = grams.count()
    blocks = max(1, -(-total // max_windows))
    rows = docs.select(pack(docs), text_bytes(text).alias("b"),
                       F.array().cast("array<long>").alias("runs"), F.array().cast("array<string>").alias("items"),
                       F.lit(0).cast("long").alias("n_words"))
    schema = rows.schema
    for k in range(blocks):
        part = grams.filter(F.pmod(F.xxhash64("gram"), F.lit(blocks)) == k).collect()   # at most about max_windows
        data = spark.sparkContext.broadcast([(bytes(r.gram), list(r["items"])) for r in part])
        last, key = k == blocks - 1, uuid.uuid4().hex

        def run(batches, data=data, last=last, key=key):
            windows = _windows(key, data)
            for batch in batches:
                runs, found, n = [], [], []
                old = zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist())
                for value, before, had in old:
                    words = words_of(value.as_py())
                    mark, items = windows.scan(words)
                    for s, e in zip(before[::2], before[1::2]):
                        mark[s:e] = True
                    runs.append(_runs(mark))
                    found.append(sorted(items | set(had)))
                    n.append(len(words))
                body = pa.nulls(batch.num_rows, pa.binary()) if last else batch.column(1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), body, pa.array(runs, pa.list_(pa.int64())),
                     pa.array(found, pa.list_(pa.string())), pa.array(n, pa.int64())],
                    names=[ROW, "b", "runs", "items", "n_words"])

        rows = rows.mapInArrow(run, schema)
        if not last:
            rows = cut(rows, "decontaminate")
    return rows.drop("b")


_LOADED: dict[str, Windows] = {}


def _windows(key: str, data) -> Windows:
    """The block of a broadcast, built once per worker; one block is held."""
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Windows(data.value)
    return _LOADED[key]


def report(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **params) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = scan(docs, benchmark, **params)
    starts = F.expr("aggregate(runs, 0L, (a, x) -> x - a)")      # ends minus starts, alternating
    return found.select(
        F.col(ROW)[doc_id].alias("doc_id"), "n_words", starts.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("runs") > 0).alias("contaminated"))


def remove(docs: DataFrame, benchmark: DataFrame, text: str = "text", whole: bool = True, **params) -> DataFrame:
    """``docs`` without contaminated documents, or with ``whole=False`` without hit spans.

    A removed span takes its words and the characters between them; a text
    without a hit is returned as it is.
    """
    found = scan(docs, benchmark, text=text, **params)
    if whole:
        return unpack(found.filter(F.size("runs") == 0), docs.columns)
    names = docs.columns

    def run(batches):
        for batch in batches:
            cells = batch.column(1).to_pylist()
            out = []
            for value, runs in zip(cells, batch.column(2).to_pylist()):
                if runs:
                    data = value.encode("utf-8")
                    spans = [m.span() for m in _WORD.finditer(data.lower())]
                    kept, at = [], 0
                    for s, e in zip(runs[::2], runs[1::2]):
                        kept.append(data[at:spans[s][0]])
                        at = spans[e - 1][1]
                    value = (b"".join(kept) + data[at:]).decode("utf-8")
                out.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=[ROW, "text"])

    schema = T.StructType([docs.select(pack(docs)).schema[0], T.StructField("text", T.StringType())])
    cleaned = found.select(ROW, F.col(ROW)[text].alias("text"), "runs") \
        .mapInArrow(run, schema)
    return cleaned.select(*[F.col("text").alias(c) if c == text else F.col(ROW)[c].alias(c) for c in names])


def items_digest(items: list[str]) -> str:
    """The digest of a list of item ids, as the report gives it."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
