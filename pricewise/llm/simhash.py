"""SimHash near-duplicates: a distributed binary-trie self-join.

Fingerprints link at ``distance`` or fewer differing bits. The 64 bits are cut
into blocks; two linked fingerprints agree on all but at most ``distance``
blocks, so for every choice of ``distance`` free blocks a trie is built that
reads the other blocks first, where no error is allowed. Those leading bits
are the shuffle key; below them hang the sub-tries over the free bits. A
sub-trie holds at most 2^(free bits) distinct fingerprints (2^19 with the
defaults), whatever the data, so no key can outgrow a task.

Inside a sub-trie, pairs of nodes are traversed together from the root: both
children with both children, counting one error where the bits differ, and
dropping a pair of nodes once the errors exceed the budget. A sub-trie is a
sorted array (a node is a range of it), and the frontier of node pairs of many
sub-tries advances level by level in numpy, in blocks of bounded size. What a
sub-trie finds is reduced to a spanning forest before it leaves the task, so
edges never outnumber fingerprints times tries. Components are then joined
across tries by ``components``.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import ROW, cut, pack, small_batches, text_bytes, unpack
from .components import connected_components

SHINGLE_WORDS = 3
DISTANCE = 2
BLOCKS = 7
FRONTIER = 200_000          # node pairs expanded at a time
JOIN_ROWS = 50_000          # rows of whole sub-tries joined at a time, at least
HASH_STEP = 200_000         # shingles whose bits are counted at a time


def fingerprint(data: bytes | None, words_per_shingle: int = SHINGLE_WORDS, seed: int = 42) -> int:
    """64-bit SimHash of a text's UTF-8 bytes; no word gives zero."""
    words = (data or b"").lower().split()       # ASCII case and ASCII white space only
    n, k = len(words), words_per_shingle
    if not n:
        return 0
    if n < k:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    h64 = xxhash.xxh64_intdigest
    total = n - k + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, total, HASH_STEP):
        part = words[at:at + HASH_STEP + k - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(k))))
        h = np.fromiter((h64(s, seed) for s in shingles), "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, columns: list[str], text: str = "text",
                 words_per_shingle: int = SHINGLE_WORDS, name: str = "fp") -> DataFrame:
    """``columns`` and the fingerprint as a (signed) long, one row per input row."""
    small_batches(docs.sparkSession)
    kept = docs.select(*[F.col(f"`{c}`") for c in columns])
    schema = T.StructType([*kept.schema.fields, T.StructField(name, T.LongType())])

    def run(batches):
        for batch in batches:
            fp = [fingerprint(v.as_py(), words_per_shingle) for v in batch.column(len(columns))]
            cols = [batch.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays(
                cols + [pa.array(np.array(fp, np.uint64).view(np.int64))], names=[*columns, name])

    return docs.select(*[F.col(f"`{c}`") for c in columns], text_bytes(text).alias("__bytes")).mapInArrow(run, schema)


def _layout(blocks: int, free: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Per trie the mask of its leading bits and the (shift, width) of its free blocks."""
    borders = [round(64 * i / blocks) for i in range(blocks + 1)]
    out = []
    for chosen in combinations(range(blocks), free):
        spans = [(borders[i], borders[i + 1] - borders[i]) for i in chosen]
        mask = (1 << 64) - 1
        for shift, width in spans:
            mask &= ~(((1 << width) - 1) << shift)
        out.append((mask, spans))
    return out


def _forest(labels: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Join the sets of ``x[i]`` and ``y[i]``; ``labels`` point at set minima."""
    while len(x):
        a, b = labels[x], labels[y]
        open_ = a != b
        if not open_.any():
            return
        x, y, a, b = x[open_], y[open_], a[open_], b[open_]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels[:] = up


def trie_links(value: np.ndarray, group: np.ndarray, bits: int, distance: int) -> np.ndarray:
    """Spanning-forest labels of the linked entries of many sub-tries.

    ``value`` (free bits) is sorted and distinct within each run of ``group``.
    Returns per entry the position of the first entry of its set.
    """
    n = len(value)
    labels = np.arange(n)
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    ends = np.r_[starts[1:], n]
    many = ends - starts > 1
    lo, hi = starts[many], ends[many]
    if not len(lo):
        return labels
    ones: dict[int, np.ndarray] = {}
    stack = [(bits - 1, lo, hi, lo, hi, np.zeros(len(lo), np.int8))]
    while stack:
        bit, alo, ahi, blo, bhi, err = stack.pop()
        if len(alo) > FRONTIER:
            stack += [(bit, *(v[i:i + FRONTIER] for v in (alo, ahi, blo, bhi, err)))
                      for i in range(0, len(alo), FRONTIER)]
            continue
        single = (ahi - alo == 1) & (bhi - blo == 1)
        if single.any():                # two leaves: the bits left decide
            a, b, e = alo[single], blo[single], err[single]
            left = (value[a] ^ value[b]) & np.uint64((1 << (bit + 1)) - 1)
            near = (e + np.bitwise_count(left) <= distance) & (a != b)
            _forest(labels, a[near], b[near])
            rest = ~single
            alo, ahi, blo, bhi, err = alo[rest], ahi[rest], blo[rest], bhi[rest], err[rest]
        if not len(alo):
            continue
        if bit not in ones:
            ones[bit] = np.r_[0, np.cumsum((value >> np.uint64(bit)) & np.uint64(1))].astype(np.int64)
        c = ones[bit]
        amid, bmid = ahi - (c[ahi] - c[alo]), bhi - (c[bhi] - c[blo])
        same = alo == blo
        parts = [(alo, amid, blo, bmid, err), (amid, ahi, bmid, bhi, err),
                 (alo, amid, bmid, bhi, err + 1),
                 (amid[~same], ahi[~same], blo[~same], bmid[~same], err[~same] + 1)]
        nxt = [np.concatenate(v) for v in zip(*parts)]
        live = (nxt[1] > nxt[0]) & (nxt[3] > nxt[2]) & (nxt[4] <= distance)
        live &= ~((nxt[0] == nxt[2]) & (nxt[1] - nxt[0] == 1))
        stack.append((bit - 1, *(v[live] for v in nxt)))
    return labels


def trie_edges(distinct: DataFrame, fp: str = "fp", distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """Spanning edges ``(a, b)`` of the links between distinct fingerprints."""
    layout = _layout(blocks, distance)
    signed = [m - (1 << 64) if m >> 63 else m for m, _ in layout]
    keyed = distinct.select(F.col(fp).alias("fp")).filter("fp is not null").select(
        "fp", F.explode(F.array(*[F.struct(F.lit(i).alias("trie"), F.col("fp").bitwiseAND(F.lit(m)).alias("head"))
                                  for i, m in enumerate(signed)])).alias("k")).select("k.trie", "k.head", "fp")
    spans = [s for _, s in layout]
    bits = max(sum(w for _, w in s) for s in spans)

    def links(trie, head, fps):
        u = fps.view(np.uint64)
        value = np.zeros(len(u), np.uint64)
        for t in np.unique(trie):
            at = trie == t
            v = np.zeros(int(at.sum()), np.uint64)
            for shift, width in spans[t]:
                v = (v << np.uint64(width)) | ((u[at] >> np.uint64(shift)) & np.uint64((1 << width) - 1))
            value[at] = v
        group = np.cumsum(np.r_[False, (trie[1:] != trie[:-1]) | (head[1:] != head[:-1])])
        order = np.lexsort((value, group))
        labels = trie_links(value[order], group[order], bits, distance)
        ends = fps[order]
        far = labels != np.arange(len(labels))
        return pa.RecordBatch.from_arrays([pa.array(ends[far]), pa.array(ends[labels[far]])], names=["a", "b"])

    def run(batches):
        held: list[tuple] = []          # rows not yet joined; the last sub-trie may go on in the next batch
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            held.append(cols)
            size += len(cols[0])
            if size < JOIN_ROWS or (cols[0][0] == cols[0][-1] and cols[1][0] == cols[1][-1]):
                continue
            trie, head, fps = (np.concatenate([h[i] for h in held]) for i in range(3))
            last = int(np.flatnonzero((trie != trie[-1]) | (head != head[-1]))[-1]) + 1
            yield links(trie[:last], head[:last], fps[:last])
            held = [(trie[last:], head[last:], fps[last:])]
            size = len(held[0][0])
        if held:
            yield links(*(np.concatenate([h[i] for h in held]) for i in range(3)))

    return (keyed.repartition("trie", "head").sortWithinPartitions("trie", "head", "fp")
            .mapInArrow(run, "a long, b long"))


def linked(distinct: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """``(fp, root)`` of every distinct fingerprint that is linked to another."""
    return connected_components(trie_edges(distinct, distance=distance, blocks=blocks)) \
        .selectExpr("node as fp", "component as root")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    words_per_shingle: int = SHINGLE_WORDS, distance: int = DISTANCE,
                    blocks: int = BLOCKS) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` per row.

    ``component_id`` is the smallest document id reachable over links, the
    document's own included. Null and empty texts have no word, hence the zero
    fingerprint, which links like any other. Rows with a null id keep a row;
    their component takes the smallest id that is not null, or null if there
    is none. Repeated rows give repeated rows. Other columns are not read.
    """
    src = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    fps = cut(fingerprints(src, ["doc_id"], words_per_shingle=words_per_shingle), "simhash")
    first = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    root = first.join(linked(first, distance, blocks), "fp", "left") \
        .select("fp", F.coalesce("root", "fp").alias("root"), "first")
    least = cut(root.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-least")
    table = cut(root.join(least, "root").select("fp", "component_id"), "simhash-component")
    return fps.join(table, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **params) -> DataFrame:
    """One row of every group of linked documents, with the columns of ``docs``.

    The row with the smallest id stays (null ids last, then the smaller text
    hash). Each task first reduces its own rows per fingerprint, so a group
    that holds a third of all rows is shuffled as one row per task.
    """
    k = params.pop("words_per_shingle", SHINGLE_WORDS)
    packed = docs.select(pack(docs), F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    rows = fingerprints(packed, [ROW], words_per_shingle=k)
    order = F.struct(F.col(ROW)[doc_id].isNull(), F.col(ROW)[doc_id], F.xxhash64(F.col(ROW)[text]))
    best = cut(rows.groupBy("fp").agg(F.min(order).alias("o"), F.min_by(ROW, order).alias(ROW)), "simhash-best")
    comp = cut(linked(best.select("fp"), **params), "simhash-linked")
    ranked = comp.join(best.select("fp", "o"), "fp")
    winner = ranked.groupBy("root").agg(F.min(F.struct("o", "fp")).alias("w"))
    losers = cut(ranked.join(cut(winner, "simhash-winner"), "root").filter("fp != w.fp").select("fp"),
                 "simhash-losers")
    return unpack(best.join(losers, "fp", "left_anti"), docs.columns)
