"""Alignment of two tokenizers over a corpus, scored by inverted pair bitmaps.

Every text is cut by a byte-level tokenizer (A) and a piece tokenizer (B) into
tokens over the same bytes. Places where both end a token cut them into groups;
an A and a B token whose bytes overlap are linked. The corpus-wide number of
links of each id pair comes from an inverted index: documents are numbered
within blocks, and each (pair, block) has compressed document bitmaps, one plane
per binary digit of the pair's multiplicity in a document. The bitmaps of the
batches of a block are OR-merged, popcounts give the pair's documents (of the
planes' union) and links (of the planes, weighted), and the postings carry the
totals back to the documents.

Texts are cut at single blanks between visible characters, where both
tokenizers always end a token, and the alignment of short parts is kept.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import cut, small_batches

# The pre-token pattern of the byte-level tokenizer, and the piece tokenizer's mark of a blank
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
MARK = "▁"

BLOCK_BITS = 12
BLOCK_DOCS = 1 << BLOCK_BITS    # documents of a block; a bitset of one takes 512 bytes
BLOCK_LINKS = 4_000_000         # links after which a block ends, however few documents it has
MERGE_LINKS = 500_000           # links counted into bitmaps at a time
BITSET_FROM = BLOCK_DOCS // 16  # documents from which a bitset is shorter than a list of 16-bit numbers
MEMO_CHARS = 3_000_000          # characters of the parts whose alignment is kept per worker, and of as many older ones
LEARN_PARTS = 300               # new parts encoded as one text
TEXT_CHARS = 1_000_000          # characters of the texts aligned together (or one text)
LONG_PART = 20_000              # longer parts go to the tokenizer whose pattern matcher has no step limit
_BLANK = re.compile(r"(?<=[!-~\w]) (?=[!-~\w])")
_PLAIN = re.compile(r"[!-~\w](?:.*[!-~\w])?", re.S).fullmatch


# ---- compressed bitmaps ----------------------------------------------------------------------------

def pack_bitmap(places: np.ndarray) -> bytes:
    """A set of places below ``BLOCK_DOCS`` (ascending): a list or a bitset, whichever is shorter."""
    if len(places) < BITSET_FROM:
        return places.astype("<u2").tobytes()
    bits = np.zeros(BLOCK_DOCS, np.uint8)
    bits[places] = 1
    return np.packbits(bits).tobytes()


def unpack_bitmap(data: bytes) -> np.ndarray:
    """Places of a bitmap, ascending."""
    raw = np.frombuffer(data, np.uint8)
    if len(raw) < BLOCK_DOCS // 8:
        return raw.view("<u2")
    return np.flatnonzero(np.unpackbits(raw))


def merge_bitmaps(bitmaps: list[bytes]) -> bytes:
    """The union of bitmaps."""
    if len(bitmaps) == 1:
        return bitmaps[0]
    return pack_bitmap(np.unique(np.concatenate([unpack_bitmap(b) for b in bitmaps])) if bitmaps else np.empty(0, int))


def popcount(data: bytes) -> int:
    """Number of places in a bitmap."""
    return len(data) // 2 if len(data) < BLOCK_DOCS // 8 else int.from_bytes(data, "big").bit_count()


# ---- tokenizers ------------------------------------------------------------------------------------

def _byte_chars() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary: visible ones for themselves, others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteTokenizer:
    """A byte-level BPE tokenizer file (JSON); ids and token bytes."""

    def __init__(self, source: str):
        model = json.loads(source)["model"]
        special = {t["content"] for t in json.loads(source).get("added_tokens", ())}
        chars = _byte_chars()
        self.bytes = {i: bytes([chars[c] for c in t]) for t, i in model["vocab"].items() if t not in special}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        ranks = {t: i for i, t in self.bytes.items()}
        joined = [ranks.get(bytes(chars[c] for c in a + b)) for a, b in pairs]
        self.source, self._slow, self.fast = source, None, None
        if None not in joined and all(x < y for x, y in zip(joined, joined[1:])):     # ids are in the order of the merges
            import tiktoken
            self.fast = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @property
    def slow(self):
        if self._slow is None:
            from tokenizers import Tokenizer
            self._slow = Tokenizer.from_str(self.source)
            self._slow.encode_special_tokens = True
        return self._slow

    def encode(self, text: str) -> list[int]:
        if self.fast is None or len(text) > LONG_PART:
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class PieceTokenizer:
    """A piece tokenizer model; ids and token bytes (the mark as a blank). It puts a blank before a text itself."""

    def __init__(self, model: bytes):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(self.model.get_piece_size())
        pieces = [self.model.id_to_piece(i) for i in ids]
        self.bytes = {i: bytes((int(p[3:5], 16),)) if self.model.is_byte(i) else p.replace(MARK, " ").encode()
                      for i, p in zip(ids, pieces)}
        # no piece goes on past a blank, so texts can be cut before one
        self.cuts = not any(MARK in p.lstrip(MARK) for p in pieces)
        self.encode = self.model.encode


# ---- alignment of one text -------------------------------------------------------------------------

class Part(NamedTuple):
    """Alignment of a text or a part of one: B tokens, groups as text, linked id pairs (32 bits each)."""

    n_b: int
    groups: str
    pairs: bytes

    @property
    def n_groups(self) -> int:
        return self.groups.count(";") + 1

    @property
    def n_links(self) -> int:
        return len(self.pairs) // 4

    @property
    def n_a(self) -> int:
        # a link more for every token end of either side, but one where both end
        return self.n_links + self.n_groups - self.n_b


class Aligner:
    """Aligns texts; ``align`` gives None where a tokenizer does not keep the bytes."""

    def __init__(self, a_source: str, b_model: bytes):
        self.a, self.b = ByteTokenizer(a_source), PieceTokenizer(b_model)
        self.memo: dict[str, Part | None] = {}
        self.older: dict[str, Part | None] = {}
        self.weight = 0

    def part(self, text: str) -> Part | None:
        """Alignment of `` `` + ``text`` without cutting it."""
        a, b = self.a.encode(" " + text), self.b.encode(text)
        raw = (" " + text).encode()
        of_a, of_b = self.a.bytes, self.b.bytes
        of_a, of_b = [of_a[i] for i in a], [of_b[i] for i in b]
        if b"".join(of_a) != raw or b"".join(of_b) != raw:
            return None
        groups, pairs = [], []
        i = j = first_a = first_b = 0
        end_a, end_b, last = len(of_a[0]), len(of_b[0]), len(a)
        while True:
            pairs.append(b[j] << 16 | a[i])
            if end_a < end_b:
                i += 1
                end_a += len(of_a[i])
                continue
            if end_b < end_a:
                j += 1
                end_b += len(of_b[j])
                continue
            i, j = i + 1, j + 1
            groups.append(f"{','.join(map(str, a[first_a:i]))}|{','.join(map(str, b[first_b:j]))}")
            if i == last:
                return Part(len(b), ";".join(groups), array("I", pairs).tobytes())
            first_a, first_b = i, j
            end_a, end_b = end_a + len(of_a[i]), end_b + len(of_b[j])

    def _learn(self, parts: list[str]) -> None:
        """Keep the alignment of parts. Those that begin and end with visible characters are encoded as one text."""
        plain = [p for p in parts if _PLAIN(p)]
        for p in parts if len(plain) < len(parts) else ():
            if not _PLAIN(p):
                self.memo[p] = self.part(p)
        for at in range(0, len(plain), LEARN_PARTS):
            some = plain[at:at + LEARN_PARTS]
            text = " ".join(some)
            raw = (" " + text).encode()
            a, b = self.a.encode(" " + text), self.b.encode(text)
            of_a, of_b = [self.a.bytes[i] for i in a], [self.b.bytes[i] for i in b]
            if b"".join(of_a) != raw or b"".join(of_b) != raw:
                self.memo.update((p, self.part(p)) for p in some)
                continue
            ends_a, ends_b = np.cumsum(list(map(len, of_a))), np.cumsum(list(map(len, of_b)))
            ends = np.union1d(ends_a, ends_b)       # between two ends lies the overlap of one linked pair
            pairs = (np.array(b, np.uint32)[np.searchsorted(ends_b, ends)] << 16
                     | np.array(a, np.uint32)[np.searchsorted(ends_a, ends)]).astype("<u4").tobytes()
            both = np.intersect1d(ends_a, ends_b, assume_unique=True)
            to_a, to_b = (np.searchsorted(ends_a, both) + 1).tolist(), (np.searchsorted(ends_b, both) + 1).tolist()
            text_a, text_b = list(map(str, a)), list(map(str, b))
            groups = [f"{','.join(text_a[i:x])}|{','.join(text_b[j:y])}"
                      for i, x, j, y in zip([0, *to_a], to_a, [0, *to_b], to_b)]
            sizes = np.cumsum([len(p.encode()) + 1 for p in some])
            link, group = np.searchsorted(ends, sizes) + 1, np.searchsorted(both, sizes) + 1
            n_b = np.diff(np.searchsorted(ends_b, sizes), prepend=-1).tolist()
            link, group = (4 * link).tolist(), group.tolist()
            for p, n, i, x, j, y in zip(some, n_b, [0, *group], group, [0, *link], link):
                self.memo[p] = Part(n, ";".join(groups[i:x]), pairs[j:y])

    def _know(self, parts: set[str]) -> None:
        """All parts are in the memo afterwards; when it is full, the older half goes."""
        need = parts - self.memo.keys()
        if self.weight > MEMO_CHARS:
            self.older, self.memo, self.weight, need = self.memo, {}, 0, parts
        back = need & self.older.keys()
        self.memo.update((p, self.older[p]) for p in back)
        self._learn(list(need - back))
        self.weight += sum(map(len, need)) + 8 * len(need)

    def align_many(self, texts: list[str | None]) -> list[Part | None]:
        """Alignments of whole texts; null and empty texts have none."""
        if not self.b.cuts:
            return [self.part(t) if t else None for t in texts]
        cut = [_BLANK.split(t) if t else None for t in texts]
        self._know(set().union(*[c for c in cut if c]))
        known, out = self.memo.__getitem__, []
        for t, c in zip(texts, cut):
            found = list(map(known, c)) if c else []
            if None in found:
                out.append(self.part(t))        # where a part loses bytes the whole text decides
            elif found:
                out.append(Part(sum([p[0] for p in found]), ";".join([p[1] for p in found]), b"".join([p[2] for p in found])))
            else:
                out.append(None)
        return out

    def align(self, text: str | None) -> Part | None:
        return self.align_many([text])[0]


@lru_cache(maxsize=2)
def _aligner(a_source: str, b_model: bytes) -> Aligner:
    return Aligner(a_source, b_model)


# ---- index -----------------------------------------------------------------------------------------

def aligned(aligner: Aligner, column: pa.Array):
    """Alignments of a column of texts, a bounded number of characters at a time."""
    held, size = [], 0
    for value in column:
        held.append(value.as_py())
        size += len(held[-1] or "")
        if size >= TEXT_CHARS:
            yield from aligner.align_many(held)
            held, size = [], 0
    yield from aligner.align_many(held)


class Block:
    """Bitmaps of the pairs of up to ``BLOCK_DOCS`` documents."""

    def __init__(self):
        self.docs = self.links = self.waiting = 0
        self.raw: list[np.ndarray] = []                         # pair << BLOCK_BITS | place, links not yet counted
        self.counted: list[tuple[np.ndarray, np.ndarray]] = []  # keys and multiplicities of earlier batches

    def add(self, pairs: bytes) -> int:
        """Take a document's links; returns its place."""
        place, self.docs = self.docs, self.docs + 1
        key = np.frombuffer(pairs, "<u4").astype(np.int64) << BLOCK_BITS | place
        self.raw.append(key)
        self.links += len(key)
        self.waiting += len(key)
        if self.waiting >= MERGE_LINKS:
            self._count()
        return place

    def _count(self) -> None:
        if self.raw:
            self.counted.append(np.unique(np.concatenate(self.raw), return_counts=True))
            self.raw, self.waiting = [], 0

    def full(self) -> bool:
        return self.docs >= BLOCK_DOCS or self.links >= BLOCK_LINKS

    def rows(self):
        """(pair, documents, links, planes) of each pair: the batches' bitmaps merged, then counted."""
        self._count()
        if not self.links:
            return
        keys, times = (np.concatenate(x) for x in zip(*self.counted))
        order = np.argsort(keys, kind="stable")     # a document lies in one batch, so the union has no place twice
        keys, times = keys[order], times[order]
        pair, place = keys >> BLOCK_BITS, keys & (BLOCK_DOCS - 1)
        starts = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
        ends = np.r_[starts[1:], len(pair)]
        links, most = np.add.reduceat(times, starts), np.maximum.reduceat(times, starts)
        short = place.astype("<u2")
        for p, i, j, n, m in zip(pair[starts].tolist(), starts.tolist(), ends.tolist(), links.tolist(), most.tolist()):
            if m == 1:
                planes = [short[i:j].tobytes() if j - i < BITSET_FROM else pack_bitmap(place[i:j])]
            else:
                planes = [pack_bitmap(place[i:j][times[i:j] >> d & 1 == 1]) for d in range(m.bit_length())]
            yield p, j - i, n, planes


_INDEX = [("block", T.LongType(), pa.int64()), ("place", T.IntegerType(), pa.int32()),
          ("n_a", T.LongType(), pa.int64()), ("n_b", T.LongType(), pa.int64()), ("n_groups", T.LongType(), pa.int64()),
          ("n_links", T.LongType(), pa.int64()), ("groups", T.StringType(), pa.string()),
          ("groups_sha256", T.StringType(), pa.string()), ("pair", T.IntegerType(), pa.int32()),
          ("docs", T.LongType(), pa.int64()), ("links", T.LongType(), pa.int64()),
          ("planes", T.ArrayType(T.BinaryType()), pa.list_(pa.binary()))]
_ROWS = 20_000      # index rows handed on at a time


def default_paths() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", paths: tuple[str, str] | None = None,
                keep_groups: bool = False) -> DataFrame:
    """A written table of two kinds of rows: one per document (``pair`` null) and one per (pair, block).

    Texts that are null or empty, or whose bytes a tokenizer does not keep, have
    no tokens: zeros and an empty ``groups_sha256``. Repeated rows and null ids
    keep their rows; other columns are not read. The tokenizer files are read on
    the driver and broadcast (their size does not depend on the data).
    """
    spark = docs.sparkSession
    small_batches(spark)
    a_path, b_path = paths or default_paths()
    with open(a_path, encoding="utf-8") as f, open(b_path, "rb") as g:
        files = spark.sparkContext.broadcast((f.read(), g.read()))
    src = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    schema = T.StructType([src.schema[0], *[T.StructField(n, t) for n, t, _ in _INDEX]])

    def run(batches):
        aligner, part = _aligner(*files.value), TaskContext.get().partitionId()
        block, number, id_type = Block(), part << 32, None

        def batch_of(ids, rows):
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays([ids, *[pa.array(c, t) for c, (_, _, t) in zip(cols, _INDEX)]],
                                              names=["doc_id", *[n for n, _, _ in _INDEX]])

        def postings():
            held = []
            for pair, n_docs, n_links, planes in block.rows():
                held.append((number, *[None] * 7, pair, n_docs, n_links, planes))
                if len(held) >= _ROWS:
                    yield batch_of(pa.nulls(len(held), id_type), held)
                    held = []
            if held:
                yield batch_of(pa.nulls(len(held), id_type), held)

        for batch in batches:
            ids, id_type, rows, done = batch.column(0), batch.column(0).type, [], 0
            for p in aligned(aligner, batch.column(1)):
                if p is None:
                    rows.append((number, block.add(b""), 0, 0, 0, 0, "" if keep_groups else None, "", *[None] * 4))
                else:
                    rows.append((number, block.add(p.pairs), p.n_a, p.n_b, p.n_groups, p.n_links,
                                 p.groups if keep_groups else None, hashlib.sha256(p.groups.encode()).hexdigest(),
                                 *[None] * 4))
                if block.full():
                    yield batch_of(ids.slice(done, len(rows)), rows)
                    rows, done = [], done + len(rows)
                    yield from postings()
                    block, number = Block(), number + 1
            if rows:
                yield batch_of(ids.slice(done, len(rows)), rows)
        yield from postings()

    return cut(src.mapInArrow(run, schema), "align-index")


def pair_counts(index: DataFrame) -> DataFrame:
    """(pair, a, b, n_docs, n_links, is_best) of every linked id pair of the corpus; ``is_best`` is the most links of its B id."""
    pairs = index.where("pair is not null").groupBy("pair").agg(
        F.sum("docs").alias("n_docs"), F.sum("links").alias("n_links"))
    pairs = cut(pairs.withColumns({"a": F.col("pair").bitwiseAND(0xFFFF), "b": F.shiftright("pair", 16)}), "align-pairs")
    most = pairs.groupBy("b").agg(F.max("n_links").alias("most"))
    # one row per B id: at most the size of its vocabulary
    return pairs.join(F.broadcast(most), "b").select("pair", "a", "b", "n_docs", "n_links",
                                                     (F.col("n_links") == F.col("most")).alias("is_best"))


def scored(index: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 (and groups)."""
    counts = pair_counts(index).select("pair", F.col("n_links").alias("count"), "is_best")
    post = index.where("pair is not null")
    # totals go to the blocks that need them; only there do they meet the bitmaps, which are shuffled once
    asked = post.select("pair", "block").join(counts, "pair").select(
        "block", "pair", "count", "is_best", F.lit(None).cast("array<binary>").alias("planes"))
    rows = asked.unionByName(post.select("block", "pair", F.lit(0).cast("long").alias("count"),
                                         F.lit(False).alias("is_best"), "planes"))

    def run(batches):
        now, total, best, known = None, None, None, {}
        names = ["block", "place", "count_sum", "n_best"]

        def flush():
            at = np.flatnonzero(total)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(at), now)), pa.array(at.astype(np.int32)),
                                               pa.array(total[at]), pa.array(best[at])], names=names)

        for batch in batches:
            planes = batch.column(4)
            empty = planes.is_null().to_pylist()
            for i, (block, pair, count, good) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(4)))):
                if block != now:
                    if now is not None:
                        yield flush()
                    now, known = block, {}
                    total, best = np.zeros(BLOCK_DOCS, np.int64), np.zeros(BLOCK_DOCS, np.int64)
                if empty[i]:
                    known[pair] = (count, good)
                    continue
                count, good = known[pair]
                for digit, plane in enumerate(planes[i]):
                    at = unpack_bitmap(plane.as_buffer())
                    total[at] += count << digit
                    if good:
                        best[at] += 1 << digit
        if now is not None:
            yield flush()

    sums = rows.repartition("block").sortWithinPartitions("block", F.col("planes").isNotNull()).mapInArrow(
        run, "block long, place int, count_sum long, n_best long")
    docs = index.where("pair is null")
    out = docs.join(sums, ["block", "place"], "left")
    keep = ["groups"] if "groups" in index.columns else []
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
                      F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256", *keep)


def align(docs: DataFrame, **params) -> DataFrame:
    """Alignment figures of every document (see ``build_index`` and ``scored``)."""
    return scored(build_index(docs, **params))
