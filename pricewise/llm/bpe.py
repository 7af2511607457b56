"""Byte-level BPE by a lazily determinised transducer, and streaming decode.

Encoding. Two facts make byte-pair merging a finite-state job. A token
sequence is the merge result of its text if and only if every two neighbours
``(u, v)`` are what merging ``u + v`` alone gives (merges in disjoint places
commute, so the first merge that would cross a token border would also happen
in those two tokens alone). And the merge result of a prefix extends the merge
result of the prefix before its last token. So after each byte exactly one
token ends there whose left neighbour fits, and the past matters only through
the positions from which a longer token may still start. A state holds those
positions and the token that ends at each; reading a byte gives the token that
ends there. Tokens that the chains of all open positions share are certain and
are emitted, a bounded number of bytes behind the read position; the end of a
pre-token flushes the rest. States and transitions are built on first use and
dropped together beyond ``max_states``.

Decoding. Ids are mapped to bytes and fed to a byte-driven UTF-8 machine
whose transitions per (state, token) are also built on first use: characters
split over tokens are completed, malformed bytes become U+FFFD.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import small_batches, text_bytes

MAX_STATES = 250_000        # lazily built transducer states kept per worker
MAX_FITS = 300_000          # checked token pairs kept per worker
EMIT_EVERY = 256            # bytes of one pre-token between two emissions
MAX_MEMO = 500_000          # pre-tokens whose ids are kept per worker
SEEN_BYTES = 1 << 22        # size of the map of pre-tokens seen once
MEMO_BYTES = 48             # longer pre-tokens always run through the transducer
DECODE_STEP = 65_536        # ids decoded at a time


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 token and rank."""
    return {base64.b64decode(t): int(r) for t, r in (ln.split() for ln in raw.splitlines() if ln.strip())}


_NONE = 1 << 60


def _merge(data: bytes, ranks: dict[bytes, int], border: int = 0) -> list[bytes]:
    """Byte-pair merging: lowest rank first, leftmost among equals.

    With a ``border`` (a byte offset) it stops at the first merge across it
    and returns nothing.
    """
    parts = [data[i:i + 1] for i in range(len(data))]
    joined = [ranks.get(data[i:i + 2], _NONE) for i in range(len(data) - 1)]
    left = border or len(data) + 1
    while joined:
        best = min(joined)
        if best == _NONE:
            break
        i = joined.index(best)
        if i + 1 == left:
            return []
        if i < left:
            left -= 1
        parts[i] += parts.pop(i + 1)
        del joined[i]
        if i:
            joined[i - 1] = ranks.get(parts[i - 1] + parts[i], _NONE)
        if i < len(joined):
            joined[i] = ranks.get(parts[i] + parts[i + 1], _NONE)
    return parts


class Transducer:
    """Merge transducer of one rank table; tokens are named by their ranks.

    A state is a number; ``about`` holds what it stands for: the shortest end
    of the input that holds every open position, and per open position its
    offset there and the token that ends at it (-1 at the start), flattened.
    ``steps`` maps state and byte to one packed number: the token that ends
    after the byte, its length and the next state. Plain numbers keep a worker
    small.
    """

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        if len({t for t in ranks if len(t) == 1}) != 256:
            raise ValueError("the rank table lacks single-byte tokens")
        self.ranks, self.max_states = ranks, max_states
        self.token = {r: t for t, r in ranks.items()}
        self.prefixes = {t[:k] for t in ranks for k in range(1, len(t))}
        self.fits: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        self.number: dict[tuple, int] = {}
        self.about: list[tuple] = []
        self.steps: dict[int, int] = {}
        self._state(b"", (0, -1))

    def _state(self, tail: bytes, opened: tuple) -> int:
        key = (tail, opened)
        s = self.number.get(key)
        if s is None:
            s = self.number[key] = len(self.about)
            self.about.append(key)
        return s

    def _is_token(self, rank: int) -> bool:
        ok = self.whole.get(rank)
        if ok is None:
            t = self.token[rank]
            ok = self.whole[rank] = _merge(t, self.ranks) == [t]
        return ok

    def _fit(self, left: int, right: int) -> bool:
        key = left << 32 | right
        ok = self.fits.get(key)
        if ok is None:
            if len(self.fits) >= MAX_FITS:
                self.fits.clear()
            u, v = self.token[left], self.token[right]
            ok = self.fits[key] = len(_merge(u + v, self.ranks, len(u))) == 2
        return ok

    def _step(self, s: int, byte: int) -> int:
        tail, places = self.about[s]
        tail += bytes((byte,))
        for offset, left in zip(places[::2], places[1::2]):
            rank = self.ranks.get(tail[offset:])
            if rank is not None and self._is_token(rank) and (left < 0 or self._fit(left, rank)):
                break
        else:
            raise ValueError("the rank table gives no merge result")
        opened = [(o, u) for o, u in zip(places[::2], places[1::2]) if tail[o:] in self.prefixes]
        opened.append((len(tail), rank))
        first = opened[0][0]
        state = self._state(tail[first:], tuple(x for o, u in opened for x in (o - first, u)))
        step = self.steps[s << 8 | byte] = rank << 48 | len(self.token[rank]) << 32 | state
        return step

    def tokens(self, data: bytes) -> list[int]:
        """The merge result of one pre-token, as ranks."""
        out: list[int] = []
        ends: list[int] = []            # per byte since the last emission: the step that reads it
        s, wait, known = 0, EMIT_EVERY, self.steps
        for byte in data:
            step = known.get(s << 8 | byte)
            if step is None:
                if len(self.about) >= self.max_states:
                    keep = self.about[s]
                    self._reset()
                    known, s = self.steps, self._state(*keep)
                step = self._step(s, byte)
            ends.append(step)
            s = step & 0xFFFFFFFF
            if len(ends) >= wait:
                wait = EMIT_EVERY + self._emit(ends, self.about[s], out)
        out += self._chain(ends, len(ends))
        return out

    @staticmethod
    def _chain(ends: list[int], at: int) -> list[int]:
        """The tokens that lead to a position."""
        back = []
        while at:
            step = ends[at - 1]
            back.append(step >> 48)
            at -= step >> 32 & 0xFFFF
        back.reverse()
        return back

    def _emit(self, ends: list[int], state: tuple, out: list[int]) -> int:
        """Emit what all open positions agree on; returns the bytes still held."""
        shared = None
        tail, opened = state
        for offset in opened[::2]:
            at, border = len(ends) - len(tail) + offset, set()
            while at > 0:
                border.add(at)
                at -= ends[at - 1] >> 32 & 0xFFFF
            shared = border if shared is None else shared & border
        if shared:
            upto = max(shared)
            out += self._chain(ends, upto)
            del ends[:upto]
        return len(ends)


class _Memo(dict):
    """Pre-token to its ids as little-endian bytes.

    Short ones are kept from their second occurrence on: a bitmap of hashes
    remembers first ones, so rare words do not drive out frequent ones. When
    full, the older half of the entries goes.
    """

    def __init__(self, machine: Transducer):
        super().__init__()
        self.machine = machine
        self.seen = bytearray(SEEN_BYTES)

    def __missing__(self, piece: str) -> bytes:
        data = piece.encode("utf-8")
        ids = _le(array("I", self.machine.tokens(data)))
        if len(data) <= MEMO_BYTES:
            at = hash(piece) % SEEN_BYTES
            if not self.seen[at]:
                self.seen[at] = 1
                return ids
            if len(self) >= MAX_MEMO:
                for old in list(self)[:MAX_MEMO // 2]:
                    del self[old]
                self.seen = bytearray(SEEN_BYTES)
            self[piece] = ids
        return ids


def _le(a: array) -> bytes:
    if sys.byteorder != "little":
        a.byteswap()
    return a.tobytes()


class Utf8Machine:
    """Incremental UTF-8 decoding of a token stream.

    The state is the bytes of an unfinished character (at most three). A
    transition takes a token and gives finished text and the next state.
    """

    def __init__(self, tokens: dict[int, bytes]):
        self.bytes_of = tokens
        self.steps: dict[bytes, dict[int, tuple[str, bytes]]] = {}

    @staticmethod
    def _byte(pending: bytes, byte: int) -> tuple[str, bytes]:
        if pending:
            need, first = _LENGTH[pending[0]], pending[0]
            low, high = _SECOND.get(first, (0x80, 0xBF)) if len(pending) == 1 else (0x80, 0xBF)
            if low <= byte <= high:
                pending += bytes((byte,))
                return (pending.decode("utf-8"), b"") if len(pending) == need else ("", pending)
            text, rest = Utf8Machine._byte(b"", byte)
            return "�" + text, rest
        if byte < 0x80:
            return chr(byte), b""
        return ("", bytes((byte,))) if byte in _LENGTH else ("�", b"")

    def _step(self, state: bytes, token: int) -> tuple[str, bytes]:
        out, at = [], state
        for byte in self.bytes_of[token]:
            text, at = self._byte(at, byte)
            out.append(text)
        step = self.steps[state][token] = ("".join(out), at)
        return step

    def feed(self, ids: Iterable[int], state: bytes = b"") -> tuple[str, bytes]:
        """Finished text of some ids, and the state to go on with."""
        row, out = self.steps.setdefault(state, {}), []
        add = out.append
        for i in ids:
            step = row.get(i)
            if step is None:
                step = self._step(state, i)
            add(step[0])
            if step[1] != state:
                state = step[1]
                row = self.steps.setdefault(state, {})
        return "".join(out), state

    def decode(self, ids: array) -> Iterator[str]:
        """Text of all ids, in pieces; an unfinished character at the end becomes U+FFFD."""
        state = b""
        for at in range(0, len(ids), DECODE_STEP):
            text, state = self.feed(ids[at:at + DECODE_STEP], state)
            yield text
        if state:
            yield "\ufffd"


# Fixed values of UTF-8: sequence length by first byte, narrower second-byte ranges.
_LENGTH = {b: 2 if b < 0xE0 else 3 if b < 0xF0 else 4 for b in range(0xC2, 0xF5)}
_SECOND = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}


# Ranges of code points that became letters or numbers after Unicode 16, the
# version whose classes the public encoder uses. Splitting sees an unassigned one in their place.
UNASSIGNED = "\u0378"
LATER_LETTERS = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC),
    (0x208F, 0x208F), (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4),
    (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF),
    (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB),
    (0x11DF1, 0x11DF1), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF3), (0x187F8, 0x187FF),
    (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2),
    (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81),
    (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5),
    (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E),
    (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
]
LATER_NUMBERS = [(0x11DE0, 0x11DE9), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16FF4, 0x16FF6)]


def _ranges(pairs: list[tuple[int, int]]) -> str:
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in pairs)


def _lead_bytes(pairs: list[tuple[int, int]]) -> bytes:
    """The bytes with which the UTF-8 forms of some code points begin."""
    return bytes(sorted({b for lo, hi in pairs
                         for b in range(chr(lo).encode("utf-8")[0], chr(hi).encode("utf-8")[0] + 1)}))


# What the classes of a pre-token pattern hold among ASCII characters.
ASCII_CLASSES = {r"\p{L}": "A-Za-z", r"\p{N}": "0-9", r"\s": r"\t-\r\x20"}


def ascii_pattern(pattern: str) -> re.Pattern | None:
    """A pattern that splits ASCII texts as ``pattern`` does, for the faster standard matcher.

    None if ``pattern`` uses what cannot be carried over.
    """
    if "[]" in pattern or "[^]" in pattern:
        return None
    out, inside, space = [], False, ASCII_CLASSES[r"\s"]
    for part in re.findall(r"\\[pP]\{\w+\}|\\.|.", pattern, re.DOTALL):
        if part in ASCII_CLASSES:
            part = ASCII_CLASSES[part] if inside else f"[{ASCII_CLASSES[part]}]"
        elif part == r"\S":
            if inside:
                return None
            part = f"[^{space}]"
        elif part in "[]":
            inside = part == "["
        out.append(part)
    try:
        return re.compile("".join(out))
    except re.error:
        return None


class Codec:
    """Encoder and decoder of one rank file and pre-token pattern."""

    def __init__(self, raw: bytes, pattern: str):
        ranks = parse_ranks(raw)
        self.pattern = regex.compile(pattern)
        self.ascii = ascii_pattern(pattern) or self.pattern
        self.later = re.compile(f"[{_ranges(LATER_LETTERS + LATER_NUMBERS)}]")
        self.later_leads = _lead_bytes(LATER_LETTERS + LATER_NUMBERS)
        self.memo = _Memo(Transducer(ranks))
        self.utf8 = Utf8Machine({r: t for t, r in ranks.items()})

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        memo = self.memo
        return b"".join([memo[p] for p in self.split(text)])

    def split(self, text: str) -> list[str]:
        """The pre-tokens, classes of characters as of Unicode 16."""
        if text.isascii():
            return self.ascii.findall(text)
        data = text.encode("utf-8")     # most texts hold no byte that a later character begins with
        if len(data.translate(None, self.later_leads)) == len(data) or not self.later.search(text):
            return self.pattern.findall(text)
        plain = self.later.sub(UNASSIGNED, text)
        return [text[m.start():m.end()] for m in self.pattern.finditer(plain)]

    def decode(self, ids: bytes) -> Iterator[str]:
        """Text of little-endian ids, in pieces."""
        a = array("I")
        a.frombytes(ids)
        if sys.byteorder != "little":
            a.byteswap()
        return self.utf8.decode(a)


@lru_cache(maxsize=4)
def _codec(raw: bytes, pattern: str) -> Codec:
    return Codec(raw, pattern)


def default_vocabulary() -> tuple[str, str]:
    """Path of the multilingual rank file and its pre-token pattern."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def _digest(pieces: Iterator[str]) -> str:
    h = hashlib.sha256()
    for p in pieces:
        h.update(p.encode("utf-8"))
    return h.hexdigest()


def encode(docs: DataFrame, columns: list[str], path: str | None = None, pattern: str | None = None,
           text: str = "text", keep_ids: bool = True) -> DataFrame:
    """Encode and decode the whole text of every row.

    Returns ``columns`` and ``n_tokens`` (long), ``ids_sha256``,
    ``decoded_sha256`` and, with ``keep_ids``, ``ids`` (the ids as bytes,
    little-endian unsigned 32-bit). A null text is an empty one: no ids and
    the digest of nothing. Every row gives one row, repeated rows too. Input
    columns that are named like an added one must be left out of ``columns``;
    all others may have any name. The rank file is read on the driver (its
    size is that of the vocabulary) and broadcast.
    """
    spark = docs.sparkSession
    small_batches(spark)
    if path is None:
        path, default = default_vocabulary()
        pattern = pattern or default
    if not pattern:
        raise ValueError("a pre-token pattern is needed")
    with open(path, "rb") as f:
        raw = spark.sparkContext.broadcast(f.read())
    kept = docs.select(*[F.col(f"`{c}`") for c in columns])
    clash = set(columns) & {"n_tokens", "ids_sha256", "decoded_sha256", "ids"}
    if clash:
        raise ValueError(f"columns clash with results: {sorted(clash)}")
    added = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
             T.StructField("decoded_sha256", T.StringType())]
    if keep_ids:
        added.append(T.StructField("ids", T.BinaryType()))
    schema = T.StructType([*kept.schema.fields, *added])

    def run(batches):
        codec = _codec(raw.value, pattern)
        for batch in batches:
            n, ids_sha, dec_sha, all_ids = [], [], [], []
            for value in batch.column(batch.num_columns - 1):
                data = value.as_py()
                ids = codec.encode(data.decode("utf-8", "replace")) if data else b""
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                dec_sha.append(_digest(codec.decode(ids)))
                if keep_ids:
                    all_ids.append(ids)
            cols = [batch.column(i) for i in range(len(columns))]
            names = list(columns) + ["n_tokens", "ids_sha256", "decoded_sha256"]
            cols += [pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(dec_sha, pa.string())]
            if keep_ids:
                cols.append(pa.array(all_ids, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.select(*[F.col(f"`{c}`") for c in columns], text_bytes(text).alias("__bytes")).mapInArrow(run, schema)
