"""Token counts by greedy longest match in linear time.

A word is cut from the left into the longest vocabulary pieces. Instead of
looking again for each piece, a vocabulary trie gets a failure link and a
popped-token count per node: when no child fits, the pieces certain to be cut
off are counted at once and matching goes on at the node for what is left. So
every symbol is read once, whatever the pieces are, and none is built.

Symbols are bytes. A word is preceded by the vocabulary's word mark, as pieces
at the start of a word carry it. Every single byte is a piece too (byte
fallback), so every word can be cut.
"""

from __future__ import annotations

from collections import deque
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import small_batches, text_bytes

MARK = "\u2581".encode()    # fixed value: the word mark of the vocabulary
MAX_MEMO = 400_000          # words whose counts are kept per worker
MEMO_BYTES = 48             # longer words always run through the automaton


def read_vocabulary(path: str) -> tuple[bytes, ...]:
    """Pieces of a tokenizer file as bytes; control pieces are left out, every byte is a piece."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {bytes((b,)) for b in range(256)}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
            pieces.add(model.id_to_piece(i).encode("utf-8"))
    return tuple(sorted(pieces))


class Automaton:
    """Vocabulary trie with failure links and popped-token counts."""

    def __init__(self, pieces: tuple[bytes, ...]):
        self.next: dict[int, int] = {}          # node << 8 | symbol -> node
        token = [False]
        parents: list[tuple[int, int]] = [(0, 0)]
        for piece in pieces:
            node = 0
            for symbol in piece:
                key = node << 8 | symbol
                child = self.next.get(key)
                if child is None:
                    child = self.next[key] = len(token)
                    token.append(False)
                    parents.append((node, symbol))
                node = child
            token[node] = token[node] or node != 0
        self.link = [-1] * len(token)           # -1: nothing to go on with
        self.popped = [0] * len(token)
        children: dict[int, list[int]] = {}
        for node, (parent, _) in enumerate(parents[1:], 1):
            children.setdefault(parent, []).append(node)
        queue = deque(children.get(0, ()))
        while queue:
            node = queue.popleft()
            queue.extend(children.get(node, ()))
            if token[node]:                     # the node itself is the longest piece
                self.link[node], self.popped[node] = 0, 1
                continue
            parent, symbol = parents[node]
            at, count = self.link[parent], self.popped[parent]
            while at >= 0:
                child = self.next.get(at << 8 | symbol)
                if child is not None:
                    self.link[node], self.popped[node] = child, count
                    break
                count += self.popped[at]
                at = self.link[at]

    def count(self, symbols) -> int:
        """Pieces of one word; -1 if it cannot be cut."""
        nxt, link, popped = self.next, self.link, self.popped
        node = total = 0
        for symbol in symbols:
            child = nxt.get(node << 8 | symbol)
            while child is None:
                if not node or link[node] < 0:
                    return -1
                total += popped[node]
                node = link[node]
                child = nxt.get(node << 8 | symbol)
            node = child
        while node:
            if link[node] < 0:
                return -1
            total += popped[node]
            node = link[node]
        return total


class _Memo(dict):
    """Word (bytes) to its piece count; short words are kept."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.count(MARK + word)
        if len(word) <= MEMO_BYTES:
            if len(self) >= MAX_MEMO:
                self.clear()
            self[word] = n
        return n


class Counter:
    """Piece counts of whole texts by one vocabulary."""

    def __init__(self, pieces: tuple[bytes, ...]):
        self.memo = _Memo(Automaton(pieces))

    def count(self, data: bytes | None) -> tuple[int, int, int]:
        """Pieces, words, and pieces of the word with the most."""
        memo = self.memo
        counts = [memo[w] for w in (data or b"").split()]
        return sum(counts), len(counts), max(counts, default=0)


@lru_cache(maxsize=4)
def _counter(pieces: tuple[bytes, ...]) -> Counter:
    return Counter(pieces)


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def token_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Per row: doc_id, n_tokens, n_words, max_word_tokens (longs).

    Words are runs without ASCII white space in the whole text. Null and empty
    texts count zero. Repeated rows and null ids
    keep their rows; other columns are not read. The vocabulary file is read on
    the driver and broadcast (its size does not depend on the data).
    """
    small_batches(docs.sparkSession)
    pieces = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path or default_vocabulary()))
    src = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_bytes(text).alias("b"))
    schema = T.StructType([src.schema[0]] + [T.StructField(c, T.LongType()) for c in
                                             ("n_tokens", "n_words", "max_word_tokens")])

    def run(batches):
        counter = _counter(pieces.value)
        for batch in batches:
            rows = [counter.count(v.as_py()) for v in batch.column(1)]
            cols = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols],
                                             names=["doc_id", "n_tokens", "n_words", "max_word_tokens"])

    return src.mapInArrow(run, schema)


def corpus_totals(docs: DataFrame, by: list[str], text: str = "text", **params) -> DataFrame:
    """Token and word totals per group (partial sums before the shuffle)."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(by)]).alias("doc_id"),
                         F.col(f"`{text}`").alias("text"))
    return token_counts(packed, **params).groupBy("doc_id").agg(
        F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_words").alias("n_words")) \
        .select(*[F.col(f"doc_id.k{i}").alias(c) for i, c in enumerate(by)], "n_docs", "n_tokens", "n_words")
