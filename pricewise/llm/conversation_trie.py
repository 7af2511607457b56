"""Prefix trie of conversations: every distinct opening sequence of turns is a node.

A turn is known by the digest of its role and text. Conversations are cut into
blocks of ``BLOCK_TURNS`` turns, so none has to fit in one row; a block hangs
below the node at which the block before it ends. Equal blocks below one node
are counted first, then range partitioned in the order of their turns: a
partition is a shard of neighbouring prefixes, and a hot prefix is spread over
many shards. Each shard is cut into pieces of bounded size, and each piece is
packed into a double array (BASE, CHECK) over dense turn ids, traversed for its
nodes and summed up from the leaves to the root. Upper nodes that several
pieces share are merged by one grouped sum over node digests.

All figures are sums over blocks, wherever these are cut: each block knows how
many turns it shares with its neighbours in the order, so a node is introduced
by exactly one block (the first that has it) and a sequence that its successor
does not prolong is a leaf.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import cut, small

BLOCK_TURNS = 256           # turns of a block; longer conversations have several
PIECE_TURNS = 100_000       # turns packed into one double array at most (or one block)
ID = 16                     # bytes of a turn's and a node's digest
CHUNK_BYTES = 1 << 16       # bytes of joined ids handed on in one row
ROOT = hashlib.md5(b"").digest()
NO_ENDS = hashlib.sha256(b"").hexdigest()
TRIES = 256                 # places looked at for several children before the array is lengthened

_NODE = "key binary, parent binary, depth long, conv_id long, n_convs long, n_children long, n_leaves long, saved long"
_BLOCK = ("prefix binary, ids binary, lens array<long>, n long, conv_id long, below_children long, "
          "below_leaves long, below_saved long")


class DoubleArray:
    """A trie in two arrays: the child of slot ``s`` by code ``c`` is ``t = base[s] + c`` if ``check[t] == s``.

    Codes are positive whole numbers. It is built from sequences in which equal
    prefixes are neighbours; slot 0 is the root.
    """

    def __init__(self, rows: list[list[int]]):
        self.base, self.check, self.order = [0], [0], [0]      # check -1: free
        self.free = 1                                          # no free slot below
        todo = [(0, len(rows), 0, 0)]
        while todo:
            lo, hi, depth, slot = todo.pop()
            while lo < hi and len(rows[lo]) == depth:
                lo += 1
            kids, i = [], lo
            while i < hi:
                code, j = rows[i][depth], i + 1
                while j < hi and rows[j][depth] == code:
                    j += 1
                kids.append((code, i, j))
                i = j
            if kids:
                base = self.base[slot] = self._place(sorted(k[0] for k in kids))
                for code, i, j in kids:
                    self.check[base + code] = slot
                    self.order.append(base + code)
                    todo.append((i, j, depth + 1, base + code))

    def _place(self, codes: list[int]) -> int:
        """A base at which every code finds a free slot."""
        check = self.check
        while self.free < len(check) and check[self.free] >= 0:
            self.free += 1
        for at in range(self.free, min(len(check), self.free + TRIES)):
            base = at - codes[0]
            if all(base + c >= len(check) or check[base + c] < 0 for c in codes):
                break
        else:
            base = len(check) - codes[0]
        grow = base + codes[-1] + 1 - len(check)
        if grow > 0:
            check.extend([-1] * grow)
            self.base.extend([0] * grow)
        return base

    def child(self, slot: int, code: int) -> int:
        """The slot reached from ``slot`` by ``code``, -1 if there is none."""
        at = self.base[slot] + code
        return at if 0 < at < len(self.check) and self.check[at] == slot else -1


def shared_turns(a: tuple[bytes, bytes], b: tuple[bytes, bytes]) -> int:
    """Turns that two blocks (prefix, ids) have in common from the start; -1 below different nodes."""
    if a[0] != b[0]:
        return -1
    x, y = a[1], b[1]
    lo, hi = 0, min(len(x), len(y)) // ID
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if x[:mid * ID] == y[:mid * ID]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def piece_nodes(rows: list[tuple], depth: int) -> list[tuple]:
    """Partial node rows of blocks that hang below one node at ``depth``.

    Each row is (prefix, ids, lens, n, conv_id, below_children, below_leaves,
    below_saved, before, after) with the turns shared with the block before and
    after it in the order.
    """
    rows = sorted(rows, key=lambda r: r[1])
    code: dict[bytes, int] = {}
    split = [[r[1][i:i + ID] for i in range(0, len(r[1]), ID)] for r in rows]
    coded = [[code.setdefault(t, len(code) + 1) for t in ids] for ids in split]
    trie = DoubleArray(coded)
    size = len(trie.base)
    key: list[bytes | None] = [None] * size
    level, conv = [depth] * size, [0] * size
    count, kids, leaves, saved = [0] * size, [0] * size, [0] * size, [0] * size
    key[0] = rows[0][0]
    path, last = [hashlib.md5(rows[0][0])], []
    for r, ids, codes in zip(rows, split, coded):
        _, _, lens, n, conv_id, below_kids, below_leaves, below_saved, before, after = r
        same = 0
        while same < len(path) - 1 and same < len(codes) and codes[same] == last[same]:
            same += 1
        del path[same + 1:]
        last, slot = codes, 0
        for d, c in enumerate(codes):
            parent, slot = slot, trie.child(slot, c)
            if d >= same:
                h = path[d].copy()
                h.update(ids[d])
                path.append(h)
                if key[slot] is None:
                    key[slot], level[slot] = h.digest(), depth + d + 1
            if d >= before:                 # introduced by this block: before is the number of shared turns
                kids[parent] += 1
                saved[slot] += (n - 1) * lens[d]
            else:
                saved[slot] += n * lens[d]
        conv[slot] = conv_id if not count[slot] else min(conv[slot], conv_id)
        count[slot] += n
        saved[slot] += below_saved
        kids[slot] += below_kids
        if after < len(codes):
            leaves[slot] += below_leaves if below_kids else 1
    for slot in reversed(trie.order[1:]):   # children come after their parents
        up = trie.check[slot]
        conv[up] = min(conv[up], conv[slot]) if count[up] else conv[slot]
        count[up] += count[slot]
        leaves[up] += leaves[slot]
        saved[up] += saved[slot]
    return [(key[s], key[trie.check[s]] if s else None, level[s], conv[s], count[s], kids[s], leaves[s], saved[s])
            for s in trie.order]


def _batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, fields)], names=[n for n, _ in fields])


_ARROW = {"binary": pa.binary(), "long": pa.int64(), "array<long>": pa.list_(pa.int64()), "boolean": pa.bool_(),
          "string": pa.string()}


def _fields(schema: str) -> list[tuple[str, pa.DataType]]:
    return [(n, _ARROW[t]) for n, t in (f.split() for f in schema.split(", "))]


_ORDERED = _BLOCK + ", before long, after long, part long, is_first boolean, is_last boolean"


def _with_neighbours(batches):
    """Ordered blocks with the turns they share with their neighbours inside the partition."""
    fields, part = _fields(_ORDERED), TaskContext.get().partitionId()
    held, before, first, out = None, -1, True, []
    for batch in batches:
        for r in zip(*(c.to_pylist() for c in batch.columns)):
            if held is not None:
                after = shared_turns(held, r)
                out.append((*held, before, after, part, first, False))
                before, first = after, False
            held = r
        if len(out) >= 2000:
            yield _batch(out, fields)
            out = []
    if held is not None:
        yield _batch([*out, (*held, before, -1, part, first, True)], fields)


_EDGE = "part long, first_before long, last_after long"


def _across(batches):
    """Per edge block: turns shared with the block before it (if a partition's first) and after it (if its last)."""
    held, before = None, -1
    for batch in batches:
        out = []
        for r in zip(*(c.to_pylist() for c in batch.columns)):
            if held is not None:
                after = shared_turns(held, r)
                out.append((held[2], before if held[3] else None, after if held[4] else None))
                before = after
            held = r
        if out:
            yield _batch(out, _fields(_EDGE))
    if held is not None:
        yield _batch([(held[2], before if held[3] else None, -1 if held[4] else None)], _fields(_EDGE))


def _level_nodes(blocks: DataFrame, depth: int) -> DataFrame:
    """Node rows (``_NODE``) of distinct blocks (``_BLOCK``), the nodes they hang below included."""
    ordered = cut(blocks.repartitionByRange("prefix", "ids").sortWithinPartitions("prefix", "ids")
                  .mapInArrow(_with_neighbours, _ORDERED), "trie-blocks")
    # what the first and last block of each partition share with other partitions': two rows a partition
    edges = ordered.where("is_first or is_last").select("prefix", "ids", "part", "is_first", "is_last")
    ends = cut(edges.repartition(1).sortWithinPartitions("prefix", "ids").mapInArrow(_across, _EDGE)
               .groupBy("part").agg(F.max("first_before").alias("first_before"), F.max("last_after").alias("last_after")),
               "trie-edges")
    names = [f.split()[0] for f in _BLOCK.split(", ")]
    whole = ordered.join(F.broadcast(ends), "part").select(     # one row a partition
        *names, F.when(F.col("is_first"), F.col("first_before")).otherwise(F.col("before")).alias("before"),
        F.when(F.col("is_last"), F.col("last_after")).otherwise(F.col("after")).alias("after"))

    def nodes(batches):
        fields, held, turns = _fields(_NODE), [], 0
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (r[0] != held[0][0] or turns >= PIECE_TURNS):
                    yield _batch(piece_nodes(held, depth), fields)
                    held, turns = [], 0
                held.append(r)
                turns += len(r[2]) + 1
        if held:
            yield _batch(piece_nodes(held, depth), fields)

    return whole.mapInArrow(nodes, _NODE).groupBy("key").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")])


def _end_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of (key, conv_id): ids in ascending order, joined in chunks, hashed chunk by chunk."""
    def chunks(batches):
        fields, key, first, parts, size = _fields("key binary, first long, text string"), None, 0, [], 0
        for batch in batches:
            out = []
            for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if parts and (k != key or size >= CHUNK_BYTES):
                    out.append((key, first, ",".join(parts)))
                    parts, size = [], 0
                if not parts:
                    key, first = k, c
                parts.append(str(c))
                size += len(parts[-1]) + 1
            if out:
                yield _batch(out, fields)
        if parts:
            yield _batch([(key, first, ",".join(parts))], fields)

    def digests(batches):
        fields, key, state = _fields("key binary, ends_sha256 string"), None, None
        for batch in batches:
            out = []
            for k, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if state is not None and k == key:
                    state.update(b"," + text.encode())
                    continue
                if state is not None:
                    out.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(text.encode())
            if out:
                yield _batch(out, fields)
        if state is not None:
            yield _batch([(key, state.hexdigest())], fields)

    joined = ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id") \
        .mapInArrow(chunks, "key binary, first long, text string")
    return joined.repartition("key").sortWithinPartitions("key", "first") \
        .mapInArrow(digests, "key binary, ends_sha256 string")


def turn_table(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
               text: str = "text") -> DataFrame:
    """(conv_id, pos, id, len) per turn: place from 0, hexadecimal digest, code points of the text.

    Turns are ordered by number (null first), then role and text; repeated
    turns keep their rows. A null role or text is empty. Rows without a
    conversation id belong to none and are left out. Other columns are not read.
    """
    role, text = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role, text))
    said = conversations.where(F.col(f"`{conv_id}`").isNotNull()).select(
        F.col(f"`{conv_id}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), role.alias("role"),
        text.alias("text"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")) - 1
    return said.select("conv_id", place.cast("long").alias("pos"),
                       F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")).alias("id"),
                       F.length("text").cast("long").alias("len"))


def share_openings(turns: DataFrame, every: int = 100, spread: int = 6) -> DataFrame:
    """Conversations rebuilt upon shared openings; a conversation without turns has one row with null ``pos``.

    Conversation c starts with the first h turns (all if fewer, none if absent)
    of conversation c - c % ``every``, where h is crc32(c as text) % ``spread``,
    and goes on with its own turns after its first h.
    """
    openings = small(cut(turns.where((F.col("conv_id") % every == 0) & (F.col("pos") < spread - 1))
                         .groupBy(F.col("conv_id").alias("base"))
                         .agg(F.sort_array(F.collect_list(F.struct("pos", "id", "len"))).alias("opening")),
                         "trie-openings"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % spread
    base = (F.col("conv_id") - F.col("conv_id") % every).alias("base")
    taken = F.coalesce(F.slice("opening", F.lit(1), F.col("h").cast("int")), F.array().cast(
        "array<struct<pos:bigint,id:string,len:bigint>>"))
    start = turns.select("conv_id").distinct().select("conv_id", h.alias("h"), base).join(openings, "base", "left") \
        .select("conv_id", F.explode_outer(taken).alias("t")).select("conv_id", "t.pos", "t.id", "t.len")
    own = turns.withColumns({"h": h}).where("pos >= h").select("*", base).join(openings, "base", "left") \
        .select("conv_id", (F.col("pos") - F.col("h") + F.size(taken)).alias("pos"), "id", "len")
    return start.unionByName(own)


def prefix_trie(turns: DataFrame, block_turns: int | None = None) -> DataFrame:
    """One row per node of the prefix trie of ``turns`` (conv_id, pos from 0, id, len).

    Columns: conv_id (smallest member), depth, parent_conv_id (root: null),
    n_convs, n_children, n_leaves (childless nodes below or at it),
    saved_tokens (over its subtree, code points of a node's last text times its
    members but one) and ends_sha256 (digest of the ids of the conversations
    that end at it, ascending, joined by commas). A conversation without turns
    has a row with a null ``pos`` and ends at the root. No conversation: no
    node. The ids of one node's conversations are hashed in order by one task
    that reads them in chunks of ``CHUNK_BYTES``.
    """
    size = block_turns or BLOCK_TURNS
    given = F.col("pos").isNotNull()
    t = F.when(given, F.struct("pos", "id", "len"))
    blocks = turns.groupBy("conv_id", F.when(given, F.floor(F.col("pos") / size)).otherwise(0).alias("block")) \
        .agg(F.sort_array(F.collect_list(t)).alias("t"))
    blocks = cut(blocks.select("conv_id", "block", F.unhex(F.array_join(F.col("t.id"), "")).alias("ids"),
                               F.col("t.len").alias("lens")), "trie-blocks")
    deepest = blocks.agg(F.max("block")).first()[0]
    levels: list[DataFrame] = []
    rows = blocks.where("block = 0").withColumn("prefix", F.lit(bytearray(ROOT)))
    for k in range(0 if deepest is None else int(deepest) + 1):
        if k:
            rows = blocks.where(F.col("block") == k).join(levels[-1].select("conv_id", F.col("end").alias("prefix")), "conv_id")
        end = F.when(F.length("ids") == 0, F.col("prefix")).otherwise(F.unhex(F.md5(F.concat("prefix", "ids"))))
        levels.append(cut(rows.select("conv_id", "prefix", "ids", "lens", end.alias("end")), "trie-level"))
    if not levels:
        levels.append(cut(rows.select("conv_id", "prefix", "ids", "lens", F.col("prefix").alias("end")), "trie-level"))

    found, ends, below = [], [], None
    for k in reversed(range(len(levels))):
        level = levels[k]
        done = level.select("end", "conv_id")
        if k + 1 < len(levels):
            done = level.join(levels[k + 1].select("conv_id"), "conv_id", "left_anti").select("end", "conv_id")
        ends.append(done)
        b = level.groupBy("prefix", "ids").agg(F.first("lens").alias("lens"), F.count("*").alias("n"),
                                               F.min("conv_id").alias("conv_id"), F.first("end").alias("end"))
        zero = F.lit(0).cast("long")
        if below is None:
            b = b.withColumns({c: zero for c in ("below_children", "below_leaves", "below_saved")})
        else:
            b = b.join(below, "end", "left").fillna(0, ["below_children", "below_leaves", "below_saved"])
        nodes = cut(_level_nodes(b.select(*[f.split()[0] for f in _BLOCK.split(", ")]), k * size), "trie-nodes")
        if k:
            below = nodes.where(F.col("depth") == k * size).select(
                F.col("key").alias("end"), F.col("n_children").alias("below_children"),
                F.col("n_leaves").alias("below_leaves"), F.col("saved").alias("below_saved"))
            nodes = nodes.where(F.col("depth") > k * size)
        found.append(nodes)
    nodes, over = found[0], ends[0]
    for more, others in zip(found[1:], ends[1:]):
        nodes, over = nodes.unionByName(more), over.unionByName(others)
    digests = cut(_end_digests(over.select(F.col("end").alias("key"), "conv_id")), "trie-ends")
    up = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(digests, "key", "left").join(up, "parent", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                      F.col("saved").alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))
