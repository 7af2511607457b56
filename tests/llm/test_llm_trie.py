"""Conversation prefix trie against brute force over all prefixes."""

import hashlib
import random
import zlib

import pytest
from llm_common import SF_SMALL  # noqa: F401

import __spark_entry__ as entry
from oracle_harness import compare, duck
from pricewise.llm import conversation_trie as trie
from pricewise.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string, pos long, key string, parent string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "k", "p") for r in rows], SCHEMA)


def ordered(rows):
    talks = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None),
                                      key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        talks.setdefault(c, []).append((role or "", text or ""))
    return talks


def rebuilt(talks):
    out = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = talks.get(c - c % 100, [])[:h] + own[h:]
    return out


def brute(talks):
    members = {}
    for c, turns in talks.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)

    def below(node):
        out, todo = [], [node]
        while todo:
            out.append(todo.pop())
            todo += kids.get(out[-1], [])
        return out

    rows = set()
    for node, m in members.items():
        under = below(node)
        ends = sorted(c for c in m if tuple(talks[c]) == node)
        rows.add((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(kids.get(node, [])),
                  sum(not kids.get(u) for u in under),
                  sum((len(members[u]) - 1) * len(u[-1][1]) for u in under if u),
                  hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return rows


def check(df, want):
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(want) and set(got) == want


def talks_rows(seed, convs, most, words):
    rng = random.Random(seed)
    rows = []
    for c in convs:
        for t in range(rng.randrange(most + 1)):
            rows.append((c, t, rng.choice(("user", "assistant", None)), rng.choice(words)))
    return rows


@pytest.fixture(scope="module")
def odd_rows():
    rows = talks_rows(3, [*range(0, 40), *range(100, 108), 205], 9, ["a", "b", "été 漢", "", None])
    rows += [(300 + i, t, "user", f"same {t}") for i in range(30) for t in range(7)]        # a large group of copies
    rows += [(7, None, "user", "first"), (7, 3, "user", "tie"), (7, 3, "user", "tie"), (None, 1, "user", "lost")]
    rows += [(500, t, "user", "x" * (t % 5)) for t in range(23)] + [(501, t, "user", "x" * (t % 5)) for t in range(23)]
    return rows + [(502, 0, "user", "long " * 20000)]


def test_whole_operator_against_brute_force(spark, odd_rows):
    turns = trie.share_openings(trie.turn_table(frame(spark, odd_rows)))
    check(trie.prefix_trie(turns), brute(rebuilt(ordered(odd_rows))))


def test_many_blocks_and_pieces(spark, odd_rows, monkeypatch):
    """Blocks of 3 turns, pieces of 5: every node is merged from several places."""
    monkeypatch.setattr(trie, "PIECE_TURNS", 5)
    monkeypatch.setattr(trie, "CHUNK_BYTES", 9)
    turns = trie.turn_table(frame(spark, odd_rows))
    check(trie.prefix_trie(turns.repartition(5), block_turns=3), brute(ordered(odd_rows)))


def test_results_do_not_depend_on_partitions(spark, odd_rows):
    turns = trie.turn_table(frame(spark, odd_rows))
    name = "spark.sql.shuffle.partitions"
    old = spark.conf.get(name)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    try:
        spark.conf.set(coalesce, "false")
        spark.conf.set(name, "13")
        check(trie.prefix_trie(turns, block_turns=4), brute(ordered(odd_rows)))
    finally:
        spark.conf.set(name, old)
        spark.conf.set(coalesce, "true")


def test_absent_and_short_openings(spark):
    rows = [(c, t, "user", f"{c} {t}") for c in (12, 13, 14, 15, 16, 17) for t in range(4)]     # conversation 0 is absent
    rows += [(c, t, "user", f"w{t}") for c in range(100, 112) for t in range(2 if c == 100 else 6)]
    turns = trie.share_openings(trie.turn_table(frame(spark, rows)))
    check(trie.prefix_trie(turns), brute(rebuilt(ordered(rows))))


def test_empty_table(spark):
    empty = frame(spark, [])
    out = trie.prefix_trie(trie.share_openings(trie.turn_table(empty)))
    assert out.count() == 0 and out.columns[0] == "conv_id"


def test_double_array_holds_every_sequence_and_no_other():
    rng = random.Random(2)
    for width in (2, 40, 3000):
        rows = sorted({tuple(rng.randrange(1, width + 1) for _ in range(rng.randrange(6))) for _ in range(400)})
        da = trie.DoubleArray([list(r) for r in rows])
        prefixes = {r[:i] for r in rows for i in range(len(r) + 1)}
        assert len(da.order) == len(prefixes)
        slots = {(): 0}
        for p in sorted(prefixes, key=len):
            if p:
                slots[p] = da.child(slots[p[:-1]], p[-1])
                assert slots[p] > 0
        assert len(set(slots.values())) == len(prefixes)
        for p in list(prefixes)[:200]:
            for c in range(1, min(width, 50) + 1):
                assert (da.child(slots[p], c) >= 0) == (p + (c,) in prefixes)


def test_query_equals_sql(spark):
    df = queries.op11_prefix_trie(spark, SF_SMALL)
    cur = duck(SF_SMALL).execute(entry.oracle_sql()["op11_prefix_trie"])
    ok, msgs = compare([tuple(r) for r in df.collect()], df.columns, cur.fetchall(), [d[0] for d in cur.description])
    assert ok, msgs
