"""Cross-tokenizer alignment against whole-text encodes and brute-force link counts."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from llm_common import SF_SMALL, no_docs, odd_docs  # noqa: F401 - fixtures

from pricewise.llm import alignment as al
from pricewise.llm import queries

A_PATH, B_PATH = al.default_paths()


@pytest.fixture(scope="module")
def public():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_PATH)


@pytest.fixture(scope="module")
def aligner():
    with open(A_PATH, encoding="utf-8") as f, open(B_PATH, "rb") as g:
        return al.Aligner(f.read(), g.read())


def spans(parts):
    out, at = [], 0
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def brute(public, text):
    """(a ids, b ids, groups text, links) by whole-text encodes and pairwise overlap."""
    if not text:
        return [], [], "", []
    a = public[0].encode(" " + text, add_special_tokens=False).ids
    b = public[1].encode(text)
    chars = al._byte_chars()
    of_a = [bytes(chars[c] for c in public[0].id_to_token(i)) for i in a]
    of_b = [bytes((int(public[1].id_to_piece(i)[3:5], 16),)) if public[1].is_byte(i)
            else public[1].id_to_piece(i).replace("▁", " ").encode() for i in b]
    raw = (" " + text).encode()
    if b"".join(of_a) != raw or b"".join(of_b) != raw:
        return [], [], "", []
    sa, sb = spans(of_a), spans(of_b)
    where_a, where_b = {e: i for i, (_, e) in enumerate(sa)}, {e: i for i, (_, e) in enumerate(sb)}
    groups, i, j = [], 0, 0
    for e in sorted(where_a.keys() & where_b.keys()):
        x, y = where_a[e] + 1, where_b[e] + 1
        groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
        i, j = x, y
    links, j0 = [], 0
    for i, (x, y) in zip(a, sa):
        while sb[j0][1] <= x:
            j0 += 1
        j = j0
        while j < len(sb) and sb[j][0] < y:
            links.append((i, b[j]))
            j += 1
    return a, b, ";".join(groups), links


def brute_table(public, rows):
    per = [(i, *brute(public, t)) for i, t in rows]
    count = Counter(x for p in per for x in p[4])
    most = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    return count, sorted(((i, len(a), len(b), len(g.split(";")) if a else 0, len(links), sum(count[x] == most[x[1]] for x in links),
                           sum(count[x] for x in links), hashlib.sha256(g.encode()).hexdigest() if a else "")
                          for i, a, b, g, links in per), key=repr)


def texts(seed, n):
    rng = random.Random(seed)
    words = ["the", "Übergröße", "naïve", "漢字かな", "don't", "x" * 30, "12345", "a.b,c", "<|endoftext|>", "<s>", "<0x0A>", "\n", "\t\t",
             "", " ", " ", " z", "🙂🙂", "\u0085", "\x1c", "é", "▁", "​", "\r\n\r\n", "__", "'s", "\x00"]
    return ["".join(rng.choice(words) + rng.choice((" ", " ", "  ", "", "\n")) for _ in range(rng.randrange(25))) for _ in range(n)]


def test_parts_equal_whole_texts(aligner, public):
    for t in texts(1, 1500) + [" ", "  ", " a", "a ", "\n", "▁", "a ▁b c"]:
        a, b, groups, links = brute(public, t)
        p = aligner.align(t)
        if not a:
            assert p is None
            continue
        pair = np.frombuffer(p.pairs, "<u4")
        assert (p.n_a, p.n_b, p.groups) == (len(a), len(b), groups)
        assert Counter(zip((pair & 0xFFFF).tolist(), (pair >> 16).tolist())) == Counter(links)
        assert p.n_groups == groups.count(";") + 1


def test_long_runs(aligner, public):
    for t in ("x" * 50_000, " " * 50_000, "\n" * 30_000 + " a", "ab " * 30_000, "漢" * 25_000):
        p, (a, b, groups, _) = aligner.align(t), brute(public, t)
        assert (p.n_a, p.n_b, p.groups) == (len(a), len(b), groups)


def test_memo_may_be_cleared(public, monkeypatch):
    monkeypatch.setattr(al, "MEMO_CHARS", 30)
    monkeypatch.setattr(al, "LEARN_PARTS", 3)
    with open(A_PATH, encoding="utf-8") as f, open(B_PATH, "rb") as g:
        aligner = al.Aligner(f.read(), g.read())
    for t in texts(9, 60):
        p = aligner.align(t)
        assert (p.groups if p else "") == brute(public, t)[2]


def test_bitmaps():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, al.BLOCK_DOCS, n)) for n in (0, 1, 5, 255, 300, 3000, 40_000)]
    for s in sets:
        assert unpack(al.pack_bitmap(s)) == s.tolist() and al.popcount(al.pack_bitmap(s)) == len(s)
        for o in sets:
            both = al.merge_bitmaps([al.pack_bitmap(s), al.pack_bitmap(o)])
            assert unpack(both) == sorted({*s.tolist(), *o.tolist()})
    assert al.merge_bitmaps([]) == b""


def unpack(data):
    return al.unpack_bitmap(data).tolist()


def test_planes_hold_multiplicities():
    rng, block, want = np.random.default_rng(5), al.Block(), {}
    for place in range(700):
        pairs = rng.integers(0, 6, rng.integers(0, 60)).astype("<u4")
        block.add(pairs.tobytes())
        if place % 100 == 0:
            block._count()
        for p, n in Counter(pairs.tolist()).items():
            want.setdefault(p, {})[place] = n
    got = {p: (docs, links, planes) for p, docs, links, planes in block.rows()}
    assert got.keys() == want.keys()
    for p, (docs, links, planes) in got.items():
        times = Counter()
        for digit, plane in enumerate(planes):
            times.update({at: 1 << digit for at in unpack(plane)})
        assert times == want[p]
        assert docs == al.popcount(al.merge_bitmaps(planes)) == len(want[p])
        assert links == sum(al.popcount(x) << d for d, x in enumerate(planes)) == sum(want[p].values())


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                                               "groups_sha256").collect()), key=repr)


def test_small_blocks_and_several_partitions(spark, public, monkeypatch):
    monkeypatch.setattr(al, "BLOCK_LINKS", 200)
    monkeypatch.setattr(al, "MERGE_LINKS", 70)
    monkeypatch.setattr(al, "_ROWS", 11)
    rows = [(i, t) for i, t in enumerate(texts(2, 120))] + [(3, "again and again"), (3, "again and again"), (None, "the the")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    index = al.build_index(df)
    count, want = brute_table(public, rows)
    assert result(al.scored(index)) == want
    pairs = al.pair_counts(index).collect()
    assert {(r.a, r.b): r.n_links for r in pairs} == count
    held = Counter(x for _, t in rows for x in set(brute(public, t)[3]))
    assert {(r.a, r.b): r.n_docs for r in pairs} == held


def test_odd_documents(spark, public, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert result(al.align(odd_docs)) == brute_table(public, rows)[1]
    assert al.align(no_docs).count() == 0


def test_groups_can_be_kept(spark, public):
    df = spark.createDataFrame([(1, "Groups of tokens"), (2, None)], "doc_id int, text string")
    got = {r.doc_id: r.groups for r in al.align(df, keep_groups=True).collect()}
    assert got == {1: brute(public, "Groups of tokens")[2], 2: ""}


def test_query_against_brute_force(spark, public):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert result(queries.op12_alignment(spark, SF_SMALL)) == brute_table(public, rows)[1]


def test_other_tokenizers_take_the_slow_way(public):
    """Merges out of the order of the ids: the tokenizer's own library encodes."""
    import json
    with open(A_PATH, encoding="utf-8") as f:
        model = json.load(f)
    model["model"]["merges"] = [model["model"]["merges"][1], model["model"]["merges"][0], *model["model"]["merges"][2:]]
    t = al.ByteTokenizer(json.dumps(model))
    assert t.fast is None and t.encode(" the text") == public[0].encode(" the text").ids
    assert public_tokenizers.PATTERN == al.PATTERN
