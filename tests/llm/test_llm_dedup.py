"""SimHash components and decontamination against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import xxhash
from llm_common import SF_MED, SF_SMALL, no_docs, odd_docs  # noqa: F401 - fixtures

from pricewise.llm import components, decontaminate, queries, simhash


def brute_fp(text, k=3):
    text = re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    parts = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, distance=2):
    """Fingerprint to the smallest linked fingerprint, by comparing all pairs."""
    arr = np.array(sorted(set(fps)), np.uint64)
    parent = list(range(len(arr)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(arr)):
        for j in np.flatnonzero(np.bitwise_count(arr[i + 1:] ^ arr[i]) <= distance):
            parent[max(find(i), find(i + 1 + int(j)))] = min(find(i), find(i + 1 + int(j)))
    return {int(arr[i]): find(i) for i in range(len(arr))}


def check(rows, docs):
    fps = [brute_fp(t) for _, t in docs]
    comp = brute_components(fps)
    least = defaultdict(list)
    for (i, _), f in zip(docs, fps):
        if i is not None:
            least[comp[f]].append(i)
    want = sorted((i if i is not None else -1, f"{f:016x}", min(least[comp[f]], default=-1)) for (i, _), f in zip(docs, fps))
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.fingerprint,
                  r.component_id if r.component_id is not None else -1) for r in rows)
    assert got == want
    return len({comp[f] for f in fps})


def test_op2_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_MED}/documents.parquet").collect()]
    check(queries.REGISTRY["op2_simhash"](spark, SF_MED).collect(), docs)


def test_simhash_odd_rows_and_keep_one(spark, odd_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    n = check(simhash.near_duplicates(odd_docs).collect(), docs)
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == n
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.keep_one(no_docs).count() == 0


def test_dense_fingerprints(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(30)]
    fps = set(base)
    for b in base[:8]:                       # balls, chains and far points
        for _ in range(120):
            x = b
            for _ in range(rng.randrange(1, 5)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    x = base[9]
    for i in range(60):
        x ^= 3 << i
        fps.add(x)
    fps |= {0, (1 << 64) - 1, 1 << 63, 3 << 62}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(5)
    for distance, blocks in ((2, 7), (1, 4), (3, 8), (2, 4)):
        got = {r.fp & (1 << 64) - 1: r.root for r in simhash.linked(df, distance, blocks).collect()}
        want = brute_components(fps, distance)
        mine = {f: got.get(f, f - (1 << 64) if f >> 63 else f) for f in fps}
        classes = defaultdict(set)
        for f in fps:
            classes[want[f]].add(mine[f])
        assert all(len(c) == 1 for c in classes.values())
        assert len(set(mine.values())) == len(classes)


def test_trie_frontier_blocks(monkeypatch):
    monkeypatch.setattr(simhash, "FRONTIER", 7)
    rng = np.random.default_rng(1)
    value = np.unique(rng.integers(0, 1 << 12, 700)).astype(np.uint64)
    group = np.zeros(len(value), np.int64)
    labels = simhash.trie_links(value, group, 12, 2)
    want = brute_components([int(v) for v in value])
    pairs = {(labels[i], want[int(v)]) for i, v in enumerate(value)}
    assert len(pairs) == len(set(labels)) == len(set(want.values()))


def test_components(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1300)] + [(5000, 5000), (None, 3), (7, None)]
    df = spark.createDataFrame(chain + chain[:50], "a long, b long")
    got = {r.node: r.component for r in components.connected_components(df).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1300)}}
    assert components.connected_components(df.filter("a > 99999")).count() == 0


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def norm(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or ""))


def brute_hits(docs, items, size=10):
    grams = defaultdict(set)
    for item, text in items:
        w = norm(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            grams[tuple(w[i:i + size])].add(item)
    lens = sorted({len(g) for g in grams})
    out = []
    for doc, text in docs:
        w = norm(text)
        hit, found = set(), set()
        for n in lens:
            for i in range(len(w) - n + 1):
                g = tuple(w[i:i + n])
                if g in grams:
                    hit.update(range(i, i + n))
                    found |= {str(x) for x in grams[g] if x is not None}
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def key(r):
    return tuple((x is None, x) for x in r)


def test_op6_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_MED}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_MED}/benchmark.parquet").collect()]
    got = [tuple(r) for r in queries.REGISTRY["op6_decontaminate"](spark, SF_MED).collect()]
    want = brute_hits(docs, items)
    assert any(w[5] for w in want)
    assert sorted(got, key=key) == sorted(want, key=key)


ITEMS = [(1, "Same TEXT here"), (2, None), (3, ""), (None, "one"), (5, "a b c d e f g h i j k l m"), (5, "a b c d e f g h i j"),
         (6, "word5 token5 word6 token6 word7 token7 word8 token8 word9 token9 word10")]


def test_decontaminate_odd_rows_and_blocks(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, gram string")
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    want = sorted(brute_hits(docs, ITEMS), key=key)
    for limit in (500_000, 2):
        got = sorted((tuple(r) for r in decontaminate.report(odd_docs, bench, max_windows=limit).collect()), key=key)
        assert got == want
    clean = decontaminate.remove(odd_docs, bench)
    assert clean.columns == odd_docs.columns and clean.count() == sum(not w[5] for w in want)
    spans = decontaminate.remove(odd_docs, bench, whole=False)
    assert spans.columns == odd_docs.columns and spans.count() == len(docs)
    texts = {r.doc_id: r.text for r in spans.collect() if r.doc_id is not None}
    assert texts[10] == " now" and texts[1] is None
    assert decontaminate.report(no_docs, bench).count() == 0
    assert not any(r.contaminated for r in decontaminate.report(odd_docs, bench.filter("false")).collect())


def test_keep_one_on_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    comp = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    kept = [r.doc_id for r in simhash.keep_one(docs).select("doc_id").collect()]
    assert sorted(kept) == sorted(set(comp.values()))
