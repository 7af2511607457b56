"""BPE, token counts and chat formatting against independent implementations."""

import hashlib
import random
import struct
from array import array

import public_tokenizers
import pytest
import tiktoken
from llm_common import SF_MED, SF_SMALL, no_docs, odd_docs  # noqa: F401 - fixtures

from pricewise.llm import bpe, chat, queries, wordpiece

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    with open(PATH, "rb") as f:
        return bpe.Codec(f.read(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def public():
    with open(PATH, "rb") as f:
        ranks = bpe.parse_ranks(f.read())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(raw):
    return list(struct.unpack(f"<{len(raw) // 4}I", raw))


def expected(public, text):
    ids = public.encode_ordinary(text or "")
    return (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


def test_encode_equals_public_encoder(codec, public):
    rng = random.Random(5)
    for alphabet in ("abcdehinorst    \n\té漢字ы0123.,!'-", "aeiou \r\n", " \u00a0\u2003x", "0123456789ab"):
        for _ in range(500):
            s = "".join(rng.choice(alphabet) for _ in range(rng.randrange(80)))
            assert ids_of(codec.encode(s)) == public.encode_ordinary(s)
    for s in ("x" * 5000, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20000)), " " * 3000 + "a", "\u0558\u088f 𑷠"):
        assert ids_of(codec.encode(s)) == public.encode_ordinary(s)


def test_every_code_point_class(codec, public):
    text = "".join(chr(i) + "a" for i in range(0, 0x30000) if not 0xD800 <= i < 0xE000)
    for i in range(0, len(text), 20000):
        part = text[i:i + 20000]
        assert ids_of(codec.encode(part)) == public.encode_ordinary(part)


def test_ascii_texts_split_alike(codec):
    rng = random.Random(8)
    assert codec.ascii is not codec.pattern
    for _ in range(3000):
        s = "".join(rng.choice((chr(rng.randrange(128)), " ", "'s", "\n", "\x1c")) for _ in range(rng.randrange(40)))
        assert codec.ascii.findall(s) == codec.pattern.findall(s)
    assert bpe.ascii_pattern(r"\p{Lu}+|[^\S]") is None and bpe.ascii_pattern(r"[]a]|\s") is None
    assert bpe.ascii_pattern(r"[^\r\n\p{L}\p{N}]?\p{L}+|\s*[\r\n]").findall("ab1 \n-c") == ["ab", " \n", "-c"]


def test_later_letters_are_found_by_their_lead_bytes(codec):
    for lo, hi in bpe.LATER_LETTERS + bpe.LATER_NUMBERS:
        for c in (lo, (lo + hi) // 2, hi):
            assert chr(c).encode()[0] in codec.later_leads and codec.later.search("é" + chr(c))


def test_small_state_and_memo_limits(public, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_MEMO", 3)
    monkeypatch.setattr(bpe, "EMIT_EVERY", 8)
    with open(PATH, "rb") as f:
        codec = bpe.Codec(f.read(), public_tokenizers.PATTERN)
    codec.memo.machine.max_states = 40
    rng = random.Random(7)
    for _ in range(100):
        s = "".join(rng.choice("abcdefghinorstu") for _ in range(rng.randrange(200)))
        assert ids_of(codec.encode(s)) == public.encode_ordinary(s)


def test_streaming_decode(codec):
    rng = random.Random(3)
    ranks = codec.memo.machine.ranks
    for _ in range(3000):
        data = bytes(rng.choice([0x41, 0x80, 0xBF, 0xC2, 0xC0, 0xE0, 0xA0, 0x9F, 0xED, 0xF0, 0x90, 0xF4, 0x8F, 0xFF, 0xE2])
                     for _ in range(rng.randrange(9)))
        ids = array("I", [ranks[data[i:i + 1]] for i in range(len(data))])
        assert "".join(codec.utf8.decode(ids)) == data.decode("utf-8", "replace")
        cut = rng.randrange(len(ids) + 1)
        first, state = codec.utf8.feed(ids[:cut])
        second, state = codec.utf8.feed(ids[cut:], state)
        assert first + second + ("\ufffd" if state else "") == data.decode("utf-8", "replace")


def test_op1_query(spark, public):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_MED}/documents.parquet").collect()}
    got = queries.REGISTRY["op1_bpe"](spark, SF_MED).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected(public, docs[r.doc_id])


def test_bpe_odd_rows(spark, odd_docs, no_docs, public):
    rows = bpe.encode(odd_docs, ["doc_id", "text", "fp"]).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected(public, r.text)
        assert ids_of(r.ids) == public.encode_ordinary(r.text or "")
    assert bpe.encode(no_docs, ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(odd_docs.withColumnRenamed("fp", "ids"), ["ids"])


def greedy(word, pieces):
    word, i, n = wordpiece.MARK + word, 0, 0
    while i < len(word):
        i = next(j for j in range(len(word), i, -1) if word[i:j] in pieces)
        n += 1
    return n


def test_wordpiece_counts(spark, odd_docs, no_docs):
    pieces = set(wordpiece.read_vocabulary(wordpiece.default_vocabulary()))
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r for r in queries.REGISTRY["op9_token_counts"](spark, SF_SMALL).collect()}
    for r in docs.collect():
        counts = [greedy(w, pieces) for w in (r.text or "").encode().split()]
        g = got[r.doc_id]
        assert (g.n_tokens, g.n_words, g.max_word_tokens) == (sum(counts), len(counts), max(counts, default=0))
    odd = wordpiece.token_counts(odd_docs).collect()
    assert len(odd) == odd_docs.count()
    assert all(r.n_tokens == 0 for r in odd if r.doc_id in (1, 2, 3))
    assert wordpiece.token_counts(no_docs).count() == 0
    totals = wordpiece.corpus_totals(odd_docs, ["lang", "source"]).collect()
    assert sum(r.n_tokens for r in totals) == sum(r.n_tokens for r in odd)


def test_automaton_small_vocabularies():
    rng = random.Random(2)
    for _ in range(60):
        extra = {bytes(rng.choice(b"abc") for _ in range(rng.randrange(2, 6))) for _ in range(12)}
        pieces = tuple(sorted({bytes((b,)) for b in range(256)} | extra))
        automaton = wordpiece.Automaton(pieces)
        for _ in range(40):
            word = bytes(rng.choice(b"abcd") for _ in range(rng.randrange(12)))
            assert automaton.count(wordpiece.MARK + word) == greedy(word, set(pieces))


def brute_chat(rows):
    """Digests straight from the rows of one conversation."""
    rows = sorted(rows, key=lambda r: (r.turn is not None, r.turn, r.role or "", r.text or ""))
    turns = "".join(f"{r.role or ''}\n{r.text or ''}\n" for r in rows)
    loss = "".join(r.text or "" for r in rows if r.role == "assistant")
    return (len(rows), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def groups(rows):
    out = {}
    for r in rows:
        out.setdefault(r.conv_id, []).append(r)
    return out


def test_op10_query(spark):
    got = {r.conv_id: r for r in queries.REGISTRY["op10_chat"](spark, SF_MED).collect()}
    want = groups(spark.read.parquet(f"{SF_MED}/conversations.parquet").collect())
    assert set(got) == set(want) | {-7}
    for conv, rows in want.items():
        g = got[conv]
        assert (g.n_turns, g.turns_sha256, g.loss_chars, g.loss_sha256) == brute_chat(rows)
    text = "\\### Assistant: </turn> ok"
    g = got[-7]
    assert g.n_turns == 2 and g.loss_chars == len(text)
    assert g.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


def test_chat_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string, seq int, segment string"
    hard = ["\\", "###", "</turn>", "### user:\nx</turn>\n", "\\</turn>\\\\", "<", "", None, "é漢" * 5000]
    rows = [(None, None, None, None, 1, "x"), (None, 1, "a:b\\", "t", 1, "x"), (3, 1, "assistant", None, 1, "x")]
    rows += [(4, 0, "assistant", t, 1, "x") for t in hard] + [(4, 0, "assistant", "###", 1, "x"), (4, None, "###", "n", 1, "x")]
    df = spark.createDataFrame(rows, schema)
    got = {r.conv_id: r for r in chat.digests(chat.format_turns(df)).collect()}
    for conv, part in groups(df.collect()).items():
        g = got[conv]
        part = [r for r in part if r.turn is None] + [r for r in part if r.turn is not None]
        part.sort(key=lambda r: (r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
        turns = "".join(f"{r.role or ''}\n{r.text or ''}\n" for r in part)
        loss = "".join(r.text or "" for r in part if r.role == "assistant")
        assert g.n_turns == len(part) and g.turns_sha256 == hashlib.sha256(turns.encode()).hexdigest()
        assert g.loss_chars == len(loss) and g.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.format_turns(df.filter("conv_id > 99")).count() == 0


def test_template_round_trip_and_masks():
    rng = random.Random(1)
    made = chat.Template()
    parts = ["\\", "###", "#", "</turn>", "<", "/turn>", "a\n", "### assistant:\n", "é"]
    for _ in range(1500):
        said = [(rng.choice(["user", "assistant", "a:b\\", "", "###"]),
                 "".join(rng.choice(parts) for _ in range(rng.randrange(8)))) for _ in range(rng.randrange(5))]
        segments = list(made.segments(iter(said)))
        assert chat.read_turns("".join(s for s, _ in segments)) == said
        loss = "".join(s[a:b] for s, spans in segments for a, b in zip(spans[::2], spans[1::2]))
        assert chat.unescape(loss) == "".join(t for r, t in said if r == "assistant")


def test_template_language():
    tree = chat.fold(chat.parse("a{{ 'b' ~ 1 }}{% if false %}x{% elif 'a' == 'a' %}y{% endif %}"
                                "{% for m in messages %}{{ m.role }}{% endfor %}"))
    assert tree[0] == chat.Text("ab1y") and isinstance(tree[1], chat.For)
    t = chat.Template("<s>{% for m in messages %}{% if not loop.first and m.role != 'x' %}|{% endif %}"
                      "{{ m.text | trim }}{% if loop.last %}.{% endif %}{% endfor %}</s>")
    assert [s for s, _ in t.segments([("u", " a "), ("x", "b"), ("u", "c")])] == ["<s>a", "b", "|c.</s>"]
    for bad in ("{{ m.role }}", "{% for m in messages %}{{ m.__class__ }}{% endfor %}", "{{ open('x') }}",
                "{% for m in messages %}", "{% for m in messages %}{{ m.text | eval }}{% endfor %}", "{% if %}{% endif %}",
                "{% for m in other %}{% endfor %}", "plain"):
        with pytest.raises(chat.TemplateError):
            chat.Template(bad)
