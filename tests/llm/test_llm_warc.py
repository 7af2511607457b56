"""WARC archives: round trips, damaged segments, framing."""

import base64
import gzip
import hashlib
import itertools
import random

import pytest
from llm_common import SF_SMALL  # noqa: F401

import __spark_entry__ as entry
from oracle_harness import compare, duck
from pricewise.llm import queries, warc
from pricewise.llm.base import scratch_path

SCHEMA = "page_id long, url string, html string, sha string, first string, body int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "s", "f", 1) for r in rows], SCHEMA)


def expected(rows):
    bodies = [(i, (h or "").encode()) for i, _, h in rows]
    out = []
    for i, b in bodies:
        ids = [j for j, c in bodies if c == b and j is not None]
        to = min(ids) if ids and i != min(ids) else None
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(),
                    "response" if to is None else "revisit", to))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    long = "".join(rng.choice("abc é漢\r\n") for _ in range(300_000))
    rows = [(1, "http://a/é b", "x"), (2, None, None), (3, "", ""), (4, "u", "x"), (4, "u", "x"), (9, "u", None),
            (5, "u\r\nWARC-Type: x", "WARC/1.1\r\n\r\n" * 3000), (6, "u", long), (6, "u", long), (7, "u", long), (8, "u", "y" * 70_000),
            (None, "n", "x"), (None, "n", "only without an id"), (None, "n", "only without an id"), (10, "u", "0\r\n\r\n")]
    return rows + [(100 + i, "u", "a common payload " * 40) for i in range(50)]


def test_round_trip(spark, rows):
    back = warc.round_trip(pages(spark, rows).repartition(4), scratch_path(spark, "warc-test"))
    assert back.where("error is not null").count() == 0
    got = back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(rows)


def test_payloads_come_back(spark, rows):
    for segment, chunk in ((97, 10), (4000, 333)):
        some = [r for r in rows if len(r[2] or "") < 10_000]
        path = warc.write_archives(pages(spark, some), scratch_path(spark, "warc-test"), segment_bytes=segment, chunk_bytes=chunk)
        back = warc.read_archives(spark, path, keep_payload=True).where("record_type = 'response'").collect()
        assert {(r.page_id, r.payload.decode()) for r in back} == \
            {(str(i) if i is not None else None, h or "") for i, _, h in some
             if (i, "response") in {(e[0], e[3]) for e in expected(some)} and
             (i, len((h or "").encode()), "response") in {(e[0], e[1], e[3]) for e in expected(some)}}


def test_binary_payloads_and_short_ones(spark):
    body = bytes(range(256)) * 400
    df = spark.createDataFrame([(i, "u", bytearray(body)) for i in range(3)] + [(i, "u", bytearray(b"ab")) for i in range(3, 6)],
                               "page_id int, url string, html binary")
    back = warc.round_trip(df, scratch_path(spark, "warc-test"), least_bytes=3).orderBy("page_id").collect()
    assert [(r.record_type, r.refers_to, r.payload_bytes) for r in back] == \
        [("response", None, 102400), ("revisit", 0, 102400), ("revisit", 0, 102400)] + [("response", None, 2)] * 3


def test_empty_table(spark):
    back = warc.round_trip(pages(spark, []), scratch_path(spark, "warc-test"))
    assert back.count() == 0


def test_many_small_archives(spark, rows, monkeypatch):
    monkeypatch.setattr(warc, "ROW_BYTES", 50_000)
    monkeypatch.setattr(warc, "FILE_ROWS", 1)
    path = warc.write_archives(pages(spark, rows), scratch_path(spark, "warc-test"))
    assert spark.read.format("binaryFile").load(path).count() > 10      # segments of one page lie in several archives
    assert warc.read_archives(spark, path).count() == len(rows)


def archive(records):
    return b"".join(r + warc.END for r in records)


def read(spark, *contents):
    files = spark.createDataFrame([(bytearray(c),) for c in contents], "content binary")
    parsed = warc.parse_archives(files, True)
    return warc.reassemble(parsed.where("origin is not null"), True).collect()


def test_segments_in_any_order_and_damage(spark):
    page = bytes(random.Random(1).randrange(256) for _ in range(5000))
    parts = list(warc.page_records(1, "u", page, segment_bytes=900, chunk_bytes=250))
    assert len(parts) == 6
    for order in ([5, 4, 3, 2, 1, 0], [2, 0, 5, 1, 4, 3]):
        got = read(spark, archive(parts[i] for i in order[:2]), gzip.compress(archive(parts[i] for i in order[2:])))
        assert len(got) == 1 and got[0].error is None and bytes(got[0].block) == page and got[0].payload_bytes == 5000
    lost = read(spark, archive(parts[:2] + parts[3:]))
    assert lost[0].error == "a segment is missing" and lost[0].payload_bytes is None
    assert read(spark, archive(parts[:-1]))[0].error == "the last segment is missing"
    assert read(spark, archive(parts + parts[1:2]))[0].error == "the segments do not belong together"
    wrong = parts[:-1] + [parts[-1].replace(b"Total-Length: ", b"Total-Length: 1")]
    assert read(spark, archive(wrong))[0].error == "the segments have another length in total"
    bent = [parts[0].replace(b"\r\nfa\r\n", b"\r\nfb\r\n", 1), *parts[1:]]
    assert read(spark, archive(bent))[0].error == "a chunk ends early"
    swapped = [p.replace(warc.sha1_base32(page).encode(), b"A" * 32) for p in parts]
    assert read(spark, archive(swapped))[0].error == "the payload has another digest"
    assert len(read(spark, archive(parts), archive(parts))) == 2


def test_missing_response(spark):
    body = warc.page_records(2, "u", b"x", refers=warc.record_id("response", "1", "u", warc.sha1_base32(b"x")))
    path = scratch_path(spark, "warc-test")
    spark.createDataFrame([(r.decode(),) for r in body], "value string").write.option("lineSep", "\r\n\r\n").text(path)
    row = warc.read_archives(spark, path).first()
    assert row.error == "the response is missing" and row.payload_bytes is None


def test_chunked_framing():
    for n, size in itertools.product((0, 1, 9, 10, 11, 1000), (1, 10, 4096)):
        data = bytes(i % 251 for i in range(n))
        assert warc.unchunked(warc.chunked(data, size)) == data
    assert warc.unchunked(b"3;name=x\r\nabc\r\n0\r\nTrailer: y\r\n\r\n") == b"abc"
    assert warc.http_payload(b"HTTP/1.1 200 OK\r\nContent-Length: 2\r\n\r\nab") == b"ab"
    for bad in (b"", b"5\r\nabc", b"x\r\n", b"3\r\nabcd\r\n0\r\n\r\n", b"0"):
        with pytest.raises(warc.Damaged):
            warc.unchunked(bad)


def test_reader_takes_one_or_many_gzip_members():
    records = [warc.record([("WARC-Type", "response"), ("WARC-Record-ID", f"<{i}>")], b"x" * i) for i in range(50)]
    whole = archive(records)
    for content in (whole, gzip.compress(whole), b"".join(gzip.compress(r + warc.END) for r in records)):
        assert [len(b) for _, b in warc.read_records(warc.inflated(content))] == list(range(50))
    with pytest.raises(warc.Damaged):
        list(warc.read_records(warc.inflated(gzip.compress(whole)[:-40])))
    with pytest.raises(warc.Damaged):
        list(warc.read_records([whole[:-60]]))


def test_query_equals_sql(spark):
    df = queries.op13_warc(spark, SF_SMALL)
    cur = duck(SF_SMALL).execute(entry.oracle_sql()["op13_warc"])
    ok, msgs = compare([tuple(r) for r in df.collect()], df.columns, cur.fetchall(), [d[0] for d in cur.description])
    assert ok, msgs
