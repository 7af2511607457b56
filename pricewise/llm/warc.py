"""WARC archives: pages written as records, read back by segment reassembly.

Writing: each page becomes an HTTP response record with chunked transfer
framing; a page whose payload an earlier one (by id) holds becomes a revisit
record. Blocks longer than a limit are cut into a first record and
continuation records. Spark's text writer puts the records into gzip files of
bounded size: rows are runs of records, and its line separator is the empty
line pair that ends a record.

Reading: every archive is parsed record by record by the lengths in its
headers. Whole records are decoded on the spot. Segments are grouped by the
identifier of their origin, ordered by number, checked for gaps and for the
total length that the last one states, and joined; then the chunked framing is
decoded and the payload compared with its digest.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import cut, small, small_batches

# Fixed values of the format
VERSION = b"WARC/1.1"
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"

SEGMENT_BYTES = 16 << 10    # longest block of one record
CHUNK_BYTES = 4 << 10       # payload bytes of one transfer chunk
ROW_BYTES = 1 << 20         # records are handed to the writer in runs of about this size
FILE_ROWS = 32              # runs in one archive: about 32 MB before compression
READ_BYTES = 1 << 20        # bytes inflated at a time
DATE = "2020-01-01T00:00:00Z"

_PARSED = ("record_id string, origin string, number long, total long, record_type string, page_id string, url string, "
           "payload_digest string, refers string, payload_bytes long, error string, block binary")
_NAMES = [f.split()[0] for f in _PARSED.split(", ")]
_TYPES = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
_SCHEMA = pa.schema([(n, _TYPES[t]) for n, t in (f.split() for f in _PARSED.split(", "))])


class Damaged(ValueError):
    """The bytes are not what their headers state."""


# ---- records ---------------------------------------------------------------------------------------

def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(kind: str, *parts: object) -> str:
    """The same identifier for the same parts, whatever task asks."""
    h = hashlib.md5("\n".join([kind, *(repr(p) for p in parts)]).encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def chunked(payload: bytes, size: int) -> bytes:
    """Chunked transfer framing."""
    parts = []
    for i in range(0, len(payload), size):
        piece = payload[i:i + size]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """Payload of a body in chunked transfer framing; chunk extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        try:
            size = int(body[at:end].split(b";")[0], 16) if end >= 0 else -1
        except ValueError:
            size = -1
        if size < 0:
            raise Damaged("no chunk size")
        at = end + 2
        if not size:
            if body.find(b"\r\n", at) < 0:
                raise Damaged("the last chunk is not closed")
            return b"".join(out)
        if body[at + size:at + size + 2] != b"\r\n":
            raise Damaged("a chunk ends early")
        out.append(body[at:at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    """Payload of an HTTP response block."""
    end = block.find(END)
    if end < 0:
        raise Damaged("no end of the response headers")
    fields = [line.partition(b":") for line in block[:end].lower().split(b"\r\n")[1:]]
    body = block[end + 4:]
    return unchunked(body) if any(n.strip() == b"transfer-encoding" and b"chunked" in v for n, _, v in fields) else body


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """A record without the empty lines after it; fields without a value are left out."""
    lines = [VERSION, *(f"{n}: {v}".encode() for n, v in fields if v is not None), b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + END + block


def page_records(page_id: object, url: str | None, payload: bytes, refers: str | None = None,
                 segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES) -> Iterator[bytes]:
    """Records of one page: a revisit of ``refers``, or a response in as many segments as it needs."""
    uri = None if url is None else quote(url, safe="".join(map(chr, range(33, 127))))
    digest = sha1_base32(payload)
    kind = "revisit" if refers else "response"
    name = record_id(kind, page_id, url, digest)
    fields = [("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Date", DATE), ("WARC-Target-URI", uri),
              ("WARC-Payload-Digest", "sha1:" + digest), ("X-Page-ID", page_id),
              ("Content-Type", "application/http; msgtype=response")]
    if refers:
        yield record([*fields, ("WARC-Profile", PROFILE), ("WARC-Refers-To", refers)], HTTP + b"\r\n")
        return
    block = HTTP + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload, chunk_bytes)
    if len(block) <= segment_bytes:
        yield record(fields, block)
        return
    yield record([*fields, ("WARC-Segment-Number", 1)], block[:segment_bytes])
    for i in range(segment_bytes, len(block), segment_bytes):
        number = i // segment_bytes + 1
        yield record([("WARC-Type", "continuation"), ("WARC-Record-ID", record_id("continuation", name, number)),
                      ("WARC-Date", DATE), ("WARC-Target-URI", uri), ("WARC-Segment-Origin-ID", name),
                      ("WARC-Segment-Number", number),
                      ("WARC-Segment-Total-Length", len(block) if i + segment_bytes >= len(block) else None)],
                     block[i:i + segment_bytes])


def inflated(content: bytes) -> Iterator[bytes]:
    """Pieces of an archive's bytes; gzip members, one or many, are inflated."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    while content:
        z = zlib.decompressobj(31)
        while not z.eof:
            piece = z.decompress(content, READ_BYTES)
            content = z.unconsumed_tail
            if piece:
                yield piece
            elif not content and not z.eof:
                raise Damaged("the archive ends early")
        content = z.unused_data


def read_records(pieces: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields in lower case, block) of each record, holding one record at a time."""
    pieces, buf = iter(pieces), bytearray()

    def fill(size: int) -> bool:
        while len(buf) < size:
            piece = next(pieces, None)
            if piece is None:
                return False
            buf.extend(piece)
        return True

    while True:
        while (end := buf.find(END)) < 0:
            if not fill(len(buf) + 1):
                if buf.strip():
                    raise Damaged("a record's headers end early")
                return
        lines = bytes(buf[:end]).decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise Damaged("no record starts here")
        fields = {n.strip().lower(): v.strip() for n, _, v in (line.partition(":") for line in lines[1:])}
        size = int(fields["content-length"])
        if not fill(end + 4 + size):
            raise Damaged("a record's block ends early")
        yield fields, bytes(buf[end + 4:end + 4 + size])
        del buf[:end + 4 + size]
        while fill(2) and buf[:2] == b"\r\n":
            del buf[:2]


# ---- writing ---------------------------------------------------------------------------------------

def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html",
                   least_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES) -> str:
    """Write a record per row of ``pages`` below ``path``; returns ``path``.

    Null payloads are empty; text is written in UTF-8, binary payloads as they
    are. Of rows with equal payloads of at least ``least_bytes``, those with the
    smallest id are responses and the others revisit them; rows without an id
    revisit if any row has one, else all are responses. Repeated rows are
    written as often as they occur. Other columns are not read.
    """
    small_batches(pages.sparkSession)
    body = F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(bytearray()))
    src = pages.select(F.col(f"`{page_id}`").cast("string").alias("id"), F.col(f"`{page_id}`").alias("order"),
                       F.col(f"`{url}`").alias("url"), body.alias("body")).withColumn("sha", F.sha1("body"))
    first = src.where(F.length("body") >= least_bytes).groupBy("sha").agg(
        F.count("*").alias("n"), F.min(F.when(F.col("order").isNotNull(), F.struct("order", "id", "url"))).alias("first"))
    # one row per payload that occurs more than once, so that a common payload's rows can be split
    first = small(cut(first.where("n > 1 and first is not null").select("sha", "first"), "warc-first"))
    rows = src.join(first, "sha", "left").select(
        "id", "url", "body", F.when(~F.col("order").eqNullSafe(F.col("first.order")), F.col("first.id")).alias("to_id"),
        F.col("first.url").alias("to_url"))

    def run(batches):
        held, size = [], 0
        for batch in batches:
            out = []
            for id_, url_, body_, to_id, to_url in zip(*(c.to_pylist() for c in batch.columns)):
                refers = None if to_id is None else record_id("response", to_id, to_url, sha1_base32(body_))
                for r in page_records(id_, url_, body_, refers, segment_bytes, chunk_bytes):
                    held.append(r)
                    size += len(r)
                    if size >= ROW_BYTES:
                        out.append(END.join(held))
                        held, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([END.join(held)], pa.binary())], names=["value"])

    rows.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value")).write.options(
        lineSep=END.decode(), compression="gzip", maxRecordsPerFile=FILE_ROWS).text(path)
    return path


# ---- reading ---------------------------------------------------------------------------------------

def _decoded(block: bytes, stated: str | None) -> tuple[int | None, str | None, str | None, bytes | None]:
    """(payload_bytes, payload_digest, error, payload) of an HTTP response block."""
    try:
        payload = http_payload(block)
    except Damaged as e:
        return None, stated, str(e), None
    digest = sha1_base32(payload)
    return len(payload), digest, None if stated in (None, digest) else "the payload has another digest", payload


def _row(fields: dict[str, str], block: bytes, keep: bool) -> tuple:
    kind, number = fields.get("warc-type"), fields.get("warc-segment-number")
    name, digest = fields.get("warc-record-id"), fields.get("warc-payload-digest")
    digest = digest.partition(":")[2] if digest else None
    common = (kind, fields.get("x-page-id"), fields.get("warc-target-uri"))
    if number is not None:
        total = fields.get("warc-segment-total-length")
        return (name, fields.get("warc-segment-origin-id", name), int(number), None if total is None else int(total),
                *common, digest, None, None, None, block)
    if kind == "response":
        n, digest, error, payload = _decoded(block, digest)
        return (name, None, None, None, *common, digest, None, n, error, payload if keep else None)
    return (name, None, None, None, *common, digest, fields.get("warc-refers-to"), None, None, None)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)


def parse_archives(files: DataFrame, keep_payload: bool = False) -> DataFrame:
    """Responses, revisits and segments of archives given by their ``content``; other record types are skipped.

    Whole responses come decoded (payload in ``block`` if asked for), segments with their block.
    """
    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                held, size = [], 0
                for fields, block in read_records(inflated(content.as_py() or b"")):
                    if fields.get("warc-type") in ("response", "revisit", "continuation"):
                        held.append(_row(fields, block, keep_payload))
                        size += len(held[-1][-1] or b"") + 300
                        if size >= ROW_BYTES:
                            yield _rows(held)
                            held, size = [], 0
                if held:
                    yield _rows(held)
    return files.select("content").mapInArrow(run, _PARSED)


def reassemble(segments: DataFrame, keep_payload: bool = False) -> DataFrame:
    """One row per segmented record (``parse_archives`` columns), joined and decoded.

    Copies of a whole record count as often as its first segment occurs.
    Missing, surplus or differing segments and a wrong total give a row with
    ``error`` and no payload. A task holds one record's block at a time.
    """
    def whole(parts: list[tuple], counts: list[int], same: bool) -> Iterator[pa.RecordBatch]:
        name, head, total = parts[0][1], parts[0], parts[-1][3]
        block = b"".join(p[11] for p in parts)
        error = None
        if [p[2] for p in parts] != list(range(1, len(parts) + 1)):
            error = "a segment is missing"
        elif total is None:
            error = "the last segment is missing"
        elif not same or len(set(counts)) > 1 or any(p[3] is not None for p in parts[:-1]):
            error = "the segments do not belong together"
        elif total != len(block):
            error = "the segments have another length in total"
        n, digest, payload = None, head[7], None
        if error is None:
            n, digest, error, payload = _decoded(block, head[7])
        kind = "response" if head[4] == "continuation" else head[4]
        payload = payload if keep_payload else None
        row = (name, None, None, None, kind, head[5], head[6], digest, None, n, error, payload)
        step = max(1, min(100, ROW_BYTES // (len(payload or b"") + 300)))
        for i in range(0, counts[0], step):
            yield _rows([row] * min(step, counts[0] - i))

    def run(batches):
        parts, counts, same = [], [], True
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                if parts and r[1] != parts[0][1]:
                    yield from whole(parts, counts, same)
                    parts, counts, same = [], [], True
                if parts and r[2] == parts[-1][2]:
                    counts[-1] += 1
                    same = same and r[11] == parts[-1][11]
                else:
                    parts.append(r)
                    counts.append(1)
        if parts:
            yield from whole(parts, counts, same)

    small_batches(segments.sparkSession)
    return segments.repartition("origin").sortWithinPartitions("origin", "number").mapInArrow(run, _PARSED)


def read_archives(spark: SparkSession, path: str, keep_payload: bool = False) -> DataFrame:
    """One row per page of the archives below ``path``.

    Columns: page_id (string), url, payload_bytes, payload_digest (base32
    SHA-1), record_type (response or revisit), refers_to (page id of the
    response that a revisit names, else null), error (null if all is sound)
    and, if asked for, payload (null for revisits). A revisit takes the length of
    the response; if that is absent, it has an error. Archives are read whole
    by one task each, so their size bounds its memory.
    """
    parsed = cut(parse_archives(spark.read.format("binaryFile").load(path), keep_payload), "warc-records")
    done = parsed.where("origin is null").unionByName(reassemble(parsed.where("origin is not null"), keep_payload))
    done = cut(done, "warc-pages")
    named = done.where("record_type = 'revisit'").select(F.col("refers").alias("record_id")).distinct()
    target = done.where("record_type = 'response'").join(named, "record_id", "left_semi").groupBy("record_id").agg(
        F.first("page_id").alias("to_page"), F.first("payload_bytes").alias("to_bytes"), F.count("*").alias("found"))
    target = small(cut(target.withColumnRenamed("record_id", "refers"), "warc-targets"))
    lost = (F.col("record_type") == "revisit") & F.col("found").isNull()
    return done.join(target, "refers", "left").select(
        "page_id", "url", F.coalesce("payload_bytes", "to_bytes").alias("payload_bytes"), "payload_digest", "record_type",
        F.col("to_page").alias("refers_to"),
        F.when(lost, F.lit("the response is missing")).otherwise(F.col("error")).alias("error"),
        *([F.col("block").alias("payload")] if keep_payload else []))


def round_trip(pages: DataFrame, path: str, **params) -> DataFrame:
    """Write ``pages`` as archives below ``path`` and read them back; ids in the type of ``page_id``."""
    id_type = dict(pages.dtypes)[params.get("page_id", "page_id")]
    back = read_archives(pages.sparkSession, write_archives(pages, path, **params))
    return back.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})
