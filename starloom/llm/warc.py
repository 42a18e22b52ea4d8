"""WARC archives: writing with segmented records, reading with reassembly.

A payload goes into an HTTP response with chunked framing. A record block over
``segment_bytes`` is cut: the first piece stays in the record (segment 1), the others
go into continuation records that name the origin record, the last with the total
length. The reader groups continuations by origin identifier, orders them by segment
number, verifies that none is missing and that the total length holds, and decodes
the chunked framing. Equal payloads are stored once; later ones revisit the first.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.arrow import flat_map_rows, map_rows

SEGMENT_BYTES = 32_768
CHUNK_BYTES = 8_192
#: Records in a file: with the segment length, a file has 16 MB at most.
FILE_RECORDS = 480

_CRLF = b"\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing."""
    out = [b"%x\r\n%b\r\n" % (len(p), p) for p in (payload[i : i + size] for i in range(0, len(payload), size))]
    return b"".join(out) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes | None:
    """The payload in a chunked body; None if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(_CRLF, at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]+", size):
            return None
        n, at = int(size, 16), end + 2
        if not n:
            return b"".join(out)
        if body[at + n : at + n + 2] != _CRLF:
            return None
        out.append(body[at : at + n])
        at += n + 2


def http_payload(block: bytes) -> bytes | None:
    head, mark, body = block.partition(b"\r\n\r\n")
    if not mark:
        return None
    return unchunked(body) if re.search(rb"(?im)^transfer-encoding:[ \t]*chunked[ \t]*\r?$", head) else body


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return b"WARC/1.1\r\n%bContent-Length: %d\r\n\r\n%b\r\n\r\n" % (head.encode(), len(block), block)


def _id(*parts) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(repr(parts).encode()).hexdigest())}>"


def page_records(page, url, payload: bytes, first, segment: int, number: int = 0):
    """The records of one page. ``first``: the page whose payload is the same;
    ``number`` tells rows apart that are equal in all else."""
    digest, uri = payload_digest(payload), re.sub(r"[\s\x00-\x1f]", "%20", url or "")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    common = [("WARC-Date", _DATE), ("WARC-Target-URI", uri), ("WARC-Page-ID", page), ("WARC-Payload-Digest", f"sha1:{digest}")]
    typed = ("Content-Type", "application/http; msgtype=response")
    own = _id("record", page, url, digest, number)
    if first is not None and page is not None and first != page:
        yield _record(
            [("WARC-Type", "revisit"), ("WARC-Record-ID", own), *common, ("WARC-Profile", _PROFILE), ("WARC-Refers-To-Page-ID", first), typed],
            http,
        )
        return
    block = http + chunked(payload)
    pieces = [block[i : i + segment] for i in range(0, len(block), segment)]
    split = len(pieces) > 1
    yield _record(
        [("WARC-Type", "response"), ("WARC-Record-ID", own), *common, ("WARC-Segment-Number", 1 if split else None), typed], pieces[0]
    )
    for n, piece in enumerate(pieces[1:], 2):
        total = len(block) if n == len(pieces) else None
        yield _record(
            [("WARC-Type", "continuation"), ("WARC-Record-ID", _id("segment", own, n)), *common]
            + [("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", n), ("WARC-Segment-Total-Length", total)],
            piece,
        )


def write_archives(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_bytes: int = 0,
    segment_bytes: int = SEGMENT_BYTES,
) -> None:
    """Writes a response or revisit record for each row into gzip files under ``path``.

    A null html is an empty payload, a null url an empty address. Of rows with equal
    payloads of at least ``least_bytes`` the smallest key is the response, and so
    are its repeats and rows with a null key. Each row has a record id of its own:
    all its records are made by one task, from the number that the row has there.
    Other columns are not read.
    """
    rows = pages.select(
        F.col(key).cast("bigint").alias("page"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("same", F.sha2("payload", 256))
    big = F.octet_length("payload") >= least_bytes
    firsts = rows.filter(big).groupBy("same").agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = firsts.filter("n > 1").drop("n")
    paired = rows.join(firsts, "same", "left")

    def setup():
        def each(page, address, payload, first, number):
            # the files' writer ends each record with the last of its line ends
            return ((r[:-1],) for r in page_records(page, address, payload, first, segment_bytes, number))

        return each

    numbered = paired.select("page", "url", "payload", "first", F.monotonically_increasing_id().alias("number"))
    records = flat_map_rows(numbered, setup, "record binary")
    files = records.select(F.col("record").cast("string").alias("value"))
    files.write.option("lineSep", "\n").option("maxRecordsPerFile", FILE_RECORDS).option("compression", "gzip").text(path)


def parse(data: bytes):
    """(fields with lower-case names, block) of each record of a file, which may
    be compressed as a whole or record by record."""
    at, data = 0, gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
    while (start := data.find(b"WARC/", at)) >= 0:
        end = data.index(b"\r\n\r\n", start)
        lines = data[start:end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        n = int(fields["content-length"])
        yield fields, data[end + 4 : end + 4 + n]
        at = end + 8 + n


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record as stored, segments apart."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def number(text):
        return int(text) if text is not None else None

    def each(content):
        for f, block in parse(content):
            yield (
                f.get("warc-type"),
                f.get("warc-record-id"),
                number(f.get("warc-page-id")),
                (f.get("warc-payload-digest") or "").removeprefix("sha1:"),
                number(f.get("warc-refers-to-page-id")),
                f.get("warc-segment-origin-id"),
                number(f.get("warc-segment-number")),
                number(f.get("warc-segment-total-length")),
                block,
            )

    return flat_map_rows(
        files,
        lambda: each,
        "record_type string, record_id string, page_id bigint, payload_digest string, refers_to bigint, "
        "origin_id string, segment bigint, total_length bigint, block binary",
    )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``page_id``, ``record_type``, ``payload_digest``, ``refers_to`` and
    ``payload`` of each logical record; the payload of a revisit is null, and so is
    one whose segments, total length, framing or digest don't hold together."""
    records = read_records(spark, path)
    whole = records.filter("segment IS NULL")
    parts = records.filter("segment IS NOT NULL").withColumn("origin", F.coalesce("origin_id", "record_id"))
    first = F.col("segment") == 1
    joined = (
        parts.groupBy("origin")
        .agg(
            *(F.max(F.when(first, F.col(c))).alias(c) for c in ("record_type", "page_id", "payload_digest", "refers_to")),
            F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("parts"),
            F.max("total_length").alias("total_length"),
        )
        .filter("record_type IS NOT NULL")
    )
    columns = ["record_type", "page_id", "payload_digest", "refers_to"]
    one = whole.select(*columns, F.array(F.struct(F.lit(1).cast("bigint").alias("segment"), "block")).alias("parts"), F.octet_length("block").cast("bigint").alias("total_length"))

    def each(kind, page, digest, refers, segments, total):
        block = b"".join(s["block"] for s in segments)
        good = [s["segment"] for s in segments] == list(range(1, len(segments) + 1)) and len(block) == total
        payload = http_payload(block) if good and kind == "response" else None
        if payload is not None and payload_digest(payload) != digest:
            payload = None
        return kind, page, digest, refers, payload

    ddl = "record_type string, page_id bigint, payload_digest string, refers_to bigint, payload binary"
    return map_rows(one.unionByName(joined.select(*one.columns)), lambda: each, ddl)


def index(archive: DataFrame) -> DataFrame:
    """``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type`` and
    ``refers_to`` of each logical record; a revisit has the length of the payload
    that it refers to."""
    sized = archive.withColumn("n", F.octet_length("payload").cast("bigint")).drop("payload")
    referred = (
        sized.filter((F.col("record_type") == "response") & F.col("page_id").isNotNull())
        .groupBy(F.col("page_id").alias("of"), F.col("payload_digest").alias("as"))
        .agg(F.max("n").alias("first_n"))
    )
    met = sized.join(referred, (F.col("refers_to") == F.col("of")) & (F.col("payload_digest") == F.col("as")), "left")
    return met.select("page_id", F.coalesce("n", "first_n").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
