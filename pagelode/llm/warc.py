"""Web archives: writing records in segments, and putting them together again.

Writing: a page becomes a ``response`` record whose block is an HTTP response
in chunked transfer framing, or a ``revisit`` record without a payload when its
payload was archived under another page. A long block is cut into segments: the
first record has segment number 1, ``continuation`` records name it as their
origin, and the last one tells the total length. Spark's text writer makes the
files, with the two line ends that close a record as its separator, so tasks
can be repeated and any file system will do; files are gzip streams.

Reading: records are parsed from each file by their lengths. Segments are
grouped by origin, put in the order of their numbers and checked to be gapless
and of the total length told; then the chunked framing is taken off.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the format.
VERSION = b"WARC/1.1"
LINE_END = b"\r\n"
RECORD_END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# The record type told for what cannot be read.
BROKEN = "broken"

SEGMENT = 16_384
CHUNK = 4_096
LEAST_REVISIT = 1_000
RECORDS_PER_FILE = 2_000
_PIECE = 65_536
_ID = "urn:x-page:"


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """The payload in chunked transfer framing."""
    frames = []
    for at in range(0, len(payload), size):
        part = payload[at : at + size]
        frames += (b"%x" % len(part), LINE_END, part, LINE_END)
    return b"".join((*frames, b"0", LINE_END, LINE_END))


def unchunked(framed: bytes) -> bytes:
    """The payload of a chunked body; ValueError if the framing is broken."""
    parts, at = [], 0
    while True:
        end = framed.index(LINE_END, at)
        size = int(framed[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(parts)
        part = framed[at : at + size]
        if len(part) < size or framed[at + size : at + size + 2] != LINE_END:
            raise ValueError("a chunk is cut short")
        parts.append(part)
        at += size + 2


def http_payload(block: bytes) -> bytes:
    """The body of an HTTP response, without its transfer framing; other blocks as they are."""
    if not block.startswith(b"HTTP/"):
        return block
    head, _, body = block.partition(LINE_END * 2)
    fields = head.lower().split(LINE_END)
    is_chunked = any(f.startswith(b"transfer-encoding:") and b"chunked" in f for f in fields)
    return unchunked(body) if is_chunked else body


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = [VERSION, *(f"{k}: {v}".encode() for k, v in fields), b"Content-Length: %d" % len(block)]
    return LINE_END.join((*head, b"", block))


def _one_line(value: str) -> str:
    return " ".join(value.split())


def page_records(page, segment: int = SEGMENT) -> list[bytes]:
    """The records of one page, without the line ends that close them."""
    digest = base64.b32encode(bytes.fromhex(page["digest"])).decode()
    common = [
        ("WARC-Record-ID", f"<{page['record_id']}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", _one_line(page["url"] or page["record_id"])),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    payload = page["payload"]
    if page["refers_to"] is not None:
        fields = [
            ("WARC-Type", "revisit"),
            *common,
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", f"<{_ID}{page['refers_to']}>"),
        ]
        return [_record(fields, head + b"Content-Length: %d\r\n\r\n" % len(payload))]
    block = head + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    first = [("WARC-Type", "response"), *common]
    if len(block) <= segment:
        return [_record(first, block)]
    parts = [block[at : at + segment] for at in range(0, len(block), segment)]
    records = [_record([*first, ("WARC-Segment-Number", "1")], parts[0])]
    for number, part in enumerate(parts[1:], 2):
        fields = [
            ("WARC-Type", "continuation"),
            ("WARC-Record-ID", f"<{page['record_id']}:segment:{number}>"),
            ("WARC-Date", "1970-01-01T00:00:00Z"),
            ("WARC-Target-URI", common[2][1]),
            ("WARC-Segment-Origin-ID", f"<{page['record_id']}>"),
            ("WARC-Segment-Number", str(number)),
        ]
        if number == len(parts):
            fields.append(("WARC-Segment-Total-Length", str(len(block))))
        records.append(_record(fields, part))
    return records


def write_archives(
    pages: DataFrame,
    path: str,
    *,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    segment: int = SEGMENT,
    least_revisit: int = LEAST_REVISIT,
    records_per_file: int = RECORDS_PER_FILE,
) -> None:
    """Write one logical record per row of ``pages`` to archive files under ``path``.

    The payload is the html in UTF-8, empty for null. Of rows with equal
    payloads of ``least_revisit`` bytes or more, that with the largest page_id
    is the response and the others revisit it. Rows that repeat a page_id are
    written each, under record ids of their own; rows that repeat the largest
    one are responses all. Rows with a null page_id are responses under the id
    ``null``, and revisit nothing. A null url gives way to the record id. An
    empty table writes archives without records.
    """
    rows = pages.select(
        pages[page_id].cast("bigint").alias("page_id"),
        pages[url].cast("string").alias("url"),
        F.encode(F.coalesce(pages[html], F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    # What each (page, payload) becomes, without the payloads; then one join brings
    # them together, by a key that is never hot.
    narrow = rows.select("page_id", "digest", F.octet_length("payload").alias("length"))
    kinds = narrow.groupBy("page_id", "digest").agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("length"))
    long = (F.col("length") >= least_revisit) & F.col("page_id").isNotNull()
    first = (
        kinds.where(long)
        .groupBy("digest")
        .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("pages"))
        .where("pages > 1")
        .select("digest", "first")
    )
    repeated = narrow.groupBy("page_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1 or page_id is null")
    told = (
        kinds.join(first, "digest", "left")
        .join(repeated.select(F.col("page_id").alias("again"), "rows"), F.col("page_id").eqNullSafe(F.col("again")), "left")
        .select(
            F.col("page_id").alias("id"),
            F.col("digest").alias("same"),
            F.when(long & (F.col("first") != F.col("page_id")), F.col("first")).alias("refers_to"),
            F.col("rows").isNotNull().alias("numbered"),
        )
    )
    number = F.when(
        F.col("numbered"), F.concat(F.lit(":"), F.monotonically_increasing_id().cast("string"))
    ).otherwise("")
    told = rows.join(
        told.hint("merge"), F.col("page_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("same"))
    ).select(
        F.concat(F.lit(_ID), F.coalesce(F.col("page_id").cast("string"), F.lit("null")), number).alias("record_id"),
        "url",
        "payload",
        "digest",
        "refers_to",
    )

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                found = []
                for page in batch.slice(at, 64).to_pylist():
                    found += page_records(page, segment)
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["record"])

    records = told.mapInArrow(run, "record BINARY").select(F.col("record").cast("string"))
    (
        records.write.option("lineSep", RECORD_END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


def inflated(content: bytes) -> tuple[bytes, bool]:
    """What a file holds, and whether it is whole: plain, or any number of gzip members.

    The members are read in small pieces, so what is left is not copied per member.
    """
    if content[:2] != b"\x1f\x8b":
        return content, True
    parts, at = [], 0
    while at < len(content):
        stream = zlib.decompressobj(31)
        while at < len(content) and not stream.eof:
            piece = content[at : at + _PIECE]
            at += len(piece)
            try:
                parts.append(stream.decompress(piece))
            except zlib.error:
                return b"".join(parts), False
        if not stream.eof:
            return b"".join(parts), False
        at -= len(stream.unused_data)
        # Zeros may fill up what follows a member.
        while content[at : at + 1] == b"\0":
            at += 1
    return b"".join(parts), True


def parse_records(content: bytes):
    """(fields, block) of every record of an archive file.

    Where the file breaks off, or no record begins, the last pair is (None, b"").
    """
    raw, whole = inflated(content)
    at = 0
    while True:
        while raw[at : at + 2] == LINE_END:
            at += 2
        if at >= len(raw):
            break
        end = raw.find(LINE_END * 2, at)
        version, *lines = raw[at:end].split(LINE_END)
        fields = {}
        for line in lines:
            name, _, value = line.partition(b":")
            fields[name.strip().lower().decode(errors="replace")] = value.strip().decode(errors="replace")
        length = fields.get("content-length", "")
        start = end + 4
        if end < 0 or not version.startswith(b"WARC/") or not length.isdecimal() or start + int(length) > len(raw):
            whole = False
            break
        at = start + int(length)
        yield fields, raw[start:at]
    if not whole:
        yield None, b""


def told_digest(field: str | None) -> str | None:
    """The SHA-1 a digest field tells, in hex; None for other algorithms and broken fields."""
    algorithm, _, digest = (field or "").partition(":")
    if algorithm.lower() != "sha1":
        return None
    if len(digest) == 40:
        return digest.lower()
    try:
        return base64.b32decode(digest.upper()).hex()
    except ValueError:
        return None


def _page_of(identifier: str | None) -> int | None:
    if not identifier or not identifier.startswith(f"<{_ID}"):
        return None
    number = identifier[1 + len(_ID) : -1].split(":")[0]
    return int(number) if number.lstrip("-").isdecimal() else None


_PARSED = """record_id STRING, page_id BIGINT, record_type STRING, refers_to BIGINT, told STRING,
    length BIGINT, segment INT, total BIGINT, block BINARY"""
_PARSED_ARROW = pa.schema(
    [
        ("record_id", pa.string()),
        ("page_id", pa.int64()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("told", pa.string()),
        ("length", pa.int64()),
        ("segment", pa.int32()),
        ("total", pa.int64()),
        ("block", pa.binary()),
    ]
)


def _number(value: str | None) -> int | None:
    return int(value) if value and value.isdecimal() else None


def _parsed(fields: dict[str, str] | None, block: bytes) -> tuple:
    if fields is None:
        return None, None, BROKEN, None, None, None, None, None, b""
    kind = fields.get("warc-type")
    length = None
    if kind == "revisit":
        heads = dict(line.lower().partition(b":")[::2] for line in block.split(LINE_END))
        length = _number(heads.get(b"content-length", b"").strip().decode(errors="replace"))
    return (
        fields.get("warc-segment-origin-id") or fields.get("warc-record-id"),
        _page_of(fields.get("warc-record-id")),
        kind,
        _page_of(fields.get("warc-refers-to")),
        told_digest(fields.get("warc-payload-digest")),
        length,
        _number(fields.get("warc-segment-number")),
        _number(fields.get("warc-segment-total-length")),
        block,
    )


def _is_segment(fields: dict[str, str] | None) -> bool:
    """Of a record in segments that can be found again; without an id it stands alone."""
    if fields is None or "warc-segment-number" not in fields:
        return False
    return "warc-segment-origin-id" in fields or "warc-record-id" in fields


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per logical record: record_id, page_id, record_type, refers_to,
    payload_bytes, payload_digest, complete and payload.

    ``payload_bytes`` and ``payload_digest`` (hex SHA-1) are those of the
    payload that was read, or for a revisit those it tells. ``complete`` is
    false, and the payload null, where segments are missing, their length is not
    the total told, the framing is broken or the digest differs from the told
    one. Only segmented records are shuffled. A group is one record.

    Files are plain or gzip, with one member or one per record. A file that
    breaks off, in a member or in a record, or goes on with something else gives
    the records before that point and one more row, not complete, of the record
    type ``broken``. A digest that is not SHA-1 is not checked. A record without
    an id has a null one; without a type, a null type. A block that is no HTTP
    response is its own payload.
    """
    files = spark.read.format("binaryFile").load(path).select("content")

    def taken(batches, segmented: bool):
        for batch in batches:
            for content in batch.column(0):
                for fields, block in parse_records(content.as_py()):
                    if _is_segment(fields) == segmented:
                        yield _parsed(fields, block)

    def segments(batches):
        for some in itertools.batched(taken(batches, True), 64):
            yield _rows(some, _PARSED_ARROW)

    def whole(batches):
        for some in itertools.batched(taken(batches, False), 64):
            yield _rows([_decoded(*r) for r in some], _READ_ARROW)

    parts = files.mapInArrow(segments, _PARSED)
    first = F.col("segment") == 1
    # Segments of 16 KiB and less; their order and length are checked where they are joined.
    joined = parts.groupBy("record_id").agg(
        F.max(F.when(first, F.col("page_id"))).alias("page_id"),
        F.max(F.when(first, F.col("record_type"))).alias("record_type"),
        F.max("refers_to").alias("refers_to"),
        F.max("told").alias("told"),
        F.max("length").alias("length"),
        F.max("total").alias("total"),
        F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("parts"),
    )

    def decode(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                found = []
                for *told, length, total, listed in zip(*batch.slice(at, 64).to_pydict().values(), strict=True):
                    block = b"".join(p["block"] for p in listed)
                    gapless = [p["segment"] for p in listed] == list(range(1, len(listed) + 1))
                    total = total if gapless and len(block) == total else -1
                    found.append(_decoded(*told, length, None, total, block))
                yield _rows(found, _READ_ARROW)

    return files.mapInArrow(whole, _READ).union(joined.mapInArrow(decode, _READ))


def _decoded(record_id, page_id, record_type, refers_to, told, length, segment, total, block) -> tuple:
    """A logical record as a result row; ``total`` is -1 if its segments do not add up."""
    payload, digest, complete = None, told, True
    # One segment that stands alone is not the record.
    if record_type == BROKEN or segment is not None:
        complete = False
    elif record_type != "revisit":
        try:
            payload = http_payload(block) if total != -1 else None
        except ValueError:
            payload = None
        if payload is not None:
            length, digest = len(payload), hashlib.sha1(payload).hexdigest()
        complete = payload is not None and told in (None, digest)
        payload = payload if complete else None
    name = record_id[1:-1] if record_id and record_id[0] == "<" else record_id
    return name, page_id, record_type, refers_to, length, digest, complete, payload


_READ = """record_id STRING, page_id BIGINT, record_type STRING, refers_to BIGINT,
    payload_bytes BIGINT, payload_digest STRING, complete BOOLEAN, payload BINARY"""
_READ_ARROW = pa.schema(
    [
        ("record_id", pa.string()),
        ("page_id", pa.int64()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("complete", pa.bool_()),
        ("payload", pa.binary()),
    ]
)


def _rows(found, schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*found, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )
