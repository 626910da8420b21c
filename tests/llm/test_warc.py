from __future__ import annotations

import gzip
import hashlib
import time

import pytest

from pagelode.llm import warc
from pagelode.session import scratch_path


@pytest.mark.parametrize("payload", [b"", b"x", b"\r\n0\r\n\r\n" * 9, bytes(range(256)) * 40])
@pytest.mark.parametrize("size", [1, 7, 4096])
def test_chunked_framing_round_trip(payload, size):
    assert warc.unchunked(warc.chunked(payload, size)) == payload


@pytest.mark.parametrize("framed", [b"5\r\nabc", b"zz\r\n", b"3\r\nabcX0\r\n\r\n", b""])
def test_broken_framing_is_told(framed):
    with pytest.raises(ValueError):
        warc.unchunked(framed)


@pytest.fixture
def pages(spark):
    long, tricky = "Ünï<p>" * 9000, "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 50
    rows = [(1, "http://a/", long), (2, None, long), (3, "http://c/", None), (4, "x\ny", "")]
    rows += [(5, "u", "s" * 999), (6, "u", "s" * 999), (7, "u", "t" * 1000), (8, "u", "t" * 1000)]
    rows += [(9, "u", tricky), (8, "u", "t" * 1000), (None, "u", "t" * 1000), (10, "u", "\U0001f600" * 20000)]
    return spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING").selectExpr("*", "1 as first", "2 as digest")


def test_archives_round_trip(spark, pages):
    path = scratch_path(spark, "warc")
    warc.write_archives(pages, path, segment=5000, records_per_file=3)
    got = warc.read_archives(spark, path).collect()
    assert all(r.complete for r in got)
    rows = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    largest = {}
    for i, body in rows:
        if i is not None and len(body) >= 1000:
            largest[body] = max(largest.get(body, i), i)
    expected = []
    for i, body in rows:
        to = largest.get(body) if i is not None else None
        to = None if to == i else to
        expected.append((str(i), len(body), hashlib.sha1(body).hexdigest(), "revisit" if to else "response", to))
    told = [(str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(told, key=str) == sorted(expected, key=str)
    assert sorted(bytes(r.payload) for r in got if r.record_type == "response") == sorted(
        b for (_, b), e in zip(rows, expected, strict=True) if e[3] == "response"
    )
    assert len({r.record_id for r in got}) == len(rows)


def test_a_lost_segment_is_told(spark, tmp_path):
    page = {"record_id": "urn:x-page:1", "url": "u", "payload": b"q" * 9000, "refers_to": None}
    page["digest"] = hashlib.sha1(page["payload"]).hexdigest()
    records = warc.page_records(page, segment=2000)
    assert len(records) > 3
    for gone in range(1, len(records)):
        kept = [r for i, r in enumerate(records) if i != gone]
        folder = tmp_path / str(gone)
        folder.mkdir()
        (folder / "a.warc.gz").write_bytes(gzip.compress(b"".join(r + b"\r\n\r\n" for r in reversed(kept))))
        (got,) = warc.read_archives(spark, str(folder)).collect()
        assert not got.complete and got.payload is None
    whole = tmp_path / "whole"
    whole.mkdir()
    for i, r in enumerate(records):
        (whole / f"{9 - i}.warc").write_bytes(r + b"\r\n\r\n")
    (got,) = warc.read_archives(spark, str(whole)).collect()
    assert got.complete and bytes(got.payload) == page["payload"]


def test_empty_table(spark, pages):
    path = scratch_path(spark, "warc")
    warc.write_archives(pages.limit(0), path)
    assert warc.read_archives(spark, path).count() == 0


def _read(spark, folder, *contents):
    folder.mkdir()
    for i, content in enumerate(contents):
        (folder / f"{i}.warc.gz").write_bytes(content)
    return warc.read_archives(spark, str(folder)).collect()


def _page(i, payload):
    return {"record_id": f"urn:x-page:{i}", "url": "u", "payload": payload, "refers_to": None, "digest": hashlib.sha1(payload).hexdigest()}


def test_one_gzip_member_per_record(spark, tmp_path):
    pages = [_page(i, bytes([65 + i % 26]) * (i * 997)) for i in range(40)]
    records = [r + b"\r\n\r\n" for p in pages for r in warc.page_records(p, segment=3000)]
    members = [gzip.compress(r) for r in records]
    assert len(members) > 200
    got = _read(spark, tmp_path / "a", b"".join(members[:77]), b"".join(members[77:]) + b"\0" * 512)
    assert {r.page_id: (r.complete, bytes(r.payload)) for r in got} == {i: (True, p["payload"]) for i, p in enumerate(pages)}


def test_short_and_foreign_files_are_told(spark, tmp_path):
    records = [r + b"\r\n\r\n" for i in range(3) for r in warc.page_records(_page(i, b"x" * 50 * (i + 1)))]
    members = [gzip.compress(r) for r in records]
    whole = b"".join(members)

    def told(name, *contents):
        return sorted((str(r.page_id), r.record_type, r.complete) for r in _read(spark, tmp_path / name, *contents))

    ok = [(str(i), "response", True) for i in range(3)]
    broken = ("None", "broken", False)
    assert told("whole", whole) == ok
    assert told("trailer", whole[:-4]) == [*ok, broken]
    assert told("cut", b"".join(members[:2]) + members[2][:-20]) in ([*ok[:2], broken], [*ok, broken])
    assert told("plain", b"".join(records)[:-30]) == [*ok[:2], broken]
    assert told("noise", members[0] + b"noise") == [ok[0], broken]
    assert told("text", b"no archive at all") == [broken]
    assert told("length", b"WARC/1.1\r\nContent-Length: many\r\n\r\n") == [broken]
    assert told("several", whole, b"", b"no archive", members[1]) == sorted([*ok, ok[1], broken])


def test_fields_of_other_writers(spark, tmp_path):
    body = b"HTTP/1.1 200 OK\r\n\r\nhello"
    sha = hashlib.sha1(b"hello")

    def record(*fields, block=body):
        return b"\r\n".join([b"WARC/1.0", *fields, b"Content-Length: %d" % len(block), b"", block]) + b"\r\n\r\n"

    kind, name = b"WARC-Type: response", b"WARC-Record-ID: <urn:uuid:1>"
    got = _read(
        spark,
        tmp_path / "fields",
        record(kind, name, b"WARC-Payload-Digest: sha1:" + sha.hexdigest().upper().encode())
        + record(kind, name, b"WARC-Payload-Digest: sha256:abc")
        + record(kind, name, b"WARC-Payload-Digest: sha1:!!")
        + record(kind, name, b"WARC-Payload-Digest: sha1:" + b"0" * 40)
        + record(kind)
        + record(b"WARC-Type: warcinfo", name, block=b"software: x\r\n\r\ny")
        + record(kind, b"WARC-Segment-Number: 1")
        + record(kind, name, b"WARC-Segment-Number: one")
        + record(b"WARC-Type: revisit", name, block=b"HTTP/1.1 200 OK\r\ncontent-length: zz\r\n\r\n"),
    )
    assert sorted((r.record_type or "", r.record_id or "", r.complete, bytes(r.payload or b"")) for r in got) == sorted(
        [
            *[("response", "urn:uuid:1", True, b"hello")] * 3,
            ("response", "urn:uuid:1", False, b""),
            ("response", "", True, b"hello"),
            ("warcinfo", "urn:uuid:1", True, b"software: x\r\n\r\ny"),
            ("response", "", False, b""),
            ("", "urn:uuid:1", False, b""),
            ("revisit", "urn:uuid:1", True, b""),
        ]
    )


def test_long_records_are_joined_in_linear_time(spark, tmp_path):
    def seconds(size):
        page = _page(1, b"0123456789abcdef" * (size // 16))
        records = [r + b"\r\n\r\n" for r in warc.page_records(page)]
        begun = time.perf_counter()
        (got,) = _read(spark, tmp_path / str(size), gzip.compress(b"".join(records), 1))
        assert got.complete and bytes(got.payload) == page["payload"]
        return time.perf_counter() - begun

    seconds(1 << 16)
    small, large = seconds(5 << 20), seconds(20 << 20)
    assert large < 8 * max(small, 1.0)
