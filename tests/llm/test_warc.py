"""WARC: exact round trips, records by hand, broken archives."""

import base64
import gzip
import hashlib
import uuid

import pytest
from pyspark.sql import functions as F

from sharedsignal.llm import warc


def brute(rows):
    """(id, bytes, digest, type, refers_to) per row: the first of equal payloads is the response."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, rows[k][1] is None, rows[k][1] or "", k))
    first, out = {}, []
    for k in order:
        page, _, html = rows[k]
        raw = (html or "").encode()
        d = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        seen = raw in first
        out.append((page, len(raw), d, "revisit" if seen else "response", first[raw] if seen else None))
        first.setdefault(raw, page)
    return out


def key(row):
    return [(x is None, x if x is not None else 0) for x in row]


def trip(spark, tmp_path, rows, **options):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id bigint, url string, html string, digest string, n int")
    path = f"{tmp_path}/{uuid.uuid4().hex}"
    found = warc.round_trip(frame, path, **options).collect()
    assert all(r.problem is None for r in found)
    return path, found


LONG = "é日本" * 4000 + "WARC/1.1\r\nWARC-Type: response\r\n\r\n" + "WARC/1.1" * 30
ROWS = [(3, "http://a/WARC/1.1", LONG), (1, "http://b/ x\r\ny", LONG), (2, None, ""), (4, "", None), (None, "u", "<p>"), (9, "u", "<p>"),
        (7, "same", "<b>copy</b>"), (7, "same", "<b>copy</b>"), (7, "same", "<b>copy</b>"), (8, "same", "<b>copy</b>"), (8, "same", "<b>copy</b>"),
        (5, "x", "a\r\nb\nc\r"), (6, "y", "a\x00b"), (10, "z", "\r\n\r\n"), (11, "z", "WARC/1.1\r\n")]


@pytest.mark.parametrize("segment,chunk,compression", [(8192, 4096, "gzip"), (101, 7, "none"), (64, 1000, "gzip")])
def test_round_trip_equals_brute_force(spark, tmp_path, segment, chunk, compression):
    path, found = trip(spark, tmp_path, ROWS, segment=segment, chunk=chunk, compression=compression)
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    assert sorted(got, key=key) == sorted(brute(ROWS), key=key)
    payloads = {r.page_id: bytes(r.payload) for r in warc.read_archives(spark, path).filter("record_type = 'response'").collect()}
    assert payloads["1"] == LONG.encode() and payloads["5"] == b"a\r\nb\nc\r" and payloads["2"] == b""
    ids = [r.record_id for r in warc.read_records(spark, path).select("record_id").collect()]
    assert len(ids) == len(set(ids))


def test_small_payloads_are_never_revisits(spark, tmp_path):
    _, found = trip(spark, tmp_path, ROWS, least=4)
    assert sorted(r.page_id for r in found if r.record_type == "revisit") == [3, 7, 7, 8, 8]


def test_empty_table(spark, tmp_path):
    assert trip(spark, tmp_path, [])[1] == []


def test_base32_of_sha1(spark):
    texts = ["", "a", "é" * 100] + [str(k) * k for k in range(40)]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(warc.base32_sha1(F.col("t").cast("binary")).alias("d")).collect()
    assert [r.d for r in found] == [warc.digest(t.encode()) for t in texts]


def test_chunks():
    for text in (b"", b"x" * 10, b"aWARC/1.1\r\nbWARC/1.1", b"\r\n0\r\n\r\n"):
        for most in (1, 3, 4096):
            framed = warc.chunked(text, most)
            assert warc.VERSION + warc.LINE not in framed
            assert warc.unchunked(framed) == text
    assert warc.unchunked(b"3;name=x\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    for broken in (b"", b"zz\r\n", b"5\r\nabc\r\n0\r\n\r\n", b"3\r\nabc\r\n", b"0\r\n", b"-1\r\n\r\n"):
        with pytest.raises(ValueError):
            warc.unchunked(broken)


def archive(spark, tmp_path, records):
    path = f"{tmp_path}/{uuid.uuid4().hex}.warc.gz"
    with gzip.open(path, "wb") as f:
        f.write(b"".join(records))
    return {r.record_id: r for r in warc.read_archives(spark, path).collect()}


def part(record_id, origin, number, block, total=None, extra=()):
    kind = [("WARC-Type", "response")] if number == 1 else [("WARC-Type", "continuation"), ("WARC-Segment-Origin-ID", origin)]
    return warc.record_bytes([*kind, ("WARC-Record-ID", record_id), ("WARC-Segment-Number", str(number)), *extra]
                             + [("WARC-Segment-Total-Length", str(total))] * (total is not None), block)


def test_segments_in_any_order_and_broken_ones(spark, tmp_path):
    block = warc.HTTP + warc.chunked(b"0123456789" * 50, 64)
    cut = [block[k:k + 200] for k in range(0, len(block), 200)]
    n = len(cut)
    records = [part(f"<a{k}>", "<a1>", k, cut[k - 1], len(block) if k == n else None) for k in range(n, 0, -1)]
    records.append(records[0])  # a segment stored twice
    records += [part("<b1>", None, 1, cut[0]), part("<b3>", "<b1>", 3, cut[2], len(block))]  # a missing segment
    records += [part("<c1>", None, 1, cut[0]), part("<c2>", "<c1>", 2, cut[1], 7)]  # a wrong total
    records += [part("<d2>", "<d1>", 2, cut[1], 9)]  # no origin
    records += [part("<e1>", None, 1, cut[0]), part("<e2>", "<e1>", 2, cut[1])]  # no total
    records += [warc.record_bytes([("warc-type", "response"), ("WARC-Record-ID", "<f>")], b"HTTP/1.1 200 OK\r\n\r\nplain")]
    records += [warc.record_bytes([("WARC-Type", "response"), ("WARC-Record-ID", "<g>")], warc.HTTP + b"5\r\nab")]
    records += [warc.record_bytes([("WARC-Type", "response"), ("WARC-Record-ID", "<h>"), ("WARC-Payload-Digest", "sha1:AAAA")], warc.HTTP + b"0\r\n\r\n")]
    records += [warc.record_bytes([("WARC-Type", "response"), ("WARC-Record-ID", "<i>")], b"x").replace(b"Content-Length: 1", b"Content-Length: 9")]
    records += [warc.record_bytes([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<j>"), ("WARC-Block-Digest", "sha1:B")], b"k: v")]
    found = archive(spark, tmp_path, records)
    assert bytes(found["<a1>"].payload) == b"0123456789" * 50 and found["<a1>"].segments == n and found["<a1>"].problem is None
    assert {k: r.problem for k, r in found.items() if k != "<a1>"} == {
        "<b1>": "missing segment", "<c1>": "total length", "<d1>": "no origin", "<e1>": "missing segment", "<f>": None, "<g>": "chunk end",
        "<h>": "payload digest", "<i>": "wrong length", "<j>": "block digest"}
    assert bytes(found["<f>"].payload) == b"plain"
