"""WARC archives: write captures as segmented records, read them back and reassemble them.

*Writing.*  Each capture's payload is a chunked HTTP response.  A block of more than
``segment`` bytes is cut: the first segment keeps the record's type, the others are
``continuation`` records with the first one's id (WARC-Segment-Origin-ID) and a number,
the last also with the total length.  Equal payloads of ``least`` bytes or more are stored
once; later captures are ``revisit`` records that refer to that response.  Records go
through Spark's text writer to the target folder (one file per task, gzip), so archives
can be in any store that Spark writes.

*Reading.*  Spark's text reader splits archives at the version line.  The writer never
lets that line occur inside a block: where a payload holds it, a chunk ends in its middle.
Whole records are decoded in their task; segments are grouped by origin id, put in order
of their numbers, checked (each number once from 1 on, total length, digests) and then
decoded from their chunks.  What fails a check keeps its row, with the problem named.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ensure_scratch, pick, scratch, table

VERSION = b"WARC/1.1"
LINE = b"\r\n"
#: Bytes of a segment's block and of a chunk of the payload.
SEGMENT, CHUNK = 8192, 4096
#: Payloads from this size on are stored once.
LEAST = 0
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# --- digests and chunks ------------------------------------------------------------

def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: every five hex digits are four digits of base 32."""
    hexes = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexes, k, 5), 16, 32), 4, "0") for k in range(1, 41, 5)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def chunked(payload: bytes, most: int = CHUNK) -> bytes:
    """Chunked transfer framing; no chunk holds the version line, and none is over ``most`` bytes."""
    cuts = sorted({*range(0, len(payload), most), *(m.start() + 4 for m in re.finditer(re.escape(VERSION), payload)), len(payload)})
    parts = [payload[a:z] for a, z in zip(cuts, cuts[1:])]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body (extensions and trailers are passed over); ValueError if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(LINE, at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]+", size):
            raise ValueError("chunk size")
        n, at = int(size, 16), end + 2
        if n == 0:
            break
        if len(body) < at + n + 2 or body[at + n:at + n + 2] != LINE:
            raise ValueError("chunk end")
        out.append(body[at:at + n])
        at += n + 2
    while True:  # trailers end with an empty line
        end = body.find(LINE, at)
        if end < 0:
            raise ValueError("trailer")
        if end == at:
            return b"".join(out)
        at = end + 2


# --- records --------------------------------------------------------------------------

def header_value(text: str) -> str:
    """A field's value: white space and control characters, which no URI holds, are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record_bytes(fields: list[tuple[str, str]], block: bytes) -> bytes:
    # a value that ends in the version line is kept apart from the line's end by a space
    head = "".join(f"{k}: {v}{' ' if v.endswith(VERSION.decode()) else ''}\r\n" for k, v in fields)
    return VERSION + LINE + head.encode() + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"


def record_id(*parts) -> str:
    """An id that depends on nothing but the capture, so a repeated task writes the same one."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(repr(parts).encode()).digest())}>"


def capture_records(page_id, url, payload: bytes, payload_digest: str, copy: int, refers: tuple | None, segment: int, chunk: int) -> list[bytes]:
    """The records of one capture: a revisit, a response, or a response's segments."""
    own = record_id(page_id, url, payload_digest, copy)
    fields = [("WARC-Record-ID", own), ("WARC-Payload-Digest", f"sha1:{payload_digest}"), ("Content-Type", "application/http; msgtype=response")]
    fields += [("WARC-Target-URI", header_value(url))] if url is not None else []
    fields += [("X-Page-ID", str(page_id))] if page_id is not None else []
    if refers:
        fields = [("WARC-Type", "revisit"), ("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(*refers)), *fields]
        return [record_bytes(fields, HTTP)]
    block = HTTP + chunked(payload, chunk)
    if len(block) <= segment:
        return [record_bytes([("WARC-Type", "response"), ("WARC-Block-Digest", f"sha1:{digest(block)}"), *fields], block)]
    parts = [block[k:k + segment] for k in range(0, len(block), segment)]
    out = [record_bytes([("WARC-Type", "response"), ("WARC-Segment-Number", "1"), ("WARC-Block-Digest", f"sha1:{digest(parts[0])}"), *fields], parts[0])]
    for number, part in enumerate(parts[1:], 2):
        fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", record_id(own, number)), ("WARC-Segment-Origin-ID", own),
                  ("WARC-Segment-Number", str(number)), ("WARC-Block-Digest", f"sha1:{digest(part)}")]
        out.append(record_bytes(fields + [("WARC-Segment-Total-Length", str(len(block)))] * (number == len(parts)), part))
    return out


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST,
                   segment: int = SEGMENT, chunk: int = CHUNK, compression: str = "gzip", records_per_file: int = 200_000) -> None:
    """Write one capture per row of ``pages`` to the folder ``path``.

    Null html is an empty payload.  Of equal payloads of ``least`` bytes or more the row
    with the smallest id is the response (null ids last, then the smallest url, null
    last); rows equal in id, url and html are captures of their own, the first of them
    the response.  Other columns are passed over.  An empty table writes no record.
    """
    rows = pick(pages, id=id_col, url=url_col, html=html_col).withColumn("raw", F.coalesce("html", F.lit("")).cast("binary")).drop("html")
    rows = rows.select("id", "url", "raw", base32_sha1(F.col("raw")).alias("digest"))
    # copies of a payload: counted by (digest, id, url) with a partial count per task, then by digest
    exact = rows.filter(F.octet_length("raw") >= least).groupBy("digest", "id", "url").agg(F.count("*").alias("n"))
    place = F.struct(F.isnull("id").alias("no_id"), "id", F.isnull("url").alias("no_url"), "url")
    groups = scratch(exact.groupBy("digest").agg(F.sum("n").alias("all"), F.min(F.struct(place.alias("place"), "n")).alias("one"))
                     .filter("all > 1").select("digest", F.col("one.place.id").alias("first_id"), F.col("one.place.url").alias("first_url"),
                                               F.col("one.n").alias("n")), "payloads")
    joined = rows.join(groups, "digest", "left")
    first = F.col("id").eqNullSafe(F.col("first_id")) & F.col("url").eqNullSafe(F.col("first_url"))
    is_first = F.coalesce(F.col("n").isNotNull() & first, F.lit(False))
    kind = F.when(F.col("n").isNull() | is_first, "response").otherwise("revisit")
    columns = ["id", "url", "raw", "digest", "kind", "copy", "first_id", "first_url"]
    # rows that are equal to a response and to each other are taken once and counted
    alone = joined.filter(~(is_first & (F.coalesce("n", F.lit(1)) > 1))).withColumn("kind", kind)
    # other rows that agree in id and url with one another need ids of their own too
    alone = alone.withColumn("copy", F.when(F.col("kind") == "response", F.lit(0).cast("bigint")).otherwise(F.monotonically_increasing_id() + 1))
    captures = alone.select(*columns)
    if not groups.filter("n > 1").isEmpty():
        same = (joined.filter(is_first & (F.col("n") > 1)).dropDuplicates(["digest", "id", "url"])
                .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)))
                .withColumn("kind", F.when(F.col("copy") == 0, "response").otherwise("revisit")))
        captures = captures.union(same.select(*columns))

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                page_id, url, payload, payload_digest, what, copy, first_id, first_url = (c[r].as_py() for c in b.columns)
                refers = (first_id, first_url, payload_digest, 0) if what == "revisit" else None
                records = capture_records(page_id, url, payload, payload_digest, copy, refers, segment, chunk)
                # the writer ends every row with the record's last byte, a line feed
                yield pa.RecordBatch.from_arrays([pa.array([x[:-1] for x in records], pa.binary())], names=["value"])

    (captures.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("lineSep", "\n").option("compression", compression).option("maxRecordsPerFile", records_per_file).text(path))


# --- reading --------------------------------------------------------------------------

FIELDS = {"WARC-Record-ID": "record_id", "WARC-Type": "record_type", "X-Page-ID": "page_id", "WARC-Target-URI": "url",
          "WARC-Payload-Digest": "payload_digest", "WARC-Refers-To": "refers_to_id", "WARC-Segment-Origin-ID": "origin_id",
          "WARC-Segment-Number": "number", "WARC-Segment-Total-Length": "total"}


def parse_record(raw: bytes) -> dict:
    """Fields, block and problem of one record without its version line; field names in any case, folded lines joined."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = re.sub(rb"\r\n[ \t]+", b" ", head).decode("utf-8", "replace").split("\r\n")
    found = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    out = {c: found.get(f.lower()) for f, c in FIELDS.items()} | {"problem": None, "block": b""}
    length = found.get("content-length", "")
    if not gap or not re.fullmatch("[0-9]{1,18}", length):
        return out | {"problem": "no length"}
    n = int(length)
    block, end = rest[:n], rest[n:]
    stated = found.get("warc-block-digest")
    if len(block) < n or end != b"\r\n\r\n":
        out["problem"] = "wrong length"
    elif stated and stated.lower().startswith("sha1:") and stated[5:] != digest(block):
        out["problem"] = "block digest"
    for c in ("number", "total"):
        if out[c] is not None:
            out[c] = int(out[c]) if re.fullmatch("[0-9]{1,18}", out[c]) else -1
    return out | {"block": block}


RECORD = ("record_id string, record_type string, page_id string, url string, payload_digest string, refers_to_id string, "
          "origin_id string, number bigint, total bigint, problem string, block binary")
NAMES = [x.split()[0] for x in RECORD.split(", ")]


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives below ``path``, blocks as stored."""
    lines = (spark.read.option("lineSep", (VERSION + LINE).decode()).text(path)
             .filter(F.octet_length("value") > 0).select(F.col("value").cast("binary").alias("value")))
    schema = pa.schema([(c, {"number": pa.int64(), "total": pa.int64(), "block": pa.binary()}.get(c, pa.string())) for c in NAMES])

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_pylist([parse_record(raw.as_py()) for raw in b.column(0)], schema=schema)

    return lines.mapInArrow(run, RECORD)


def reassemble(records: DataFrame) -> DataFrame:
    """One row per record, continuations joined to their origin: ``block`` is the whole block.

    Only segments are shuffled, by origin id; a group is the segments of one record.  A
    segment that occurs twice with equal bytes counts once.  Origins without all their
    segments, or with another total length than stated, get a problem; continuations
    without an origin give a row of type ``continuation`` with the problem "no origin".
    """
    whole = records.filter("number is null and record_type <=> 'continuation' = false")
    parts = records.filter("not (number is null and record_type <=> 'continuation' = false)")
    head = [c for c in NAMES if c not in ("origin_id", "number", "total", "problem", "block")]
    is_origin = F.col("number").eqNullSafe(1) & ~F.col("record_type").eqNullSafe("continuation")
    grouped = (parts.withColumn("origin", F.when(is_origin, F.col("record_id")).otherwise(F.coalesce("origin_id", "record_id")))
               .groupBy("origin").agg(
                   *[F.max(F.when(is_origin, F.col(c))).alias(c) for c in head], F.max(is_origin.cast("int")).alias("has_origin"),
                   F.sort_array(F.collect_set(F.struct("number", "block"))).alias("segments"),
                   F.max("total").alias("total"), F.min("problem").alias("problem"), F.max("number").alias("last"),
                   F.min(F.coalesce("number", F.lit(-1))).alias("first")))
    blocks = F.transform("segments", lambda s: s["block"])
    size = F.aggregate(blocks, F.lit(0).cast("bigint"), lambda n, x: n + F.octet_length(x))
    problem = (F.when(F.col("has_origin") == 0, "no origin")
               .when((F.col("first") != 1) | (F.col("last") != F.size("segments")) | F.col("total").isNull(), "missing segment")
               .when(F.col("total") != size, "total length").otherwise(F.col("problem")))
    joined = grouped.select(F.col("origin").alias("record_id"), F.coalesce("record_type", F.lit("continuation")).alias("record_type"),
                            *[c for c in head if c not in ("record_id", "record_type")], F.size("segments").alias("segments"),
                            problem.alias("problem"), F.expr("aggregate(transform(segments, s -> s.block), cast('' as binary), (a, x) -> a || x)")
                            .alias("block"))
    return whole.select(*head, F.lit(1).alias("segments"), "problem", "block").union(joined.select(*head, "segments", "problem", "block"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, record_type, page_id, url, refers_to_id, payload_digest, segments, problem, payload): captures read back.

    Payloads are decoded from their chunks where the header says so and compared with the
    stated digest; a revisit's payload is null, as its record does not hold it.
    """
    names = ["record_id", "record_type", "page_id", "url", "refers_to_id", "payload_digest", "segments", "problem"]

    def run(batches):
        for b in batches:
            payloads, problems = [], []
            for what, stated, problem, block in zip(*(b.column(k).to_pylist() for k in (1, 5, 7, 8))):
                payload = None
                if what != "revisit" and not problem:
                    head, gap, body = block.partition(b"\r\n\r\n")
                    payload = body if gap else block
                    try:
                        if gap and re.search(rb"(?im)^transfer-encoding:[^\r\n]*chunked", head):
                            payload = unchunked(body)
                        if stated and stated.lower().startswith("sha1:") and stated[5:] != digest(payload):
                            problem = "payload digest"
                    except ValueError as e:
                        payload, problem = None, str(e)
                payloads.append(payload)
                problems.append(problem)
            yield pa.RecordBatch.from_arrays([*b.columns[:7], pa.array(problems, pa.string()), pa.array(payloads, pa.binary())], names=[*names, "payload"])

    return reassemble(read_records(spark, path)).select(*names, "block").mapInArrow(
        run, "record_id string, record_type string, page_id string, url string, refers_to_id string, payload_digest string, segments int, "
             "problem string, payload binary")


def round_trip(pages: DataFrame, path: str, **options) -> DataFrame:
    """Write ``pages`` to ``path``, read the archives back: one row per capture, revisits with their response's size."""
    write_archives(pages, path, **options)
    kind = pages.schema[options.get("id_col", "page_id")].dataType.simpleString()
    read = read_archives(pages.sparkSession, path)
    captures = scratch(read.select("record_id", "record_type", F.col("page_id").cast(kind).alias("page_id"), "url", "refers_to_id", "segments",
                                   "problem", F.octet_length("payload").cast("bigint").alias("bytes"),
                                   F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest")), "captures")
    origin = captures.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"), F.col("bytes").alias("origin_bytes"))
    return (captures.join(origin, "refers_to_id", "left")
            .select("page_id", "url", F.coalesce("bytes", "origin_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to",
                    "segments", "problem"))


def query(spark, sf_dir):
    """op11: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    ensure_scratch(spark)
    path = f"{spark.conf.get('spark.checkpoint.dir').rstrip('/')}/warc/{uuid.uuid4().hex[:12]}"
    return (round_trip(table(spark, sf_dir, "pages"), path)
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


#: The same rows from the pages alone.
SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h, first_value(page_id) OVER w AS first, row_number() OVER w AS k
  FROM pages WINDOW w AS (PARTITION BY coalesce(html, '') ORDER BY page_id NULLS LAST, url NULLS LAST))
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 160, 5), lambda b: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
         (CAST('0x' || substr(h || '00', CAST(1 + b // 4 AS INT), 3) AS INT) >> CAST(7 - b % 4 AS INT)) & 31 AS INT), 1)), '') AS payload_digest,
       CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN k > 1 THEN first END AS refers_to
FROM p
"""
