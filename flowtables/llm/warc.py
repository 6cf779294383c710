"""WARC archives with revisit resolution.

1. Every page becomes a header ``(payload digest, payload bytes, page id, url)``;
   the payload itself stays where it is.
2. The headers are shuffled by payload digest.  A partial aggregate leaves the
   smallest page id per digest (the original response), and only digests that
   occur more than once are kept.
3. Pages are joined to those originals by digest: a page that is not the
   original becomes a revisit record without payload, all others a response.
4. The archives are written anew, every record with fresh headers.

The archives are gzipped WARC/1.1 files written by Spark's own text writer
(a record ends with two line breaks, which is the writer's line separator),
so they go to any file system Spark knows, with task commit and retries.

Defined cases: a null payload is an empty one; a null or empty url is written
as ``urn:page:<id>``; control characters in a url are percent-encoded; pages
with a null id are responses unless another page with the same payload has an
id, and then revisits of it; rows that repeat the smallest id of a payload
are all responses; an empty table gives no archive and no row.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from .common import arrow_map, cut_lineage, read_table, scratch_path

CRLF = "\r\n"
RECORD_END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_SCHEMA = (
    "page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, "
    "target_uri string, record_id string, block_bytes long, payload_ok boolean"
)
#: Base32 letters of RFC 4648.  Fixed values.
B32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def resolve_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``(page_id, url, payload, payload_bytes, payload_digest, refers_to,
    refers_to_uri)`` per page of ``(page_id, url, html)``; ``refers_to`` is null for responses.

    Payloads below ``min_bytes`` are always responses.
    """
    headers = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        _uri(F.col("url"), F.col("page_id")).alias("uri"),
        F.coalesce("html", F.lit("")).alias("payload"),
    ).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    headers = headers.withColumn("sha", F.unhex(F.sha1(F.col("payload").cast("binary"))))
    originals = (
        headers.filter(F.col("payload_bytes") >= min_bytes)
        .groupBy("sha")
        .agg(F.min(F.struct(F.col("page_id").isNull().alias("no"), "page_id", "uri")).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") > 1) & F.col("first.page_id").isNotNull())
        .select(F.col("sha").alias("o_sha"), F.col("first.page_id").alias("o_id"), F.col("first.uri").alias("o_uri"))
    )
    # Stored, so that the join below reads both sides straight from scans and
    # a digest that holds a third of the pages can be split over tasks.
    originals = cut_lineage(originals, "warc-originals")
    is_revisit = F.col("o_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("o_id"))
    return (
        headers.join(originals, F.col("sha") == F.col("o_sha"), "left")
        .select(
            "page_id",
            "uri",
            F.when(~is_revisit, F.col("payload")).otherwise(F.lit("")).alias("payload"),
            "payload_bytes",
            payload_digest_of(F.col("sha")).alias("payload_digest"),
            F.when(is_revisit, F.col("o_id")).alias("refers_to"),
            F.when(is_revisit, F.col("o_uri")).alias("refers_to_uri"),
        )
    )


def payload_digest_of(sha: Column) -> Column:
    """Base32 of a 20-byte SHA-1 column."""
    hexed = F.lower(F.hex(sha))
    out = []
    for i in range(8):
        bits = F.conv(F.substring(hexed, i * 5 + 1, 5), 16, 10).cast("int")
        out += [F.substring(F.lit(B32), F.shiftright(bits, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def _uri(url: Column, page_id: Column) -> Column:
    unnamed = F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")))
    clean = F.regexp_replace(url, "[\\x00-\\x20\\x7F]", "%20")
    return F.when(url.isNull() | (url == ""), unnamed).otherwise(clean)


def _record(date: str) -> Column:
    revisit = F.col("refers_to").isNotNull()
    key = F.md5(F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("")), "uri", "payload_digest").cast("binary"))
    uuid = F.concat_ws("-", *[F.substring(key, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(CRLF * 2),
    )
    block_bytes = (F.octet_length("http") + F.octet_length("payload")).cast("string")

    def line(name, value):
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    def maybe(name, value):
        return F.coalesce(line(name, value), F.lit(""))

    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), uuid, F.lit(">"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.col("uri")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        maybe("WARC-Refers-To-Target-URI", F.col("refers_to_uri")),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}{CRLF}")).otherwise(F.lit("")),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}"),
        maybe("X-Page-Id", F.col("page_id").cast("string")),
        maybe("X-Refers-To-Page-Id", F.col("refers_to").cast("string")),
        line("Content-Length", block_bytes),
        F.lit(CRLF),
    )
    return http, F.concat(head, F.col("http"), F.col("payload"))


def write_archives(resolved: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", records_per_file: int = 10000) -> None:
    """Write the resolved pages as gzipped WARC files below ``path``."""
    http, record = _record(date)
    (
        resolved.withColumn("http", http)
        .select(record.alias("value"))
        .write.mode("overwrite")
        .option("lineSep", CRLF * 2)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


class _Inflater:
    """Bytes of a gzip file (one or several members), on demand."""

    def __init__(self, raw: bytes) -> None:
        self.raw, self.at, self.buf = raw, 0, bytearray()
        self.z = zlib.decompressobj(31)

    def fill(self, need: int) -> bool:
        while len(self.buf) < need:
            if self.z.eof:
                rest = self.z.unused_data + self.raw[self.at :]
                if not rest:
                    return False
                self.raw, self.at, self.z = rest, 0, zlib.decompressobj(31)
            if self.at >= len(self.raw):
                return False
            self.buf += self.z.decompress(self.raw[self.at : self.at + (1 << 16)])
            self.at += 1 << 16
        return True

    def find(self, mark: bytes) -> int:
        seen = 0
        while (i := self.buf.find(mark, seen)) < 0:
            seen = max(0, len(self.buf) - len(mark))
            if not self.fill(len(self.buf) + 1):
                return -1
        return i

    def take(self, n: int) -> bytes:
        if not self.fill(n):
            raise ValueError("WARC file ends inside a record")
        out = bytes(self.buf[:n])
        del self.buf[:n]
        return out


def _records(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    f = _Inflater(raw)
    while (i := f.find(RECORD_END)) >= 0:
        head = f.take(i + 4).decode().split(CRLF)
        if not head[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {head[0][:40]!r}")
        fields = dict(x.split(": ", 1) for x in head[1:] if x)
        block = f.take(int(fields["Content-Length"]))
        if f.take(4) != RECORD_END:
            raise ValueError("WARC record without its end mark")
        yield fields, block


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in READ_SCHEMA.split(", ")]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_()]

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    rows = []
    for b in batches:
        for content in b.column(0):
            for h, block in _records(content.as_py()):
                cut = block.index(RECORD_END) + 4
                body = memoryview(block)[cut:]
                declared = int(re.search(rb"Content-Length: (\d+)", block[:cut])[1])
                digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                kind = h["WARC-Type"]
                ok = kind == "revisit" or (base64.b32encode(hashlib.sha1(body).digest()).decode() == digest and len(body) == declared)
                page, refers = h.get("X-Page-Id"), h.get("X-Refers-To-Page-Id")
                rows.append((page and int(page), kind, declared, digest, refers and int(refers), h["WARC-Target-URI"], h["WARC-Record-ID"], len(block), ok))
                if len(rows) >= 4096:
                    yield out(rows)
                    rows = []
    if rows:
        yield out(rows)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives below ``path``, parsed by their length fields.

    ``payload_ok`` says that a response's payload has its declared digest and length.
    """
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    except AnalysisException:
        files = spark.range(0).select(F.lit(None).cast("binary").alias("content"))
    return arrow_map(files, _parse, READ_SCHEMA)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archives(resolve_revisits(read_table(spark, sf_dir, "pages")), path)
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload_ok")


#: DuckDB has no SHA-1 of bytes in base32; sha1() gives hex, of which each 5 digits are four letters.
_LETTERS = " || ".join(
    f"substr('{B32}', ((('0x' || substr(sha1(coalesce(html, '')), {i * 5 + 1}, 5))::INT >> {s}) & 31) + 1, 1)"
    for i in range(8)
    for s in (15, 10, 5, 0)
)
ORACLE = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS sha, {_LETTERS} AS payload_digest FROM pages
), o AS (SELECT sha, min(page_id) AS first FROM p GROUP BY sha)
SELECT page_id, octet_length(encode(payload)) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to,
       true AS payload_ok
FROM p JOIN o USING (sha)
"""
