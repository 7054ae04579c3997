"""WARC archives of pages, and captures assembled from their transactions.

``write_archives`` writes request, response (or revisit) and metadata records
as gzipped WARC 1.1 files through Spark's text writer, whose line separator is
the record terminator.  ``read_records`` parses archives record by record in
bounded memory.  ``captures`` joins the three kinds of records through their
concurrent-to identifiers, resolves revisits through the record they refer to,
and gives one nested row per capture.
"""

from __future__ import annotations

import hashlib
import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickforge.session import shared_path

from .common import ship

#: Payloads below this many bytes are always written in full.
LEAST_REVISIT = 100
PAGES_PER_FILE = 20_000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SEPARATOR = "\r\n\r\n"


def _uuid(*parts):
    """A urn:uuid made from the parts' digest; nulls read as empty."""
    h = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    return F.concat(F.lit("urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-"), F.substring(h, 13, 4),
                    F.lit("-"), F.substring(h, 17, 4), F.lit("-"), F.substring(h, 21, 12))


def _header(name: str, value):
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise("")


def write_archives(pages: DataFrame, path: str, least: int = LEAST_REVISIT) -> None:
    """Write three records per row of (page_id, url, html) under ``path``.

    Of rows with equal payloads of at least ``least`` bytes, the smallest
    page_id is a response and the others revisit it.  Null html is an empty
    payload, a null url has no target, a null page_id no page-id field; such a
    row is a revisit only if a row with an id has its payload.  Rows repeated
    with the same id and payload are written as often as they come.
    """
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.regexp_replace(F.col("url").cast("string"), "[\\r\\n]", "%0A").alias("url"),
                     F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    p = p.withColumns({"n": F.octet_length("html"), "digest": F.sha2("html", 256)})
    shared = (p.where(F.col("n") >= least).groupBy(F.col("digest").alias("d")).agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
              .where("copies > 1 and first_id is not null").select("d", "first_id"))
    p = p.join(shared, p["digest"] == shared["d"], "left")
    revisit = F.col("first_id").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") != F.col("first_id")))
    p = p.withColumns({"revisit": revisit, "id": _uuid(F.lit("capture"), F.col("page_id"), F.col("digest")),
                       "first": _uuid(F.lit("capture"), F.col("first_id"), F.col("digest"))})

    def record(kind, record_id, extra, content_type: str, block):
        return F.concat(F.lit("WARC/1.1\r\nWARC-Type: "), kind, F.lit("\r\nWARC-Record-ID: <"), record_id, F.lit(f">\r\nWARC-Date: {DATE}\r\n"),
                        _header("WARC-Target-URI", F.col("url")), extra, F.lit(f"Content-Type: {content_type}\r\nContent-Length: "),
                        F.octet_length(block).cast("string"), F.lit(SEPARATOR), block)

    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n").cast("string"), F.lit(SEPARATOR))
    digest = F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest"), F.lit("\r\n"))
    response = record(F.lit("response"), F.col("id"), digest, "application/http;msgtype=response", F.concat(http, F.col("html")))
    again = record(F.lit("revisit"), F.col("id"), F.concat(digest, F.lit("WARC-Refers-To: <"), F.col("first"), F.lit(f">\r\nWARC-Profile: {PROFILE}\r\n")),
                   "application/http;msgtype=response", http)
    concurrent = F.concat(F.lit("WARC-Concurrent-To: <"), F.col("id"), F.lit(">\r\n"))
    target = F.coalesce(F.regexp_extract("url", r"^[a-z]+://[^/?#]*([^#]*)", 1), F.lit(""))
    host = F.coalesce(F.regexp_extract("url", r"^[a-z]+://([^/?#]*)", 1), F.lit(""))
    request = record(F.lit("request"), _uuid(F.lit("request"), F.col("id")), concurrent, "application/http;msgtype=request",
                     F.concat(F.lit("GET "), F.when(target == "", "/").otherwise(target), F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(SEPARATOR)))
    metadata = record(F.lit("metadata"), _uuid(F.lit("metadata"), F.col("id")), concurrent, "application/warc-fields",
                      F.concat(_header("page-id", F.col("page_id").cast("string")), F.lit("via: crawl\r\n")))
    text = F.concat_ws(SEPARATOR, request, F.when(F.col("revisit"), again).otherwise(response), metadata)
    (p.select(text.alias("value")).write.option("lineSep", SEPARATOR).option("compression", "gzip")
     .option("maxRecordsPerFile", PAGES_PER_FILE).text(path))


RECORD = ("record_id string, type string, url string, date string, concurrent_to string, refers_to string, declared string, "
          "status int, request string, page_id long, payload_bytes long, payload_digest string, payload binary")


class _Reader:
    """Bytes of a gzipped archive (any number of members), decompressed in pieces."""

    PIECE = 1 << 20

    def __init__(self, raw: bytes):
        self.raw, self.at, self.buf, self.pos = memoryview(raw), 0, b"", 0
        self.zip = zlib.decompressobj(31) if raw[:2] == b"\x1f\x8b" else None

    def more(self) -> bool:
        if self.at >= len(self.raw):
            return False
        piece = bytes(self.raw[self.at:self.at + self.PIECE])
        self.at += len(piece)
        out = piece
        if self.zip is not None:
            out = self.zip.decompress(piece)
            while self.zip.eof and self.zip.unused_data:
                rest = self.zip.unused_data
                self.zip = zlib.decompressobj(31)
                out += self.zip.decompress(rest)
            if self.zip.eof:
                self.zip = zlib.decompressobj(31)
        self.buf, self.pos = self.buf[self.pos:] + out, 0
        return True

    def until(self, mark: bytes) -> bytes | None:
        while (i := self.buf.find(mark, self.pos)) < 0:
            if not self.more():
                return None
        out, self.pos = self.buf[self.pos:i], i + len(mark)
        return out

    def take(self, n: int) -> bytes:
        while len(self.buf) - self.pos < n and self.more():
            pass
        if len(self.buf) - self.pos < n:
            raise ValueError("the archive ends inside a record")
        out, self.pos = self.buf[self.pos:self.pos + n], self.pos + n
        return out


def parse(raw: bytes):
    """(headers, block) of each record of an archive."""
    r = _Reader(raw)
    while (head := r.until(b"\r\n\r\n")) is not None:
        lines = head.decode("utf-8").lstrip("\r\n").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:60]!r}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        yield headers, r.take(int(headers["content-length"]))
        if r.take(4) != b"\r\n\r\n":
            raise ValueError("a record is not ended by two line ends")


def _row(headers: dict, block: bytes, with_payload: bool):
    strip = lambda v: v.strip("<>") if v else None
    kind = headers["warc-type"]
    head, _, payload = block.partition(b"\r\n\r\n")
    status = int(head.split(b" ", 2)[1]) if kind in ("response", "revisit") else None
    page, n, digest = None, None, None
    if kind == "metadata":
        fields = dict(x.split(": ", 1) for x in block.decode().split("\r\n") if ": " in x)
        page = int(fields["page-id"]) if "page-id" in fields else None
    if kind == "response":
        n, digest = len(payload), hashlib.sha256(payload).hexdigest()
        if (said := headers.get("warc-payload-digest")) and said != "sha256:" + digest:
            raise ValueError(f"the payload of {headers['warc-record-id']} does not have its digest")
    return (strip(headers["warc-record-id"]), kind, headers.get("warc-target-uri"), headers.get("warc-date"), strip(headers.get("warc-concurrent-to")),
            strip(headers.get("warc-refers-to")), headers.get("warc-payload-digest", "").removeprefix("sha256:") or None, status,
            head.split(b"\r\n", 1)[0].decode() if kind == "request" else None, page, n, digest, payload if with_payload and kind == "response" else None)


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives under ``path``; payloads are checked
    against their digests.  A damaged archive raises."""
    names = [c.split()[0] for c in RECORD.split(", ")]

    def scan(frames):
        for pdf in frames:
            for raw in pdf["content"]:
                rows, size = [], 0
                for headers, block in parse(raw):
                    rows.append(_row(headers, block, with_payload))
                    size += len(block) if with_payload else 100
                    if size > 4_000_000:
                        yield _frame(rows, names)
                        rows, size = [], 0
                yield _frame(rows, names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return ship(files).mapInPandas(scan, RECORD)


def _frame(rows: list, names: list[str]) -> pd.DataFrame:
    pdf = pd.DataFrame(rows, columns=names)
    for c, kind in (("status", "Int32"), ("page_id", "Int64"), ("payload_bytes", "Int64")):
        pdf[c] = pdf[c].astype(kind)
    return pdf


def captures(records: DataFrame) -> DataFrame:
    """One row per response or revisit record: page_id, record_id, record_type,
    refers_to (page_id of the response that a revisit refers to), and structs
    request, response, metadata.

    Requests and metadata come by their concurrent-to identifier (one each per
    capture; none gives a null struct).  Payload, size and digest of a revisit
    are those of the response it refers to.
    """
    def side(kind: str, *columns):
        found = records.where(F.col("type") == kind).groupBy(F.col("concurrent_to").alias(f"{kind}_of"))
        return found.agg(F.first(F.struct(*columns)).alias(kind))

    main = records.where(F.col("type").isin("response", "revisit")).drop("request", "page_id", "concurrent_to")
    request = side("request", "record_id", F.col("request").alias("line"))
    metadata = side("metadata", "record_id", "page_id")
    full = main.join(metadata, F.col("record_id") == F.col("metadata_of"), "left").join(request, F.col("record_id") == F.col("request_of"), "left")
    # repeated rows of one page have one record id: any of them stands for it
    target = (full.where("type = 'response'").groupBy(F.col("record_id").alias("t_id"))
              .agg(F.first(F.struct("payload_bytes", "payload_digest", "payload", F.col("metadata.page_id").alias("page_id"))).alias("t")))
    known = target.join(full.where("type = 'revisit'").select(F.col("refers_to").alias("t_id")).distinct(), "t_id", "left_semi")
    out = full.join(known, F.col("refers_to") == F.col("t_id"), "left")
    own = lambda c: F.when(F.col("type") == "response", F.col(c)).otherwise(F.col(f"t.{c}")).alias(c)
    return out.select(F.col("metadata.page_id").alias("page_id"), "record_id", F.col("type").alias("record_type"), F.col("t.page_id").alias("refers_to"),
                      "request", F.struct("url", "date", "status", own("payload_bytes"), own("payload_digest"), own("payload")).alias("response"), "metadata")


def roundtrip(pages: DataFrame, with_payload: bool = True) -> DataFrame:
    """Write the pages as archives into the shared folder and assemble the
    captures from what is read back."""
    spark = ship(pages).sparkSession
    path = shared_path(spark, "warc")
    write_archives(pages, path)
    return captures(read_records(spark, path, with_payload))
