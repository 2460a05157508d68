"""WARC archives of pages, and captures put together from their records.

Each page becomes three records: the request, the response (or a revisit record that points to
an equal payload) and a metadata record. Request and metadata carry a concurrent-to identifier that names
the response. Archives are written by Spark's text sink, one record a row: the line separator is the two
line breaks that end a record, so a gzipped part file is a WARC file. They are read
back by content length with a streaming decoder, and ``captures`` joins the records again.

Records of equal payload: the page with the largest id is the response, the others revisit it.
Payloads shorter than ``least_bytes`` are always responses. A null html has an empty payload. Rows equal
in page, url and html are one capture. A null page id is kept (it counts as the
smallest), a null url becomes empty; line breaks in a url are percent-escaped. Only the three named
columns of the pages are read. A payload takes one task's memory; archives are read in pieces.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.session import shared_dir

END = "\r\n"
DATE = "2024-01-01T00:00:00Z"
DIGITS_32, BASE_32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in base 32: each five hex digits are four base-32 digits."""
    hexed = F.sha1(payload)
    fives = [F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*fives), DIGITS_32, BASE_32)


def urn(*parts: Column) -> Column:
    """A record identifier that depends on nothing but its parts."""
    h = F.md5(F.concat_ws("\n", *parts))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def with_roles(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Each page with payload, digest, record id and, if it revisits another page, that page and its record.

    Only digests are grouped; the payload moves once, and only if the revisits are too many to broadcast.
    """
    url = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A")
    payload = F.coalesce("html", F.lit(""))
    keyed = pages.select("page_id", url.alias("url"), payload.alias("payload")).withColumn(
        "digest", base32_sha1(F.col("payload").cast("binary"))
    )
    keyed = keyed.withColumn(
        "record_id", urn(F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.col("url"), F.col("digest"))
    )
    few = keyed.where(F.octet_length("payload") >= least_bytes).select("page_id", "digest", "url", "record_id")
    place = F.struct(F.col("page_id"), F.col("record_id"), F.col("url"))
    original = few.groupBy("digest").agg(F.max(place).alias("o"), F.min("record_id").alias("low"), F.max("record_id").alias("high"))
    shared = original.where("low <> high").select(
        "digest",
        F.col("o.page_id").alias("original_id"),
        F.col("o.record_id").alias("original_record"),
        F.col("o.url").alias("original_url"),
    )
    revisits = (
        few.join(shared, "digest")
        .where(~F.col("page_id").eqNullSafe(F.col("original_id")) | (F.col("record_id") != F.col("original_record")))
        .select("record_id", "original_id", "original_record", "original_url")
        .distinct()
    )
    return keyed.join(revisits, "record_id", "left")


def headers(kind: str, record: Column, url: Column, content: Column, mime: str, *more: tuple[str, Column]) -> Column:
    """One record: header, empty line, content. Fields whose value is null are left out."""
    fields = [F.lit(f"WARC/1.1{END}WARC-Type: {kind}")]
    fields += [F.concat(F.lit(f"{END}{name}: "), value) for name, value in (("WARC-Record-ID", record), ("WARC-Target-URI", url), *more)]
    fields += [F.lit(f"{END}WARC-Date: {DATE}{END}Content-Type: {mime}{END}Content-Length: "), F.octet_length(content).cast("string")]
    return F.concat_ws("", *fields, F.lit(END + END), content)


def records(roles: DataFrame) -> DataFrame:
    """The text of three records for each page."""
    url, record, first = F.col("url"), F.col("record_id"), F.col("original_record")
    host = F.regexp_extract("url", "^[a-zA-Z]+://([^/?#]*)", 1)
    path = F.regexp_extract("url", "^[a-zA-Z]+://[^/?#]*([^#]*)", 1)
    path = F.when(path == "", "/").otherwise(path)
    asked = F.concat(F.lit("GET "), path, F.lit(f" HTTP/1.1{END}Host: "), host, F.lit(END + END))
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
        F.octet_length("payload").cast("string"),
        F.lit(END + END),
    )
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    noted = F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(END),
                     F.lit("payload-bytes: "), F.octet_length("payload").cast("string"), F.lit(END),
                     F.coalesce(F.concat(F.lit("original-page-id: "), F.col("original_id").cast("string"), F.lit(END)), F.lit("")))
    http = "application/http; msgtype="
    response = headers("response", record, url, F.concat(head, F.col("payload")), http + "response", digest)
    revisit = headers(
        "revisit", record, url, head, http + "response", digest,
        ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        ("WARC-Refers-To", first), ("WARC-Refers-To-Target-URI", F.col("original_url")),
    )
    return roles.select(
        F.explode(
            F.array(
                headers("request", urn(record, F.lit("request")), url, asked, http + "request", ("WARC-Concurrent-To", record)),
                F.when(first.isNull(), response).otherwise(revisit),
                headers("metadata", urn(record, F.lit("metadata")), url, noted, "application/warc-fields", ("WARC-Concurrent-To", record)),
            )
        ).alias("value")
    )


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, rows_a_file: int = 30_000) -> None:
    """Write gzipped archives of at most ``rows_a_file`` records each."""
    records(with_roles(pages, least_bytes)).write.options(
        lineSep=END + END, compression="gzip", maxRecordsPerFile=str(rows_a_file)
    ).text(path)


# --- reading -----------------------------------------------------------------------------------

FIELDS = {
    "type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "concurrent_to": "warc-concurrent-to",
    "refers_to": "warc-refers-to", "digest": "warc-payload-digest",
}
RECORD = pa.schema([*((name, pa.string()) for name in FIELDS), ("content", pa.binary())])
RECORD_DDL = ", ".join(f"{name} string" for name in FIELDS) + ", content binary"
PIECE = 1 << 20


class Inflated:
    """Bytes of a file of gzip members (or a plain one), decoded as they are asked for."""

    def __init__(self, data: memoryview):
        self.data, self.at, self.rest, self.ready = data, 0, b"", bytearray()
        self.zip = zlib.decompressobj(31) if bytes(data[:2]) == b"\x1f\x8b" else None

    def more(self) -> bool:
        """Decode one piece, to at most a few times its size; false at the end."""
        piece = self.rest
        if not piece:
            piece = self.data[self.at : self.at + PIECE]
            self.at += len(piece)
        if self.zip is None:
            self.ready += piece
            return len(piece) > 0
        if not piece:
            last = b"" if self.zip.eof else self.zip.flush()
            self.ready += last
            return len(last) > 0
        if self.zip.eof:
            self.zip = zlib.decompressobj(31)
        self.ready += self.zip.decompress(piece, 4 * PIECE)
        self.rest = self.zip.unconsumed_tail or self.zip.unused_data
        return True

    def take(self, n: int) -> bytes:
        while len(self.ready) < n and self.more():
            pass
        out = bytes(self.ready[:n])
        del self.ready[:n]
        return out

    def until(self, mark: bytes) -> bytes | None:
        seen = 0
        while (i := self.ready.find(mark, seen)) < 0:
            seen = max(0, len(self.ready) - len(mark))
            if not self.more():
                return None
        return self.take(i + len(mark))


def parse(data: memoryview) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and content of every record."""
    stream = Inflated(data)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        lines = head.decode("utf-8", "replace").strip("\r\n").split("\r\n")
        if not lines[0].startswith("WARC/"):
            continue
        fields = dict(line.split(":", 1) for line in lines[1:] if ":" in line)
        fields = {name.strip().lower(): value.strip() for name, value in fields.items()}
        yield fields, stream.take(int(fields.get("content-length", "0")))


def record_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column(0):
            rows, size = [], 0
            for fields, content in parse(memoryview(data.as_buffer())):
                rows.append([*(fields.get(name) for name in FIELDS.values()), content])
                size += len(content)
                if size > 4 << 20 or len(rows) >= 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), RECORD, strict=True)], schema=RECORD)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), RECORD, strict=True)], schema=RECORD)


def read_records(spark, path: str) -> DataFrame:
    """Every record of the archives below ``path``."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(record_batches, RECORD_DDL)


def payload_of(content: Column) -> Column:
    """What follows the HTTP header (which is ASCII, so characters are bytes there)."""
    start = F.instr(content.cast("string"), END + END)
    return F.when(start > 0, F.substring(content, start + 4, F.octet_length(content))).otherwise(content)


def captures(found: DataFrame, payload: bool = True) -> DataFrame:
    """One nested row per capture: request, response or revisit, and metadata, joined by concurrent-to.

    Requests and metadata name the record they belong to. Of copies of a record one counts; a capture
    without request or metadata has null there. Size and digest are those of the payload as read;
    without ``payload`` its bytes do not enter the join.
    """
    body = payload_of(F.col("content"))
    http = [F.octet_length(body).cast("long").alias("payload_bytes"), base32_sha1(body).alias("payload_digest")]
    more = [body.alias("payload")] if payload else []
    mains = found.where(F.col("type").isin("response", "revisit")).select(
        "record_id", F.struct("type", "record_id", "target_uri", "refers_to", F.col("digest").alias("declared_digest"), *http, *more).alias("response")
    )
    sides = [
        found.where(F.col("type") == kind).select(
            F.col("concurrent_to").alias("record_id"), F.struct(F.col("record_id"), F.col("target_uri"), F.col("content")).alias(kind)
        )
        for kind in ("request", "metadata")
    ]
    mains, request, metadata = (side.dropDuplicates(["record_id"]) for side in (mains, *sides))
    return mains.join(request, "record_id", "left").join(metadata, "record_id", "left").select("request", "response", "metadata")


def field(content: Column, name: str) -> Column:
    value = F.regexp_extract(content.cast("string"), f"(?m)^{re.escape(name)}: ([^\r\n]*)", 1)
    return F.when(value != "", value)


def capture_report(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """op8: write the pages as archives, read them back, and say what each page became.

    The payload of a revisit is not in its archive, so size and digest come from its headers there.
    """
    spark = pages.sparkSession
    path = f"{shared_dir(spark)}/llm/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, least_bytes)
    noted = F.col("metadata.content")
    revisit = F.col("response.type") == "revisit"
    return captures(read_records(spark, path), payload=False).select(
        field(noted, "page-id").try_cast("long").alias("page_id"),
        F.when(revisit, field(noted, "payload-bytes").cast("long")).otherwise(F.col("response.payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.substring("response.declared_digest", 6, 32)).otherwise(F.col("response.payload_digest")).alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.when(revisit, field(noted, "original-page-id").cast("long")).alias("refers_to"),
    )
