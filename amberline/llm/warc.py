"""WARC archives of pages, each payload stored once: revisit records stand for its further occurrences.

Only headers (digest, page, target, length, partition) are shuffled by payload digest to find the original response of each digest and to join
the other records to it.  Payloads meet by digest after equal ones of a map task have become one, so that neither a digest nor a
row that a third of all pages share gathers in a task; revisits carry no payload at all.  Archives are written by Spark's own writer, whose commits
make lost and repeated tasks harmless on any file system, with fresh headers; files have a bounded size, and are read back by content lengths.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NO_ID, checkpointed, doc_key, free_shuffles, map_arrow

#: Payloads of fewer bytes are stored each time.
MIN_BYTES = 0
#: A segment is a row of the writer: whole records of about so many bytes, or one longer record.  A file has at most so many segments.
SEGMENT_BYTES, FILE_SEGMENTS = 1 << 22, 8
#: A digest with more header rows than this is hot; the hottest ones, at most so many, are joined by a broadcast and not by a shuffle.
HOT_ROWS, HOT_DIGESTS = 10_000, 1_000

VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SEPARATOR = b"\r\n\r\n"
RECORDS = "kind string, page long, uri string, digest binary, bytes long, tag string, o_page long, o_uri string, payload binary"


# --- resolution ------------------------------------------------------------------------------

def page_headers(pages: DataFrame, key: str = "page_id", uri: str = "url", html: str = "html") -> DataFrame:
    """(digest, page, uri, bytes, part, n): the headers of all pages, equal ones of one partition counted.  No payload is shuffled."""
    payload = _payload(html)
    rows = pages.select(F.unhex(F.sha1(payload)).alias("digest"), doc_key(key).alias("page"), F.coalesce(uri, F.lit("")).alias("uri"),
                        F.octet_length(payload).cast("long").alias("bytes"), F.spark_partition_id().alias("part"))
    return rows.groupBy("digest", "page", "uri", "bytes", "part").agg(F.count("*").alias("n"))


def _payload(html: str):
    return F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")


def original_responses(headers: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(digest, o_page, o_uri, o_part, bytes, rows): the first header by (page, uri, partition) of each digest of ``min_bytes`` or more."""
    first = F.min(F.struct("page", "uri", "part")).alias("first")
    grouped = headers.where(F.col("bytes") >= min_bytes).groupBy("digest").agg(first, F.first("bytes").alias("bytes"), F.count("*").alias("rows"))
    return grouped.select("digest", *[F.col(f"first.{c}").alias(f"o_{c}") for c in ("page", "uri", "part")], "bytes", "rows")


def revisits(headers: DataFrame, originals: DataFrame) -> DataFrame:
    """Revisit records: every header but one of each digest, joined to the original response.

    Hot digests, whose number is bounded, are joined by a broadcast; a digest that is joined by the shuffle has few rows.
    """
    hot = originals.where(F.col("rows") > HOT_ROWS).orderBy(F.desc("rows"), "digest").limit(HOT_DIGESTS).drop("bytes")
    joined = (headers.join(F.broadcast(hot), "digest")
              .unionByName(headers.join(F.broadcast(hot.select("digest")), "digest", "left_anti").join(originals.drop("bytes"), "digest")))
    own = (F.col("page") == F.col("o_page")) & (F.col("uri") == F.col("o_uri")) & (F.col("part") == F.col("o_part"))
    further = joined.withColumn("n", F.col("n") - own.cast("long")).where("n > 0")
    # equal headers are at most the rows of one partition
    each = further.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    return each.select(F.lit("revisit").alias("kind"), "page", "uri", "digest", "bytes", F.concat_ws(":", "part", "copy").alias("tag"), "o_page", "o_uri",
                       F.lit(None).cast("binary").alias("payload"))


def responses(pages: DataFrame, originals: DataFrame, min_bytes: int = MIN_BYTES, key: str = "page_id", uri: str = "url",
              html: str = "html") -> DataFrame:
    """Response records: one for each digest of ``min_bytes`` or more, with the header of its original, and every shorter page."""
    nothing = [F.lit(None).cast("long").alias("o_page"), F.lit(None).cast("string").alias("o_uri")]
    rows = pages.select(_payload(html).alias("payload"), doc_key(key).alias("page"), F.coalesce(uri, F.lit("")).alias("uri"))
    rows = rows.withColumns({"digest": F.unhex(F.sha1("payload")), "bytes": F.octet_length("payload").cast("long")})
    once = rows.where(F.col("bytes") >= min_bytes).groupBy("digest").agg(F.first("payload").alias("payload"))
    out = once.join(originals, "digest").select(F.lit("response").alias("kind"), F.col("o_page").alias("page"), F.col("o_uri").alias("uri"), "digest", "bytes",
                                                F.lit("").alias("tag"), *nothing, "payload")
    if not min_bytes:
        return out
    short = rows.where(F.col("bytes") < min_bytes)
    return out.unionByName(short.select(F.lit("response").alias("kind"), "page", "uri", "digest", "bytes",
                                        F.monotonically_increasing_id().cast("string").alias("tag"), *nothing, "payload"))


# --- writing -----------------------------------------------------------------------------------

def record_id(kind: str, page: int, uri: str, digest: bytes, tag: str) -> str:
    """The same for a repeated task; different for all records of a job."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(b'|'.join([kind.encode(), str(page).encode(), uri.encode(), digest, tag.encode()])).digest(), version=4)}>"


def _target(uri: str) -> str:
    """The address on one line: control characters and spaces are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in uri)


def record(kind: str, page: int, uri: str, digest: bytes, size: int, tag: str, o_page: int | None, o_uri: str | None, payload: bytes | None, date: str) -> bytes:
    """A whole record without the separator behind it.  The block of a revisit has the HTTP header alone."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size + (payload or b"")
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id(kind, page, uri, digest, tag)), ("WARC-Date", date)]
    if uri:
        fields.append(("WARC-Target-URI", _target(uri)))
    fields.append(("WARC-Payload-Digest", f"sha1:{base64.b32encode(digest).decode()}"))
    if page != NO_ID:
        fields.append(("X-Page-ID", page))
    if kind == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id("response", o_page, o_uri, digest, "")), ("WARC-Refers-To-Date", date)]
        if o_uri:
            fields.append(("WARC-Refers-To-Target-URI", _target(o_uri)))
        if o_page != NO_ID:
            fields.append(("X-Refers-To-Page-ID", o_page))
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    return VERSION + b"\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields).encode() + b"\r\n" + block


def _segments(date: str, segment_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                held.append(record(*[c[i].as_py() for c in batch.columns], date))
                size += len(held[-1])
                if size >= segment_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([SEPARATOR.join(held)], pa.binary())], names=["segment"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([SEPARATOR.join(held)], pa.binary())], names=["segment"])

    return run


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES, date: str | None = None, compress: bool = True,
                   segment_bytes: int = SEGMENT_BYTES, file_segments: int = FILE_SEGMENTS, key: str = "page_id", uri: str = "url", html: str = "html") -> None:
    """Writes a record per row of ``pages`` into new archives in ``folder``.

    Of the rows with equal payloads of ``min_bytes`` or more (the html in UTF-8; null is empty) the one with the smallest id is written as a
    response, with ties by address, and of rows equal in both any one; all others are revisits of it.  Null ids sort last and write no X-Page-ID; a null or
    empty address writes no target.  Shorter payloads are all responses.  Payloads are equal if their SHA-1 digests are.  An empty table
    gives archives without records; other columns do not matter.  ``date`` is that of all records, by default now.  With ``compress`` a file is one
    gzip stream.  Files hold about ``segment_bytes * file_segments`` bytes before that, more only where a page is larger by itself.
    """
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    headers = checkpointed(page_headers(pages, key, uri, html))
    originals = checkpointed(original_responses(headers, min_bytes))
    records = responses(pages, originals, min_bytes, key, uri, html).unionByName(revisits(headers.where(F.col("bytes") >= min_bytes), originals))
    columns = [c.split()[0] for c in RECORDS.split(", ")]
    segments = map_arrow(records.select(columns), _segments(date, segment_bytes), "segment binary")
    (segments.select(F.col("segment").cast("string").alias("value")).write.option("lineSep", SEPARATOR.decode())
     .option("compression", "gzip" if compress else "none").option("maxRecordsPerFile", file_segments).text(folder))
    free_shuffles(pages)


# --- reading ------------------------------------------------------------------------------------

def parse(content: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record.  Blocks end by their content length; what they hold does not matter."""
    while line := content.readline():
        if line.rstrip(b"\r\n") not in (b"WARC/1.0", VERSION):
            raise ValueError("a record must begin with its version")
        fields = {}
        while (line := content.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields["content-length"])
        block = content.read(size)
        if len(block) != size or content.read(4) != SEPARATOR:
            raise ValueError("a record is cut off")
        yield fields, block


def _open(content: bytes) -> io.BufferedIOBase:
    if content[:2] != b"\x1f\x8b":
        return io.BytesIO(content)
    return io.BufferedReader(_Unzipped(content), 1 << 18)


class _Unzipped(io.RawIOBase):
    """The contents of gzip members one after the other, some 256 KB at a time."""

    def __init__(self, content: bytes):
        self.rest, self.member = content, zlib.decompressobj(wbits=31)

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        while self.rest or not self.member.eof:
            if self.member.eof:
                self.member = zlib.decompressobj(wbits=31)
            data = self.member.decompress(self.rest, len(into))
            self.rest = self.member.unused_data if self.member.eof else self.member.unconsumed_tail
            if data:
                into[:len(data)] = data
                return len(data)
            if not self.rest and not self.member.eof:
                raise ValueError("an archive is cut off")
        return 0


READ = pa.schema([("archive", pa.string()), ("record_type", pa.string()), ("record_id", pa.string()), ("date", pa.string()), ("target", pa.string()),
                  ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to_record", pa.string()),
                  ("refers_to", pa.int64()), ("payload", pa.binary())])
READ_DDL = ("archive string, record_type string, record_id string, date string, target string, page_id long, payload_bytes long, payload_digest string, "
            "refers_to_record string, refers_to long, payload binary")


def _read_record(path: str, fields: dict[str, str], block: bytes, payloads: bool) -> tuple:
    head, _, body = block.partition(SEPARATOR)
    http = dict(line.decode("latin-1").lower().split(":", 1) for line in head.split(b"\r\n")[1:] if b":" in line)
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
    size = int(http["content-length"])
    if kind == "response" and (len(body) != size or base64.b32encode(hashlib.sha1(body).digest()).decode() != digest):
        raise ValueError(f"the payload of {fields['warc-record-id']} is not the one that its digest was taken of")
    number = [int(fields[n]) if n in fields else None for n in ("x-page-id", "x-refers-to-page-id")]
    return (path, kind, fields["warc-record-id"], fields["warc-date"], fields.get("warc-target-uri"), number[0], size, digest, fields.get("warc-refers-to"),
            number[1], body if payloads and kind == "response" else None)


def _reader(payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                held, size = [], 0
                for fields, block in parse(_open(content.as_py())):
                    held.append(_read_record(path.as_py(), fields, block, payloads))
                    size += 500 + (len(block) if payloads else 0)
                    if size >= SEGMENT_BYTES:
                        yield _records(held)
                        held, size = [], 0
                if held:
                    yield _records(held)

    return run


def _records(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), READ)], schema=READ)


def read_archives(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """The records of all archives in ``folder``: type, ids, date, target, size and digest of the full payload, and what a revisit refers to.

    The payload of each response is checked against its digest, and returned with ``payloads``.  Plain and gzip files are read, with any number of gzip members.
    """
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    out = map_arrow(files, _reader(payloads), READ_DDL)
    return out if payloads else out.drop("payload")
