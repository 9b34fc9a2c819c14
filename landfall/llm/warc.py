"""WARC archives of pages, written and read by way of a table of record chunks.

A payload goes through as rows (record, chunk number, bytes) with the digest of
the payload so far, so a task holds one chunk, never one record. Each chunk
becomes a WARC record of its own: the first is the record, the others are its
``continuation`` segments, as the format provides for large records. Spark's text
writer puts a record per row between line ends of CR LF, which makes the files
plain WARC, gzipped as a whole; its commit leaves nothing of lost attempts. Reading
streams the lines of each file, of which no one is longer than a chunk, and
carries the digest over the segments of a record.

Of pages with equal payloads of at least ``MIN_SHARED`` bytes, that with the
smallest id is a ``response``, the others are ``revisit`` records that refer to it
and hold no payload. NULL counts as the empty payload. Rows that repeat the
smallest id are all responses; a page without an id refers to another page if one
has its payload and is a response otherwise. Control characters in a URL are
percent-encoded in its header.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm.words import tidy
from landfall.session import materialize

MIN_SHARED = 100
CHUNK_BYTES = 1 << 20
# Bytes of chunks in a batch handed to Spark.
BATCH_BYTES = 4 << 20

CHUNKS = "page_id long, url string, refers_to long, total long, chunk int, last boolean, bytes binary, running string"
SEGMENTS = """page_id long, type string, refers_to long, chunk int, last boolean, payload_bytes long, payload_digest string,
    stated_bytes long, stated_digest string"""


def page_roles(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, the payload ``html``, its ``digest`` and size, and ``refers_to``, NULL for responses."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    pages = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        html.alias("html"),
        F.sha2(html.cast("binary"), 256).alias("digest"),
        F.octet_length(html).cast("long").alias("total"),
    )
    # Only payloads that several pages share matter; their first pages are counted before any shuffle.
    shared = (
        pages.filter(F.col("total") >= MIN_SHARED)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("pages"))
        .filter("pages > 1 and first is not null")
        .select("digest", "first")
    )
    found = pages.join(materialize(shared), "digest", "left")
    return found.withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))).drop("first")


def record_chunks(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Rows of ``CHUNKS`` for pages with roles. Chunks end between characters."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            names = batch.schema.names
            for k in range(batch.num_rows):
                page = {c: batch.column(i)[k] for i, c in enumerate(names)}
                data = memoryview(page["html"].as_buffer()) if page["refers_to"].as_py() is None else memoryview(b"")
                head = [page[c].as_py() for c in ("page_id", "url", "refers_to", "total")]
                digest, start, chunk = hashlib.sha256(), 0, 0
                while True:
                    end = min(start + chunk_bytes, len(data))
                    while end < len(data) and data[end] & 0xC0 == 0x80:
                        end -= 1
                    end = end if end > start else len(data)
                    digest.update(data[start:end])
                    running = page["digest"].as_py() if head[2] is not None else digest.hexdigest()
                    held.append((*head, chunk, end == len(data), bytes(data[start:end]), running))
                    size += end - start + 200
                    if size > BATCH_BYTES:
                        yield _batch(held)
                        held, size = [], 0
                    if end == len(data):
                        break
                    start, chunk = end, chunk + 1
        if held:
            yield _batch(held)

    return pages.select("page_id", "url", "refers_to", "total", "digest", "html").mapInArrow(tidy(rows), CHUNKS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.string())
    names = ("page_id", "url", "refers_to", "total", "chunk", "last", "bytes", "running")
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], list(names)
    )


def _name(page_id, chunk) -> F.Column:
    number = F.coalesce(F.col(page_id).cast("string") if isinstance(page_id, str) else page_id, F.lit("none"))
    return F.concat(F.lit("<urn:page:"), number, F.lit(":"), chunk.cast("string"), F.lit(">"))


def warc_records(chunks: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """One text row per WARC record; each ends in one of the two line ends after a record, the writer adds the other."""
    first, revisit = F.col("chunk") == 0, F.col("refers_to").isNotNull()
    line = F.lit("\r\n")
    # Characters that would end a header line.
    url = F.regexp_replace(F.coalesce("url", F.lit("")), "[\\x00-\\x20\\x7f]", "%20")
    kind = F.when(~first, "continuation").when(revisit, "revisit").otherwise("response")
    segmented = ~first | ~F.col("last")

    def field(name: str, value, where=None):
        text = F.concat(F.lit(f"{name}: "), value, line)
        return text if where is None else F.when(where, text).otherwise("")

    head = F.concat(
        F.lit("WARC/1.1"), line,
        field("WARC-Type", kind),
        field("WARC-Record-ID", _name("page_id", F.col("chunk"))),
        field("WARC-Date", F.lit(date)),
        field("WARC-Target-URI", url),
        field("WARC-Page-ID", F.col("page_id").cast("string"), F.col("page_id").isNotNull()),
        field("WARC-Refers-To", _name("refers_to", F.lit(0)), first & revisit),
        field("WARC-Refers-To-Page-ID", F.col("refers_to").cast("string"), first & revisit),
        field("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), first & revisit),
        field("WARC-Payload-Length", F.col("total").cast("string"), first),
        field("WARC-Segment-Number", (F.col("chunk") + 1).cast("string"), segmented),
        field("WARC-Segment-Origin-ID", _name("page_id", F.lit(0)), ~first),
        field("WARC-Segment-Total-Length", F.col("total").cast("string"), ~first & F.col("last")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("running")), F.col("last")),
        field("Content-Type", F.lit("text/html; charset=utf-8")),
        field("Content-Length", F.octet_length("bytes").cast("string")),
        line,
    )
    return chunks.select(F.concat(head, F.col("bytes").cast("string"), line).alias("value"))


def write_archives(pages: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES) -> None:
    """Write a WARC record for every page below ``path``, one gzipped file per task."""
    records = warc_records(record_chunks(page_roles(pages), chunk_bytes))
    records.write.option("lineSep", "\r\n").option("compression", "gzip").text(path)


class _Parser:
    """Turns the lines of a file into rows of segments; holds a line, a header and a digest."""

    def __init__(self):
        self.digest, self.bytes = hashlib.sha256(), 0
        self.header: dict[str, str] = {}
        self.state, self.left = "start", 0

    def line(self, text: bytes) -> dict | None:
        if self.state == "payload":
            # The line ends belong to the payload as long as it is not complete.
            take = min(self.left, len(text))
            self._add(text[:take])
            if take < len(text):
                raise ValueError("a record is longer than it states")
            if self.left:
                self._add(b"\r\n"[: self.left])
                if self.left:
                    return None
                self.state = "split"  # the payload ends in a line end, or within one
                return None
            self.state = "end"
            return self._row()
        if self.state == "split":
            if text:
                raise ValueError("a record is longer than it states")
            self.state = "end"
            return self._row()
        if self.state == "header":
            if text:
                name, _, value = text.decode("utf-8").partition(": ")
                self.header[name] = value
                return None
            self.left = int(self.header["Content-Length"])
            if self.header["WARC-Type"] != "continuation":
                self.digest, self.bytes = hashlib.sha256(), 0
            self.state = "payload"
            return None
        if text == b"WARC/1.1":
            self.header, self.state = {}, "header"
        elif text:
            raise ValueError("no record begins where one should")
        return None

    def _add(self, data: bytes) -> None:
        self.digest.update(data)
        self.bytes += len(data)
        self.left -= len(data)

    def _row(self) -> dict:
        h = self.header
        number = h.get("WARC-Page-ID")
        refers = h.get("WARC-Refers-To-Page-ID")
        stated = h.get("WARC-Payload-Digest")
        return {
            "page_id": None if number is None else int(number),
            "type": h["WARC-Type"],
            "refers_to": None if refers is None else int(refers),
            "chunk": int(h.get("WARC-Segment-Number", 1)) - 1,
            "last": stated is not None,
            "payload_bytes": self.bytes,
            "payload_digest": self.digest.hexdigest(),
            "stated_bytes": int(h.get("WARC-Payload-Length") or h.get("WARC-Segment-Total-Length") or -1),
            "stated_digest": None if stated is None else stated.removeprefix("sha256:"),
        }


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """One row per WARC record of the files below ``path``, with the digest of the payload up to its end."""
    kinds = pa.schema(
        [("page_id", pa.int64()), ("type", pa.string()), ("refers_to", pa.int64()), ("chunk", pa.int32()),
         ("last", pa.bool_()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
         ("stated_bytes", pa.int64()), ("stated_digest", pa.string())]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, parser, held = None, _Parser(), []
        for batch in batches:
            for name, text in zip(batch.column("file"), batch.column("value"), strict=True):
                if not name.equals(file) if file is not None else True:
                    file, parser = name, _Parser()
                row = parser.line(text.as_py())
                if row is not None:
                    held.append(row)
            if held:
                yield pa.RecordBatch.from_pylist(held, kinds)
                held = []

    # A gzipped file is one split, so its lines come to one task in their order.
    lines = spark.read.option("lineSep", "\r\n").text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))
    return lines.mapInArrow(tidy(rows), SEGMENTS)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per page: size and digest of its full payload, whether it is a revisit, and of which page.

    A response is measured as read; a record whose payload differs from its
    stated digest raises an error. A revisit states both of the payload it refers to.
    """
    revisit = F.col("type") == "revisit"
    # A record's last segment carries its sums.
    rows = read_segments(spark, path).filter("last")
    right = revisit | (F.col("payload_digest") == F.col("stated_digest")) & (F.col("payload_bytes") == F.col("stated_bytes"))
    digest = F.when(revisit, F.col("stated_digest")).when(right, F.col("payload_digest"))
    return rows.select(
        "page_id",
        F.when(revisit, F.col("stated_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.coalesce(digest, F.raise_error(F.lit("a payload differs from its digest"))).alias("payload_digest"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "refers_to",
    )
