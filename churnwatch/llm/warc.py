"""WARC archives: writing captures, reading records, assembling transactions.

A capture is a request, a response (or a revisit of an earlier equal payload) and a
metadata record, tied together by ``WARC-Concurrent-To``. Archives are written by Spark's
text writer with the record end as line separator and read back as binary files, each
record by its ``Content-Length``, so payloads may hold anything.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnwatch.session import checkpoint_dir, cut_lineage, ready_python

DATE = "2024-01-01T00:00:00Z"
RECORDS_PER_FILE = 12_288  # three for each capture; with the shuffle's partition size this bounds an archive
BATCH_BYTES = 8 << 20  # payload held by the reader before it passes a batch on
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = (
    "file string, kind string, record_id string, concurrent_to string, refers_to string, target_uri string, date string, "
    "payload_digest string, payload_bytes long, http_head string, fields map<string,string>, payload binary"
)


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a string's UTF-8 bytes: four groups of 40 bits."""
    digest = F.sha1(payload.cast("binary"))
    digits = [F.lpad(F.conv(F.substring(digest, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _urn(kind: str, row: Column) -> Column:
    h = F.md5(F.concat(F.lit(kind + "/"), row))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(kind: Column, headers: list[tuple[str, Column]], block: Column) -> Column:
    """Record text up to, not including, the two line ends behind the block; null headers are left out."""
    lines = [F.concat(F.lit("WARC-Type: "), kind)] + [F.concat(F.lit(f"{k}: "), v) for k, v in headers]
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.lit("WARC/1.1\r\n"), F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), block)


def revisits(rows: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``row, to_row, to_page``: the rows that revisit another. ``rows``: ``row, page_id, digest, bytes``.

    Of equal payloads the smallest page_id is the response (null ids last, ties by row).
    The smallest is a grouped minimum, so a hot payload is one row before the join; the
    join's hot key is split by adaptive execution.
    """
    large = rows.where(F.col("bytes") >= least_bytes)
    first = large.groupBy("digest").agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row")).alias("f"), F.count("*").alias("n"))
    first = first.where("n > 1").select("digest", F.col("f.row").alias("to_row"), F.col("f.page_id").alias("to_page"))
    return large.join(first, "digest").where(F.col("row") != F.col("to_row")).select("row", "to_row", "to_page")


def write_archives(pages: DataFrame, path: str, row: Column | None = None, least_bytes: int = 0) -> None:
    """Writes request, response or revisit, and metadata records of every row as gzip archives under ``path``.

    ``pages`` has ``page_id, url, html``. ``row`` is a string that names a row for good,
    such as its file and place in it; without one the table is written once and numbered.
    Repeated rows are captures of their own. Null html is an empty payload; a null url or
    page_id is left out of its record; line breaks in a url become %0D and %0A.
    """
    if row is None:
        pages = cut_lineage(pages.select("page_id", "url", "html", F.monotonically_increasing_id().cast("string").alias("row")), "warc-pages")
        row = F.col("row")
    payload = F.coalesce(F.col("html"), F.lit(""))
    named = pages.select(row.alias("row"), "page_id", "url", payload.alias("payload"))
    roles = cut_lineage(
        revisits(named.select("row", "page_id", base32_sha1(F.col("payload")).alias("digest"), F.octet_length("payload").cast("long").alias("bytes")), least_bytes),
        "warc-revisits",
    )
    full = named.join(roles, "row", "left").withColumn("digest", base32_sha1(F.col("payload")))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    again = F.col("to_row").isNotNull()
    own = _urn("response", F.col("row"))
    path_of = F.regexp_replace(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z]+://[^/?#]*([^#]*)", 1), F.lit("")), r"[\x20]", "%20")
    host = F.coalesce(F.regexp_extract(url, r"^[a-zA-Z]+://([^/?#]*)", 1), F.lit(""))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("payload").cast("string"), F.lit("\r\n\r\n"))
    common = [("WARC-Target-URI", url), ("WARC-Date", F.lit(DATE))]
    tied = [("WARC-Concurrent-To", own), *common]
    request = _record(
        F.lit("request"), [("WARC-Record-ID", _urn("request", F.col("row"))), *tied, ("Content-Type", F.lit("application/http; msgtype=request"))],
        F.concat(F.lit("GET "), F.when(path_of.startswith("/"), path_of).otherwise(F.concat(F.lit("/"), path_of)), F.lit(" HTTP/1.1\r\nHost: "), host, F.lit("\r\n\r\n")),
    )
    response = _record(
        F.when(again, F.lit("revisit")).otherwise(F.lit("response")),
        [
            ("WARC-Record-ID", own), *common, ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
            ("WARC-Refers-To", F.when(again, _urn("response", F.col("to_row")))), ("WARC-Profile", F.when(again, F.lit(REVISIT))),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        F.when(again, head).otherwise(F.concat(head, "payload")),
    )
    metadata = _record(
        F.lit("metadata"), [("WARC-Record-ID", _urn("metadata", F.col("row"))), *tied, ("Content-Type", F.lit("application/warc-fields"))],
        F.concat(F.lit("via: pages\r\n"), F.coalesce(F.concat(F.lit("pageId: "), F.col("page_id").cast("string"), F.lit("\r\n")), F.lit(""))),
    )
    records = full.select(F.explode(F.array(request, response, metadata)).alias("value"))
    (
        records.write.mode("overwrite").option("lineSep", "\r\n\r\n").option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)
    )


def _fields(block: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in block.decode("utf-8", "replace").split("\r\n") if ":" in line)
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def parse(archive, name: str, with_payload: bool) -> Iterator[tuple]:
    """Records of one archive stream, by Content-Length."""
    while line := archive.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{name}: no record where one should begin: {line[:60]!r}")
        head = b""
        while (line := archive.readline()).strip():
            head += line
        h = _fields(head)
        block = archive.read(size := int(h["content-length"]))
        if len(block) < size:
            raise ValueError(f"{name}: the archive ends inside a record")
        kind, payload, http, fields, length, digest = h["warc-type"], None, None, None, None, h.get("warc-payload-digest", "").removeprefix("sha1:") or None
        if kind in ("request", "response", "revisit"):
            top, _, payload = block.partition(b"\r\n\r\n")
            http = top.decode("utf-8", "replace")
            declared = _fields(top).get("content-length")
            length = int(declared) if declared is not None else len(payload)
            if kind == "response":
                if length != len(payload):
                    raise ValueError(f"{name}: {h.get('warc-record-id')} declares {length} payload bytes and holds {len(payload)}")
                digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if kind != "response" or not with_payload:
                payload = None
        elif kind == "metadata":
            fields = _fields(block)
        yield (
            name, kind, h.get("warc-record-id"), h.get("warc-concurrent-to"), h.get("warc-refers-to"), h.get("warc-target-uri"),
            h.get("warc-date"), digest, length, http, fields, payload,
        )


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """All records of the archives under ``path``, in the schema ``RECORD``; any file store that Spark reads will do.

    One archive's compressed bytes are in memory at a time; records stream out of it.
    ``with_payload=False`` leaves payloads behind once they are measured and hashed.
    """
    ready_python(spark)
    kinds = [pa.string()] * 8 + [pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary()]
    names = [c.split()[0] for c in RECORD.split(", ")]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = [list(c) for c in zip(*rows)]
        columns[10] = [None if x is None else list(x.items()) for x in columns[10]]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1)):
                raw = io.BytesIO(memoryview(content.as_buffer()))
                archive = gzip.GzipFile(fileobj=raw) if raw.getbuffer()[:2] == b"\x1f\x8b" else raw
                for row in parse(io.BufferedReader(archive, 1 << 20) if archive is not raw else raw, name, with_payload):
                    rows.append(row)
                    held += 500 + len(row[-1] or b"")
                    if held >= BATCH_BYTES:
                        yield batch(rows)
                        rows, held = [], 0
        if rows:
            yield batch(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id, target_uri, date, response, request, metadata``.

    Requests and metadata are joined to the response or revisit they are concurrent to; either is null if the archive
    has none, and a record concurrent to nothing known is in no capture. Record ids are
    unique, so the join keys are even. ``response.refers_to_page`` names the page of the
    response that a revisit refers to, found by its record id.
    """
    main = records.where(F.col("kind").isin("response", "revisit")).select(
        F.col("record_id").alias("capture_id"), "target_uri", "date",
        F.struct("file", "kind", "payload_digest", "payload_bytes", "refers_to", "http_head", "payload").alias("response"),
    )
    request = records.where("kind = 'request'").select(F.col("concurrent_to").alias("capture_id"), F.struct("record_id", F.col("http_head").alias("head")).alias("request"))
    metadata = records.where("kind = 'metadata'").select(F.col("concurrent_to").alias("capture_id"), F.struct("record_id", "fields").alias("metadata"))
    whole = main.join(request, "capture_id", "left").join(metadata, "capture_id", "left")
    page = F.element_at("metadata.fields", "pageid").cast("long")
    target = records.where("kind = 'metadata'").select(F.col("concurrent_to").alias("at"), F.element_at("fields", "pageid").cast("long").alias("refers_to_page"))
    back = whole.select(F.col("response.refers_to").alias("at")).where("at is not null").distinct().join(target, "at")
    return (
        whole.withColumn("page_id", page).join(back, F.col("response.refers_to") == F.col("at"), "left").drop("at")
    )


def round_trip(spark: SparkSession, pages: DataFrame, row: Column | None = None, with_payload: bool = False) -> DataFrame:
    """Writes ``pages`` as archives in the shared folder, reads them back and assembles the captures."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/churnwatch/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, row)
    return assemble(cut_lineage(read_archives(spark, path, with_payload), "warc-records"))
