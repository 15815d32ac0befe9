"""Operator 5 — WARC archives with an index written first, read back by coalesced byte ranges.

``write_archives`` finds the response of every payload digest (smallest
page_id; payloads under ``MIN_REVISIT_BYTES`` never revisit), then each task
writes its records to archive files of its own in the shared folder — one
gzip member per record — and returns an index row per record: file, offset,
length, URL, digest.  The index is stored as Parquet; only archives of
successful tasks are in it, so a lost executor or a repeated task leaves at
most an unreferenced file.  ``read_records`` sorts the selected index rows by
file and offset, merges neighbouring ranges into one read, and parses records.

Files are reached through ``pyarrow.fs`` (file, hdfs, s3, gs).  The digest
join has plain shuffled sides, so a payload that a third of all pages share
is split by Spark; the responses side is one row per shared digest.

Defined results: null html is an empty payload; a null URL is empty in the
record; control characters of a URL are percent-encoded; rows that repeat
the page_id of a response are responses; a null page_id revisits like any other
but is never the response while a page with an id has the payload.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.shared import table, written
from quarry.session import shared_dir

MIN_REVISIT_BYTES = 100
ARCHIVE_BYTES = 1 << 30  # a task starts a new archive beyond this size
READ_BYTES = 8 << 20  # most bytes of one coalesced read
MAX_GAP = 64 << 10  # unwanted bytes read rather than starting another read
WARC_DATE = "2020-01-01T00:00:00Z"
INDEX = "page_id long, url string, digest string, record_type string, file string, offset long, length long"


def _clean(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record_bytes(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One WARC/1.1 record; a revisit keeps the HTTP header and leaves the payload out."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if not revisit:
        block += payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {url}",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Header fields (lower-case names) and, under ``payload``, the payload (None for a revisit)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    fields["payload_bytes"] = int(re.search(rb"Content-Length: (\d+)", http)[1])
    fields["payload"] = payload if fields["warc-type"] == "response" else None
    return fields


def with_responses(pages: DataFrame) -> DataFrame:
    """Adds payload, digest, response_id: the page_id that a revisit refers to (null: a response)."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    shared = rows.where(F.octet_length("payload") >= MIN_REVISIT_BYTES).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
    shared = written(shared.where("n > 1").select("digest", "first_id"), "op5-shared")
    response = F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    return rows.join(shared, "digest", "left").select("page_id", "url", "payload", "digest", response.alias("response_id"))


def write_archives(pages: DataFrame, folder: str, date: str = WARC_DATE) -> DataFrame:
    """Write archives below ``folder`` and return the stored index."""
    rows = with_responses(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        for batch in batches:
            index: list[tuple] = []
            for page_id, url, payload, digest, response in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None or at >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0  # an attempt never meets another's file
                    out = system.open_output_stream(f"{base}/{name}", compression=None)  # members are compressed here
                url = _clean(url or "")
                data = gzip.compress(record_bytes(page_id, url, payload.encode(), digest, response, response is not None, date), 6, mtime=0)
                out.write(data)
                index.append((page_id, url, digest, "response" if response is None else "revisit", name, at, len(data)))
                at += len(data)
            if index:
                kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
                names = ["page_id", "url", "digest", "record_type", "file", "offset", "length"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*index), kinds)], names=names)
        if out is not None:
            out.close()

    return written(rows.mapInArrow(run, INDEX), "op5-index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to) of the records in ``index``."""
    part = F.floor(F.col("offset") / READ_BYTES).alias("part")
    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # index rows are few bytes, what they name is not
    rows = index.select("file", part, "offset", "length").repartition(tasks, "file", "part").sortWithinPartitions("file", "offset")
    schema = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"

    def number(field: str | None) -> int | None:
        found = re.fullmatch(r"<urn:x-page:(-?\d+)>", field or "")
        return int(found[1]) if found else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        handle, opened = None, None
        for batch in batches:
            rows = list(zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))))
            at = 0
            while at < len(rows):
                file, begin, length = rows[at]
                end, stop = at + 1, begin + length
                while end < len(rows) and rows[end][0] == file and rows[end][1] - stop <= MAX_GAP and rows[end][1] + rows[end][2] - begin <= READ_BYTES:
                    stop = rows[end][1] + rows[end][2]
                    end += 1
                if opened != file:
                    if handle is not None:
                        handle.close()
                    handle, opened = system.open_input_file(f"{base}/{file}"), file
                data = handle.read_at(stop - begin, begin)
                out = []
                for _, offset, size in rows[at:end]:
                    rec = parse_record(gzip.decompress(data[offset - begin : offset - begin + size]))
                    stated = rec["warc-payload-digest"].removeprefix("sha256:")
                    payload = rec["payload"]
                    if payload is not None and hashlib.sha256(payload).hexdigest() != stated:
                        raise ValueError(f"digest mismatch in {file} at {offset}")
                    out.append((number(rec["warc-record-id"]), rec["warc-target-uri"], payload, rec["payload_bytes"], stated, rec["warc-type"], number(rec.get("warc-refers-to"))))
                kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                names = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                at = end
        if handle is not None:
            handle.close()

    return rows.mapInArrow(run, schema)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "op5-archives")
    index = write_archives(table(spark, sf_dir, "pages"), folder)
    return read_records(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= {MIN_REVISIT_BYTES} GROUP BY payload_digest),
r AS (SELECT p.*, CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to FROM p LEFT JOIN f USING (payload_digest))
SELECT page_id, payload_bytes, payload_digest, CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to FROM r
"""
