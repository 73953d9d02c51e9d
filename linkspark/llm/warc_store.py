"""WARC archives with the index first.

``write_archives`` writes one gzip member per record into one archive per task and returns the index:
file, offset, length, URL and digest of every record.  ``read_records`` takes any selection of index
rows, sorts them by file and offset, merges near neighbours into one byte-range read each, and parses
the records.  Payloads cross one exchange, on their way to the duplicate lookup; after that only index
rows move.

Defined cases: a null payload is empty; payloads under ``min_dup_bytes`` are never revisits; among equal
longer payloads every row holding the smallest ``page_id`` (repeated rows too) is a response and the
others revisit it; where all their ids are null, all are responses; a null URL leaves the header out; an
empty table gives no archive and an empty index; other columns are ignored.

Lost executors: an attempt writes a file of its own name and index rows count only when the task ends
well, so a half-written file of a lost attempt is never referred to.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkspark.llm.common import materialise, read, shared_path

MIN_DUP_BYTES = 100
#: A digest of so many pages at least, and of a HOT_DIGESTS-th of all pages, is looked up by broadcast: HOT_DIGESTS of them at most.
HOT_ROWS, HOT_DIGESTS = 1000, 100_000
#: Ranges of a file closer than this are read at once, up to MAX_READ bytes.
GAP, MAX_READ, READ_TASK = 1 << 16, 8 << 20, 16 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = ("file string, offset long, length long, url string, page_id long, payload_digest string, "
         "payload_bytes long, record_type string, refers_to long")


def filesystem(uri: str):
    """The file system behind a folder and the folder's path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One WARC/1.1 record; a revisit holds the HTTP head only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>" if page_id is None else f"WARC-Record-ID: <urn:page:{page_id}>",
            f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload (behind the HTTP head) of one uncompressed record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def _member(data: bytes, level: int = 3) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def plan_records(pages: DataFrame, min_dup_bytes: int = MIN_DUP_BYTES, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``page_id, url, payload, payload_digest, payload_bytes, refers_to`` of every page.  Digests that many pages
    share are looked up in a broadcast table; other rows meet theirs by digest, and rows with nothing left to
    look up are dealt out evenly."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    base = pages.select("page_id", "url", payload.alias("payload")).select(
        "*", F.sha2("payload", 256).alias("payload_digest"), F.octet_length("payload").cast("long").alias("payload_bytes"))
    large = F.col("payload_bytes") >= min_dup_bytes
    dups = materialise(base.where(large).groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
                       .where("n > 1"), "warc-equal")
    many = F.col("n") >= max(hot_rows, pages.count() // HOT_DIGESTS)
    hot = dups.where(many).select(F.col("payload_digest").alias("hot"), F.col("first_id").alias("hot_id"))
    rest = dups.where(~many).select(F.col("payload_digest").alias("k"), "first_id")
    known = base.join(F.broadcast(hot), F.col("payload_digest") == F.col("hot"), "left")
    key = F.when(large & F.col("hot").isNull(), F.col("payload_digest")).otherwise(
        F.concat(F.lit("alone "), F.xxhash64("page_id", "url", F.monotonically_increasing_id()).cast("string")))
    first = F.coalesce("hot_id", "first_id")
    return known.withColumn("k", key).join(rest, "k", "left").select(
        "page_id", "url", "payload", "payload_digest", "payload_bytes",
        F.when(~F.col("page_id").eqNullSafe(first), first).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, min_dup_bytes: int = MIN_DUP_BYTES,
                   date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write the archives into ``folder`` and return their index (itself a table in the shared folder)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, base = filesystem(folder)
        out, name, at = None, None, 0
        try:
            for batch in batches:
                rows = []
                for p in batch.to_pylist():
                    if out is None:
                        name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                        store.create_dir(base, recursive=True)
                        out = store.open_output_stream(f"{base}/{name}", compression=None)
                        info = b"software: linkspark\r\nformat: WARC File Format 1.1\r\n"
                        member = _member(
                            f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {date}\r\n"
                            f"Content-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n".encode() + info + b"\r\n\r\n")
                        out.write(member)
                        at = len(member)
                    member = _member(record_bytes(p["page_id"], p["url"], p["payload"], p["payload_digest"], p["refers_to"], date))
                    out.write(member)
                    rows.append((name, at, len(member), p["url"], p["page_id"], p["payload_digest"], p["payload_bytes"],
                                 "response" if p["refers_to"] is None else "revisit", p["refers_to"]))
                    at += len(member)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _INDEX_TYPES)], _INDEX_NAMES)
        finally:
            if out is not None:
                out.close()

    return materialise(plan_records(pages, min_dup_bytes).mapInArrow(write, INDEX), "warc-index")


_INDEX_NAMES = [x.split()[0] for x in INDEX.split(", ")]
_INDEX_TYPES = [pa.int64() if x.endswith("long") else pa.string() for x in INDEX.split(", ")]


def merged_ranges(items: list[tuple[str, int, int]], gap: int = GAP, most: int = MAX_READ) -> list[tuple[str, int, int, int, int]]:
    """Runs of sorted ``(file, offset, length)`` as ``(file, start, end, first, last + 1)``."""
    runs: list[list] = []
    for i, (file, start, length) in enumerate(items):
        if runs and runs[-1][0] == file and start <= runs[-1][2] + gap and start + length - runs[-1][1] <= most:
            runs[-1][2], runs[-1][4] = max(runs[-1][2], start + length), i + 1
        else:
            runs.append([file, start, start + length, i, i + 1])
    return [tuple(r) for r in runs]


def read_records(selected: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records behind ``selected`` index rows: ``page_id, url, record_type, refers_to, payload_digest,
    payload_bytes`` and, on demand, ``payload`` (null for a revisit).  Digest and length of a response are
    taken from the bytes read and must agree with its header."""
    total = selected.agg(F.sum("length")).first()[0] or 0
    ordered = (selected.select("file", "offset", "length", "page_id", "url")
               .repartitionByRange(int(total // READ_TASK) + 1, "file", "offset").sortWithinPartitions("file", "offset"))
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    names = ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"]

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = filesystem(folder)
        for batch in batches:
            ids, urls = batch.column("page_id").to_pylist(), batch.column("url").to_pylist()
            items = list(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))))
            for file, start, end, first, last in merged_ranges(items):
                with store.open_input_file(f"{base}/{file}") as f:
                    f.seek(start)
                    data = f.read(end - start)
                rows = []
                for i in range(first, last):
                    at = items[i][1] - start
                    fields, payload = parse_record(zlib.decompress(data[at: at + items[i][2]], 31))
                    if ids[i] is not None and fields["WARC-Record-ID"] != f"<urn:page:{ids[i]}>":
                        raise ValueError(f"{file} at {items[i][1]} holds {fields['WARC-Record-ID']}, not page {ids[i]}")
                    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    size, refers = int(fields["X-Payload-Length"]), None
                    if kind == "revisit":
                        refers, payload = int(fields["WARC-Refers-To"][len("<urn:page:"):-1]), None
                    elif (hashlib.sha256(payload).hexdigest(), len(payload)) != (digest, size):
                        raise ValueError(f"{file} at {items[i][1]}: the payload does not match its header")
                    rows.append((ids[i], urls[i], kind, refers, digest, size, payload if with_payload else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    out = ordered.mapInArrow(fetch, "page_id long, url string, record_type string, refers_to long, "
                                    "payload_digest string, payload_bytes long, payload binary")
    return out if with_payload else out.drop("payload")


def op2_warc_index_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_path(spark, "warc")
    index = write_archives(read(spark, sf_dir, "pages"), folder)
    return read_records(index, folder, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = """
WITH p AS (
  SELECT page_id, sha256(coalesce(html, '')) AS payload_digest, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes
  FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id IS DISTINCT FROM first_id AND first_id IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM f
"""
