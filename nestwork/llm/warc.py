"""WARC archives (operator 5): a writer and a splittable reader.

The writer puts each page in a gzip member of its own, one file for each task.  Pages whose
payloads are equal are written once: the page with the largest id is the response, the others
become revisit records that refer to it.  Only digests are grouped.  The table of repeated digests is
broadcast while it is below Spark's threshold, and no payload moves; beyond it, each payload is shuffled once to meet
its digest.  A file has a fresh name for each attempt, and only files
named in the rows that a successful task returns belong to the archive, so lost executors and
retries leave no double records.

The reader takes WARC/1.0 and 1.1 with records of any type; a record-id that is none of the writer's gives no page_id, and
a payload without a length or digest in its header is measured.  It cuts files into byte ranges and deals them out evenly to a set number of tasks.  A task scans its range for gzip's magic, takes a
candidate for a member only if its first bytes decode to a WARC header, and owns the records
that start inside the range; it reads past the range's end to finish the last one.

Files are opened by ``pyarrow.fs`` from the folder's URI, so the archive can be in any store
that it knows; the folder must be one that all executors share.

Defined cases: a null html is an empty payload; a null url has no target URI; a null page_id
reads back as null and ranks below all others; rows that repeat page_id and payload are alike
(all of them responses, or all revisits); an empty table gives no files and no records; extra
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestwork.session import scratch_path

from .common import small_batches, text_of, written

MAGIC = b"\x1f\x8b\x08"
VERSION, ANY_VERSION = b"WARC/1.1\r\n", b"WARC/1."
#: Bytes of one reading range, and of one read.
RANGE, READ = 8 << 20, 1 << 20
#: Most reading tasks for each core; each takes its share of the ranges.
TASKS = 32
#: Payloads of fewer bytes are never looked up for equals.
MIN_PAYLOAD = 0
# Fixed value: the profile of a revisit with an equal payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _open_folder(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if re.match(r"[a-z][a-z0-9+.-]*:", uri) else f"file://{uri}")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as a gzip member.  A revisit keeps the HTTP header, whose length tells the payload's."""
    kind = "response" if refers_to is None else "revisit"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + (payload if refers_to is None else b"")
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>",
             "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="%/:=&?~#+!$,;'@()*[]"))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress(VERSION + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def _writer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open_folder(folder)
        path = f"{root}/{uuid.uuid4().hex}.warc.gz"
        out, n = None, 0
        for batch in batches:
            for page, url, html, sha, ref in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    out = fs.open_output_stream(path, compression=None)  # members are packed already
                out.write(record(page, url, html, base64.b32encode(bytes.fromhex(sha)).decode(), ref))
                n += 1
        if out is not None:
            out.close()
            size = fs.get_file_info(path).size
            yield pa.RecordBatch.from_arrays(
                [pa.array([path.rsplit("/", 1)[1]]), pa.array([size], pa.int64()), pa.array([n], pa.int64())],
                names=["file", "bytes", "records"])

    return run


def write_archive(pages: DataFrame, folder: str, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """Write the pages; returns the archive's files: (file, bytes, records)."""
    small_batches(pages.sparkSession)
    rows = pages.select("page_id", "url", text_of("html").cast("binary").alias("html"))
    rows = rows.withColumn("sha", F.sha1("html"))
    equal = (rows.where(F.octet_length("html") >= min_payload).groupBy("sha")
             .agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1").select("sha", "last"))
    # a written table: its known size decides whether the planner broadcasts it
    joined = rows.join(written(equal, "warc-equal"), "sha", "left")
    refers = F.when(F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    out = joined.select("page_id", "url", "html", "sha", refers.alias("refers_to"))
    return written(out.mapInArrow(_writer(folder), "file string, bytes long, records long"), "warc-files")


class _Window:
    """Bytes of a file from a position on, read piece by piece."""

    def __init__(self, file, at: int, size: int):
        self.file, self.at, self.size, self.data = file, at, size, bytearray()

    def more(self) -> bool:
        here = self.at + len(self.data)
        if here >= self.size:
            return False
        self.file.seek(here)
        self.data += self.file.read(min(READ, self.size - here))
        return True

    def skip(self, n: int) -> None:
        del self.data[:n]  # moves the start, not the bytes
        self.at += n


def _member(window: _Window) -> tuple[bytes, int] | None:
    """The member at the window's start: (its bytes, its packed length), or None if it is no WARC record."""
    unpack = zlib.decompressobj(31)
    out, fed = bytearray(), 0
    while not unpack.eof:
        if fed == len(window.data) and not window.more():
            return None
        try:
            out += unpack.decompress(window.data[fed:fed + READ])
        except zlib.error:
            return None
        fed = min(len(window.data), fed + READ)
        if out[:len(ANY_VERSION)] != ANY_VERSION[:len(out)]:
            return None
    return (bytes(out), fed - len(unpack.unused_data)) if out.startswith(ANY_VERSION) else None


def records_in(file, size: int, start: int, end: int) -> Iterator[bytes]:
    """The unpacked records whose members start in [start, end)."""
    window = _Window(file, start, size)
    found = False
    while window.at < end:
        if not found:  # somewhere inside another member: look for the next candidate
            at = window.data.find(MAGIC)
            if at < 0:
                window.skip(max(0, len(window.data) - len(MAGIC) + 1))
                if not window.more():
                    return
                continue
            window.skip(at)
            if window.at >= end:
                return
        member = _member(window)
        if member is None:
            if found and window.at < size:
                raise ValueError(f"no WARC record at byte {window.at}")
            if window.at >= size:
                return
            window.skip(1)
            continue
        found = True  # from here on members follow each other
        yield member[0]
        window.skip(member[1])


def parse_record(raw: bytes) -> tuple[int | None, int, str, str, int | None, str | None, bytes]:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload)."""
    head, _, block = raw.partition(b"\r\n\r\n")
    fields = {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])}
    kind = fields.get("warc-type", "")
    block = block[:int(fields.get("content-length", len(block)))]
    payload, length = block, len(block)
    if fields.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        told = re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)
        length = int(told[1]) if told else len(payload)

    def page(name: str) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(name, ""))
        return int(found[1]) if found else None

    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or payload_digest(payload)
    if page("warc-record-id") is not None and kind == "response" and (len(payload) != length or payload_digest(payload) != digest):
        raise ValueError("the payload does not match its header")
    return page("warc-record-id"), length, digest, kind, page("warc-refers-to"), fields.get("warc-target-uri"), payload


def _reader(folder: str, payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open_folder(folder)
        for batch in batches:
            for name, size, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                with fs.open_input_file(f"{root}/{name}") as file:
                    part, held = [], 0
                    for raw in records_in(file, size, start, end):
                        part.append(parse_record(raw))
                        held += len(raw)
                        if held > READ or len(part) >= 1000:
                            yield _batch(part, payloads)
                            part, held = [], 0
                    if part:
                        yield _batch(part, payloads)

    return run


_TYPES = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
          ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())]


def _batch(part: list[tuple], payloads: bool) -> pa.RecordBatch:
    kept = _TYPES if payloads else _TYPES[:-1]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in part], t) for i, (_, t) in enumerate(kept)], names=[n for n, _ in kept])


def read_archive(files: DataFrame, folder: str, payloads: bool = False, range_bytes: int = RANGE) -> DataFrame:
    """All records of the archive's files, read by byte ranges; ``payloads`` adds the responses' bodies."""
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long")))
    ranges = files.select("file", "bytes", starts.alias("start")).withColumn("end", F.col("start") + range_bytes)
    schema = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
              + ", payload binary" * payloads)
    # a set number of tasks, which adaptive execution leaves alone: the rows are tiny, what they stand for is not
    some = ranges.agg(F.count(F.lit(1))).first()[0]
    tasks = max(1, min(some, TASKS * files.sparkSession.sparkContext.defaultParallelism))
    return ranges.repartition(tasks).mapInArrow(_reader(folder, payloads), schema)


def warc_table(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write all pages, read the archive back and return the contract's columns."""
    folder = scratch_path(spark, "warc")
    fs, root = _open_folder(folder)
    fs.create_dir(root)
    files = write_archive(pages, folder)
    return read_archive(files, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: DuckDB's view of the same rows (it has no base32: five bytes are eight letters, spelt out from the hex digest).
ORACLE = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (
  SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS hex FROM p),
e AS (
  SELECT *, max(page_id) OVER (PARTITION BY hex) AS last FROM d)
SELECT page_id, payload_bytes,
       (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
          1 + ((('0x' || substr(hex, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INTEGER, 1), '' ORDER BY i)
        FROM range(32) AS r(i)) AS payload_digest,
       CASE WHEN last <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN last <> page_id THEN last END AS refers_to
FROM e
"""
