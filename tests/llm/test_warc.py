"""WARC: records read back by ranges of any size; equal payloads become revisits."""

import gzip
import io
import os

import pytest

from nestwork.llm import warc
from nestwork.session import scratch_path


def test_ranges_share_out_all_records():
    inner = warc.record(1, "u", b"inner", warc.payload_digest(b"inner"), None)
    bodies = [f"hé {i} ".encode() * (i * 37 % 900) for i in range(60)] + [os.urandom(2_500_000), b"", warc.MAGIC * 900, b"x" * 3_000_000]
    raw = [warc.record(i, f"http://x/{i}", b, warc.payload_digest(b), None) for i, b in enumerate(bodies)]
    raw.append(warc.record(99, None, b"", warc.payload_digest(b""), 5))
    data = b"".join(raw)
    assert inner not in data
    for step in (len(data), 1 << 20, 77_777, 1000):
        got = [warc.parse_record(r) for a in range(0, len(data), step) for r in warc.records_in(io.BytesIO(data), len(data), a, a + step)]
        assert [(g[0], g[6]) for g in got] == [*enumerate(bodies), (99, b"")]
    assert got[-1][3:5] == ("revisit", 5)


def brute(rows):
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        last = max(same, default=None)
        ref = last if last is not None and page != last else None
        out.append((page, len(body), warc.payload_digest(body), "response" if ref is None else "revisit", ref))
    return sorted(map(repr, out))


@pytest.mark.parametrize("range_bytes", [300, 1 << 20])
def test_table(spark, range_bytes):
    rows = [(i, f"http://h{i}/é ?q=\r\nX: y", f"<p>{'é' * (i % 50)}</p>") for i in range(150)]
    rows += [(200, None, None), (201, "", ""), (202, "u", ""), (203, "u", "z" * 400_000), (None, "u", "null id"), (None, "u", "<p></p>")]
    rows += [(204, "u", "same row")] * 2 + [(300 + i, "u", "hot") for i in range(80)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    from pyspark.sql import functions as F

    pages = pages.withColumn("sha", F.lit(1)).withColumn("last", F.lit(2)).withColumn("file", F.lit("f"))
    folder = scratch_path(spark, "warc-test")
    fs, root = warc._open_folder(folder)
    fs.create_dir(root)
    files = warc.write_archive(pages, folder)
    out = warc.read_archive(files, folder, payloads=True, range_bytes=range_bytes).collect()
    assert sorted(repr(tuple(r)[:5]) for r in out) == brute(rows)
    bodies = {(p, h or "") for p, _, h in rows}
    assert all((r["page_id"], bytes(r["payload"]).decode()) in bodies for r in out if r["record_type"] == "response")


def test_many_ranges_are_read_by_many_tasks(spark):
    from pyspark.sql import functions as F

    pages = spark.createDataFrame([(i, "u", f"{i} " + os.urandom(400).hex()) for i in range(200)], "page_id long, url string, html string")
    folder = scratch_path(spark, "warc-test")
    fs, root = warc._open_folder(folder)
    fs.create_dir(root)
    files = warc.write_archive(pages.coalesce(1), folder)
    back = warc.read_archive(files, folder, range_bytes=2000).select("page_id", F.spark_partition_id().alias("task")).collect()
    assert sorted(r["page_id"] for r in back) == list(range(200))
    assert len({r["task"] for r in back}) >= 20


def test_other_writers_records():
    def member(lines, block, version="WARC/1.0"):
        raw = "\r\n".join([version, *lines, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
        return gzip.compress(raw)

    http = b"HTTP/1.0 200 OK\r\nServer: x\r\n\r\n<p>no length</p>"
    data = b"".join([
        member(["WARC-Type: warcinfo", "WARC-Record-ID: <urn:uuid:1>", "Content-Type: application/warc-fields"], b"software: x\r\n"),
        member(["WARC-Type:response", "warc-target-uri: http://a/", "WARC-Record-ID: <urn:uuid:2>", "Content-Type: application/http;msgtype=response"], http),
        warc.record(7, "u", b"own", warc.payload_digest(b"own"), None),
        member(["WARC-Type: revisit", "WARC-Record-ID: <urn:uuid:3>", "WARC-Refers-To: <urn:uuid:2>"], b""),
        member(["WARC-Type: metadata"], b"k: v", "WARC/1.1")])
    for step in (len(data), 50):
        got = [warc.parse_record(r) for a in range(0, len(data), step) for r in warc.records_in(io.BytesIO(data), len(data), a, a + step)]
        assert [(g[0], g[3], g[5]) for g in got] == [(None, "warcinfo", None), (None, "response", "http://a/"), (7, "response", "u"),
                                                      (None, "revisit", None), (None, "metadata", None)]
        assert (got[1][1], got[1][6], got[1][2]) == (16, b"<p>no length</p>", warc.payload_digest(b"<p>no length</p>"))


def test_empty_table(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.warc_table(spark, empty).count() == 0
