"""Batch = stream for whole-file ingest; late rows dropped past the watermark."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from nestwork.operators import flatten as fl
from nestwork.sources.files import read_whole_files, stream_whole_files
from nestwork.sources.sinks import stream_to_table
from nestwork.streaming.windows import tumbling_counts

DOC = {"reporting_entity_name": "E{}", "reporting_entity_type": "T",
       "reporting_structure": [{"in_network_files": [{"description": "d", "location": "https://x/{}"}]}]}


def _write_docs(folder, n, start=0):
    os.makedirs(folder, exist_ok=True)
    for i in range(start, start + n):
        text = json.dumps(DOC, indent=2).replace("{}", str(i))  # pretty-printed: one document per file
        with open(os.path.join(folder, f"index_{i}.json"), "w") as f:
            f.write(text)


def test_whole_file_stream_equals_batch(spark, scratch):
    landing = scratch + "/landing"
    _write_docs(landing, 5)
    batch = fl.flatten_index(read_whole_files(spark, landing))
    stream = fl.flatten_index(stream_whole_files(spark, landing, max_files_per_trigger=1))
    stream_to_table(stream, scratch + "/out", scratch + "/ckpt")
    got = spark.read.parquet(scratch + "/out")
    cols = ["index_file_source_id", "reporting_entity_name", "file_location"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, batch.select(cols).collect()))
    assert got.count() == 5
    # a second run picks up only the new file
    _write_docs(landing, 1, start=5)
    stream2 = fl.flatten_index(stream_whole_files(spark, landing, max_files_per_trigger=1))
    stream_to_table(stream2, scratch + "/out", scratch + "/ckpt")
    assert spark.read.parquet(scratch + "/out").count() == 6


def test_late_rows_are_dropped_and_counted(spark, scratch):
    schema = "ts timestamp_ntz, k string"
    landing = scratch + "/events"
    spark.createDataFrame([(dt.datetime(2024, 1, 10), "a"), (dt.datetime(2024, 1, 10, 5), "a")], schema) \
        .write.parquet(landing + "/p1")
    src = spark.readStream.schema(schema).parquet(landing + "/*")
    agg = tumbling_counts(src, "ts", "1 day", "2 hours", ["k"])
    q = (agg.writeStream.outputMode("update").format("parquet") if False else
         agg.writeStream.outputMode("update").foreachBatch(lambda d, b: d.write.mode("append").parquet(scratch + "/w"))
         .option("checkpointLocation", scratch + "/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    spark.createDataFrame([(dt.datetime(2024, 1, 2), "a")], schema).write.parquet(landing + "/p2")  # late
    src2 = spark.readStream.schema(schema).parquet(landing + "/*")
    q2 = (tumbling_counts(src2, "ts", "1 day", "2 hours", ["k"]).writeStream.outputMode("update")
          .foreachBatch(lambda d, b: d.write.mode("append").parquet(scratch + "/w"))
          .option("checkpointLocation", scratch + "/ck").trigger(availableNow=True).start())
    q2.awaitTermination()
    dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0) for p in q2.recentProgress
                  if p.get("stateOperators"))
    assert dropped == 1
    days = {r.window_start.day for r in spark.read.parquet(scratch + "/w").collect()}
    assert days == {10}


def test_stream_json_gz_multiline_with_corrupt_file(spark, scratch):
    """Pretty-printed .json.gz documents streamed with the declared
    schema; a broken file is kept in the corrupt-record column, not lost."""
    import gzip

    from nestwork.sources.files import stream_json
    from nestwork.sources.schemas import RATES_SCHEMA

    landing = scratch + "/rates"
    os.makedirs(landing)
    doc = {"reporting_entity_name": "e", "in_network": [{"billing_code": "1", "negotiated_rates": []}]}
    with gzip.open(f"{landing}/a.json.gz", "wt") as f:
        f.write(json.dumps(doc, indent=2))
    with gzip.open(f"{landing}/b.json.gz", "wt") as f:
        f.write('{"reporting_entity_name": "x", "in_network": [')
    s = stream_json(spark, landing, RATES_SCHEMA, multi_line=True, max_files_per_trigger=1)
    stream_to_table(s.select("reporting_entity_name", "_corrupt_record",
                             F.col("file_metadata.file_name").alias("f")), scratch + "/out", scratch + "/ck")
    got = {r.f: (r.reporting_entity_name, r._corrupt_record is not None) for r in spark.read.parquet(scratch + "/out").collect()}
    assert got == {"a.json.gz": ("e", False), "b.json.gz": (None, True)}


def test_clean_source_archives_processed_files(spark, scratch):
    """S3: after a committed batch the processed files move to the archive folder."""
    landing = scratch + "/land"
    _write_docs(landing, 3)
    s = fl.flatten_index(stream_whole_files(spark, landing, max_files_per_trigger=1, clean_source="archive",
                                            archive_dir=scratch + "/archive"))
    # the files of a batch are cleaned when a later batch runs, so the last one stays
    stream_to_table(s, scratch + "/out", scratch + "/ck")
    assert spark.read.parquet(scratch + "/out").count() == 3
    import time
    for _ in range(20):  # the cleaner runs on its own thread after the commit
        archived = [f for _, _, fs in os.walk(scratch + "/archive") for f in fs if f.endswith(".json")]
        if archived:
            break
        time.sleep(0.5)
    assert len(archived) >= 1
    assert len([f for f in os.listdir(landing) if f.endswith(".json")]) + len(archived) == 3


def _scd1_target(spark, root, n_buckets=4):
    from nestwork.streaming.scd1 import Scd1Target

    return Scd1Target(spark, root, ["k"], ["s"], columns=["k", "s", "v", "_change_type"], n_buckets=n_buckets)


def _changes(spark, *rows):
    return spark.createDataFrame(list(rows), "k int, s int, v string, _change_type string")


def test_late_row_stays_below_an_earlier_truncate(spark, scratch):
    target = _scd1_target(spark, scratch)
    target.apply_batch(_changes(spark, (1, 1, "a", "insert"), (2, 6, "b", "insert")), 0)
    target.apply_batch(_changes(spark, (None, 5, None, "truncate")), 1)
    target.apply_batch(_changes(spark, (1, 3, "late", "update_postimage"), (3, 4, "late", "insert"), (4, 7, "d", "insert")), 2)
    target.apply_batch(_changes(spark, (1, 3, "late", "update_postimage"), (3, 4, "late", "insert"), (4, 7, "d", "insert")), 2)  # replay
    target.apply_batch(_changes(spark, (5, 2, "late", "insert")), 3)
    assert sorted((r["k"], r["v"]) for r in target.current().collect()) == [(2, "b"), (4, "d")]


def test_batches_write_deltas_and_compact(spark, scratch):
    """A batch writes its own rows only; a full bucket is compacted; retired versions change nothing."""
    import random

    rng = random.Random(4)
    target = _scd1_target(spark, scratch, n_buckets=2)
    target.max_deltas = 2
    state, seqs = {}, list(range(200))
    rng.shuffle(seqs)
    for b in range(9):
        rows = [(rng.randrange(12), seqs.pop(), f"{b}", rng.choice(["insert", "update_postimage", "delete", None])) for _ in range(6)]
        for k, s, v, t in rows:
            if k not in state or state[k][0] < s:
                state[k] = (s, v, t)
        target.apply_batch(_changes(spark, *rows), b)
        if b == 4:
            target.apply_batch(_changes(spark, *rows), b)  # a replay
        written = spark.read.parquet(f"{scratch}/data/_version={b}").count()
        full = {k for k, (base, _) in target._pointer_at(b).buckets.items() if base == b}
        assert full or written <= len({r[0] for r in rows})
        want = sorted((k, v) for k, (_, v, t) in state.items() if t != "delete")
        assert sorted((r["k"], r["v"]) for r in target.current().collect()) == want
    pointer = target._latest_pointer(None)
    assert any(base is not None for base, _ in pointer.buckets.values())
    assert all(len(deltas) <= target.max_deltas for _, deltas in pointer.buckets.values())
    gone = target.retire(keep=1)
    assert gone and not any(os.path.exists(f"{scratch}/data/_version={v}") for v in gone)
    assert sorted((r["k"], r["v"]) for r in target.current().collect()) == want
    target.apply_batch(_changes(spark, (99, 1000, "new", "insert")), 9)
    assert (99, "new") in {(r["k"], r["v"]) for r in target.current().collect()}


def test_another_bucket_count_is_refused(spark, scratch):
    import pytest

    _scd1_target(spark, scratch).apply_batch(_changes(spark, (1, 1, "a", "insert")), 0)
    with pytest.raises(ValueError, match="4 buckets"):
        _scd1_target(spark, scratch, 7).apply_batch(_changes(spark, (2, 1, "a", "insert")), 1)
    with pytest.raises(ValueError, match="4 buckets"):
        _scd1_target(spark, scratch, 7).current()


def test_a_failing_pointer_read_is_raised(spark, scratch):
    import pytest
    from pyspark.errors import AnalysisException

    target = _scd1_target(spark, scratch)
    target.apply_batch(_changes(spark, (1, 1, "a", "insert")), 0)

    class Broken:
        class read:
            @staticmethod
            def parquet(path):
                raise AnalysisException("storage is away", errorClass="CANNOT_READ_FILE_FOOTER", messageParameters={})

    target.spark = Broken
    with pytest.raises(Exception):
        target._pointer_at(0)


def test_index_changes_flatten_the_documents_once(spark):
    """All changes of a row come from one scan of the bronze table."""
    from nestwork.plans.stream_plans import index_changes

    log = index_changes(spark, "/root/testdata/sf0.001")
    plan = log._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    kinds = {r["arrives"]: r["count"] for r in log.groupBy("arrives").count().collect()}
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").where("o_orderstatus = 'F'")
    assert kinds == {0: orders.count(), 1: orders.where("o_orderkey % 3 = 0").count(), 2: orders.where("o_orderkey % 7 = 0").count(),
                     3: orders.where("o_orderkey % 5 = 0").count()}


def test_a_pivot_stream_spreads_its_rows_before_it_sorts_them(spark, monkeypatch):
    """The tasks that sort a micro-batch, and the buckets of the target, grow with the orders."""
    from nestwork.plans import stream_plans
    from nestwork.sources import tables
    from nestwork.streaming.scd1 import Scd1Target

    made = []
    init = Scd1Target.__init__
    monkeypatch.setattr(Scd1Target, "__init__", lambda self, *a, **k: (made.append(k["n_buckets"]), init(self, *a, **k))[1])
    monkeypatch.setattr(stream_plans, "ROWS_PER_BUCKET", 100)
    monkeypatch.setattr(tables, "ROWS_PER_TASK", 300)
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    out = stream_plans.q_stream_pivot(spark, "/root/testdata/sf0.001")
    assert made == [-(-orders.count() // 100)] and out.count() == orders.count()
