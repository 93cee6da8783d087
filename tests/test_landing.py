"""What queries land and write takes little disk and no file more than it needs, and every row comes back."""

import os
import time

import pytest
from pyspark.sql import functions as F

from nestwork.plans import sink_plans, stream_plans
from nestwork.sources import bronze
from nestwork.sources.files import stream_lines
from nestwork.sources.sinks import write_document_files


@pytest.fixture
def sf(spark, scratch, monkeypatch):
    """Own tables: 12 customers of two orders of three lines each; the queries' folders are ``scratch``/out-name."""
    monkeypatch.setattr(bronze, "_WRITTEN", {})
    for module in (sink_plans, stream_plans):
        monkeypatch.setattr(module, "scratch_path", lambda spark, name: f"{scratch}/out-{name}")
    n = spark.range(12)
    tables = {
        "customer": n.selectExpr("id AS c_custkey", "concat('c', id) AS c_name", "'s' AS c_mktsegment"),
        "orders": spark.range(24).selectExpr("id AS o_orderkey", "id % 12 AS o_custkey", "'F' AS o_orderstatus", "'1-URGENT' AS o_orderpriority"),
        "lineitem": spark.range(72).selectExpr(
            "id % 24 AS l_orderkey", "id % 40 AS l_partkey", "id % 5 AS l_suppkey", "CAST(id / 24 AS INT) + 1 AS l_linenumber", "2.0D AS l_quantity",
            "id + 0.5D AS l_extendedprice", "'R' AS l_returnflag", "DATE'2020-01-01' AS l_shipdate"),
        "part": spark.range(40).selectExpr("id AS p_partkey", "concat('p', id) AS p_name", "'b' AS p_brand", "'t' AS p_type", "1 AS p_size"),
        "pages": spark.range(3).selectExpr("id AS page_id", "'u' AS url", "concat('<p>', id, '\n</p>') AS html"),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{scratch}/sf/{name}.parquet")
    return f"{scratch}/sf"


def _files(folder):
    return [f for _, _, names in os.walk(folder.removeprefix("file:")) for f in names]


def _codecs(folder):
    import pyarrow.parquet as pq

    found = set()
    for top, _, names in os.walk(folder.removeprefix("file:")):
        for f in (f for f in names if f.endswith(".parquet")):
            groups = pq.ParquetFile(f"{top}/{f}").metadata
            found |= {groups.row_group(g).column(0).compression for g in range(groups.num_row_groups)}
    return found


def test_one_document_files_come_without_checksum_files(spark, scratch):
    write_document_files(spark.range(20).selectExpr("CAST(id AS STRING) AS value"), scratch, "value", 4)
    parts = [f for f in _files(scratch) if "part-" in f]
    assert len(parts) == 20 and not any(f.endswith(".crc") for f in parts)
    assert sorted(int(r.value) for r in spark.read.text(scratch).collect()) == list(range(20))


def test_whole_files_are_written_by_many_tasks_and_streamed_by_few(spark, scratch, sf):
    out = stream_plans.q_stream_whole_files(spark, sf)
    landed = [f for f in _files(f"{scratch}/out-stream_whole_files/landing") if "part-" in f]
    assert len(landed) == 12 and all(f.endswith(".txt.gz") for f in landed) and len({f[:10] for f in landed}) > 1
    written = [f for f in _files(f"{scratch}/out-stream_whole_files/in_network") if f.startswith("part-")]
    assert len(written) <= 4 * spark.sparkContext.defaultParallelism and _codecs(f"{scratch}/out-stream_whole_files/in_network") == {"ZSTD"}
    rows = out.collect()
    assert len(rows) == 72 and {r.reporting_entity_name for r in rows} == {f"c{i}" for i in range(12)}


def test_stream_flatten_lands_and_writes_little(spark, scratch, sf):
    """Gzipped lines, keys in zstd, and the list of landed files is stored, so that its size tells how it joins."""
    out = stream_plans.q_stream_flatten(spark, sf)
    landed = [f for f in _files(f"{scratch}/out-stream_flatten/landing") if f.startswith("part-")]
    assert landed and all(f.endswith(".txt.gz") for f in landed)
    assert _codecs(f"{scratch}/out-stream_flatten/in_network") == {"ZSTD"}
    assert any("/landed/" in f for f in out.inputFiles()) and not any("/landing/" in f for f in out.inputFiles())
    rows = out.collect()
    assert len(rows) == 72 and all(r.source_known and r.key_holds for r in rows)


def test_rate_lines_and_their_stream_are_compressed(spark, scratch, sf):
    assert stream_plans.q_stream_rates(spark, sf).count() == 56  # lines of parts whose number modulo 20 is not 1 to 4
    landed = [f for f in _files(f"{scratch}/out-stream_rates/landing") if f.startswith("part-")]
    assert landed and {f.rsplit(".", 1)[1] for f in landed} <= {"gz", "lz4"}
    assert _codecs(f"{scratch}/out-stream_rates/rates") == {"ZSTD"}
    bad = stream_plans.rescue.split_table(spark, f"{scratch}/out-stream_rates/rates", spark.read.parquet(
        f"{scratch}/out-stream_rates/rates/batch=0").drop("status").schema, "quarantine")
    assert bad.count() == 8 + 3


def test_rates_quarantine_holds_every_fault(spark, scratch, sf):
    rows = stream_plans.q_rates_quarantine(spark, sf).collect()
    assert len(rows) == 8 + 3 and _codecs(f"{scratch}/out-stream_rates/rates") == {"ZSTD"}
    assert sorted(r.rescued_path or "" for r in rows) == [""] * 5 + sorted(
        2 * ["$.vendor_note", "$.in_network[0].surcharge", "$.in_network[0].negotiated_rates[0].negotiated_prices[0].negotiated_rate"])


def test_lines_that_were_streamed_can_be_deleted(spark, scratch):
    spark.range(0, 30, 1, 3).selectExpr("CAST(id AS STRING) AS value").write.text(f"{scratch}/landing")
    src = stream_lines(spark, f"{scratch}/landing", max_files_per_trigger=1, clean_source="delete")
    q = (src.select("value").writeStream.format("parquet").option("checkpointLocation", f"{scratch}/ck")
         .trigger(availableNow=True).start(f"{scratch}/out"))
    q.awaitTermination()
    assert spark.read.parquet(f"{scratch}/out").count() == 30
    assert len([f for f in _files(f"{scratch}/landing") if f.startswith("part-")]) <= 1  # the last batch's file may stay


def test_bronze_tables_leave_no_shuffle_files(spark, monkeypatch, sf):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    shuffled = lambda: {f for d in folders for f in _files(d.getPath()) if f.startswith("shuffle_") and f.endswith(".data")}
    before = shuffled()
    rates, index = bronze.rates_bronze_table(spark, sf), bronze.index_bronze_table(spark, sf)
    for _ in range(50):  # executors delete them in the background
        if not shuffled() - before:
            break
        time.sleep(0.2)
    assert not shuffled() - before
    assert rates.count() == 40 and index.count() == 12


def test_chunk_files_are_gzipped_and_listed_whole(spark, scratch, sf):
    rows = sink_plans.q_chunk_sink(spark, sf).collect()
    names = [f for f in _files(f"{scratch}/out-chunk_sink/in_network") if "part-" in f]
    assert len(rows) == 72 and names and all(f.startswith("part-") and f.endswith(".json.gz") for f in names)


def test_manifest_counts_gzipped_chunks(spark, scratch, sf):
    assert sink_plans.q_manifest(spark, sf).first().asDict() == {"n_rows": 72, "n_too_long": 0, "n_empty": 0, "n_not_json": 0}
    assert all(f.endswith(".json.gz") for f in _files(f"{scratch}/out-chunk_sink/in_network") if "part-" in f)


def test_rate_lines_move_once(spark, sf):
    """Neither the counts of their parts nor the parts' names make the lines move again before they are grouped."""
    from nestwork.sources.rates_docs import rates_documents

    plan = rates_documents(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(l_partkey") == 1
