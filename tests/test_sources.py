"""Config-driven ingest, catalog statements, table streams, readers."""

import json
import os

import pytest
from pyspark.sql import functions as F

from nestwork.sources import catalog
from nestwork.sources.config import ingest_definitions, load_definitions
from nestwork.sources.files import list_files, read_json, read_lines


def test_config_driven_ingest(spark, scratch):
    cfg = scratch + "/config"
    os.makedirs(cfg)
    good = {"file_type": "index_json", "file_desc": "index", "file_extention": "json", "cleanSource": "OFF",
            "cleanSource_retentionDuration": "7 days", "volume_sub_path": "index", "maxFilesPerTrigger": 100}
    bad = dict(good, file_type="in_network_json", volume_sub_path=" ")
    for n, d in (("index_json_import.json", good), ("in_network_json_import.json", bad)):
        with open(f"{cfg}/{n}", "w") as f:
            json.dump(d, f, indent=2)
    os.makedirs(scratch + "/landing/index")
    for i in range(3):
        with open(f"{scratch}/landing/index/f{i}.json", "w") as f:
            f.write(json.dumps({"reporting_structure": []}, indent=1))
    defs = load_definitions(spark, cfg)
    assert sorted((r.file_type, r.valid) for r in defs.collect()) == [("in_network_json", False), ("index_json", True)]
    with pytest.raises(ValueError, match="in_network_json"):
        ingest_definitions(spark, defs, scratch + "/landing", scratch + "/refused")
    assert not os.path.exists(scratch + "/refused")  # an invalid definition stops the run before any stream starts
    started = ingest_definitions(spark, defs.where("valid"), scratch + "/landing", scratch + "/bronze")
    assert list(started) == ["index_json_bronze"]
    out = spark.read.parquet(scratch + "/bronze/index_json_bronze")
    assert out.count() == 3 and out.select("index_file_source_id").distinct().count() == 3
    only_index = load_definitions(spark, cfg, prefix="index")
    assert only_index.count() == 1


def test_catalog_table_round_trip_and_stream(spark, scratch):
    name = "nestwork_test_results"
    catalog.drop_table_if_exists(spark, name)
    df = spark.createDataFrame([("a", True)], "file_path string, success boolean")
    catalog.save_table(df, name, scratch + "/t")
    catalog.save_table(df, name, scratch + "/t")
    assert catalog.read_table(spark, name).count() == 2
    catalog.analyze(spark, name)
    assert catalog.current_namespace(spark)[1] == "default"
    s = catalog.stream_table(spark, name)
    q = s.writeStream.format("parquet").option("checkpointLocation", scratch + "/ck").trigger(availableNow=True) \
        .start(scratch + "/copy")
    q.awaitTermination()
    assert spark.read.parquet(scratch + "/copy").count() == 2
    catalog.drop_table_if_exists(spark, name)


def test_readers(spark, scratch):
    os.makedirs(scratch + "/j")
    with open(scratch + "/j/a.json", "w") as f:
        f.write('{"a": 1}\n{"a": 2}\nnot json\n')
    with open(scratch + "/j/b.json", "w") as f:
        f.write(json.dumps({"a": {"b": [1, 2]}}, indent=2))
    lines = read_json(spark, scratch + "/j/a.json", schema=spark.createDataFrame([], "a long").schema)
    got = {(r.a, r._corrupt_record) for r in lines.collect()}
    assert got == {(None, "not json"), (1, None), (2, None)}
    multi = read_json(spark, scratch + "/j/b.json", multi_line=True)
    assert multi.first().a.b == [1, 2]
    assert read_lines(spark, scratch + "/j/a.json").count() == 3
    listing = list_files(spark, scratch + "/j", glob="*.json")
    assert sorted(os.path.basename(r.path) for r in listing.collect()) == ["a.json", "b.json"]
    assert listing.where(F.col("length") > 0).count() == 2


def test_json_chunks_cap_rows_per_file(spark, scratch):
    """K4/K6: at most n rows per JSON file, 2,500 rows at 1,000 give 3+ files."""
    from nestwork.sources.sinks import write_json_chunks

    df = spark.range(2500).withColumn("v", F.col("id") * 2)
    write_json_chunks(df, scratch + "/chunks", max_records=1000, partitions=1)
    counts = (spark.read.json(scratch + "/chunks").groupBy(F.input_file_name().alias("f")).count().collect())
    assert sum(r["count"] for r in counts) == 2500
    assert max(r["count"] for r in counts) <= 1000 and len(counts) == 3


def test_one_document_files_are_written_by_many_tasks(spark, scratch):
    import os

    from nestwork.sources.sinks import write_document_files

    texts = spark.range(0, 40, 1, 1).selectExpr("concat('{\"a\":', id, '}') AS value")
    write_document_files(texts, scratch, "value", 4)
    names = [f for f in os.listdir(scratch.removeprefix("file:")) if f.startswith("part-")]
    assert len(names) == 40 and len({n[:10] for n in names}) > 1
    assert sorted(r.value for r in spark.read.text(scratch).collect()) == sorted(r.value for r in texts.collect())


def test_settings_of_a_block_come_back(spark):
    from nestwork.session import with_settings

    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    with with_settings(spark, {key: "7", "nestwork.unset": "x"}):
        assert spark.conf.get(key) == "7"
    assert spark.conf.get(key) == before and spark.conf.get("nestwork.unset", None) is None
