"""Metrics of micro-batches, late rows, declared tables that act, chained tables, all-strings schemas, merged sketches."""

import datetime as dt
import json
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from nestwork.operators import contract as ct
from nestwork.operators import profile as pf
from nestwork.operators import quality as qa
from nestwork.sources import chain as sc
from nestwork.sources.declared import Check, DeclaredColumn, DeclaredTable
from nestwork.sources.files import all_strings, infer_all_strings, stream_all_strings
from nestwork.sources.sinks import stream_to_table
from nestwork.streaming.metrics import run_with_metrics
from nestwork.streaming.windows import closed_windows


def test_observed_failures_of_each_batch(spark, scratch):
    specs = [("t", "kind = 'a'", {"has_x": "x IS NOT NULL", "small": "x < 10"}), ("all", None, {"has_kind": "kind IS NOT NULL"})]
    schema = "kind string, x int"
    for rows in ([("a", 1), ("a", None), ("b", None)], [("a", 50), (None, 2)], [("b", 1)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(scratch + "/in")
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(scratch + "/in")
    writer = (qa.observe_specs(src, "rules", specs).writeStream.format("parquet").option("path", scratch + "/out")
              .option("checkpointLocation", scratch + "/ck").trigger(availableNow=True))
    counts = qa.observed_counts(run_with_metrics(spark, writer, scratch + "/metrics"), specs)
    assert counts.select("batch_id").distinct().count() == 3
    total = {(r["table_name"], r["rule"]): (r["n"], r["f"]) for r in counts.groupBy("table_name", "rule").agg(
        F.sum("n_rows").alias("n"), F.sum("n_failed").alias("f")).collect()}
    assert total == {("t", "has_x"): (3, 1), ("t", "small"): (3, 2), ("all", "has_kind"): (6, 1)}


def test_late_rows_are_dropped_row_by_row_and_counted(spark, scratch):
    """Many late rows of one window and group: the count is of rows, not of partial sums."""
    schema = "event_id long, ts timestamp_ntz, k string"
    day = lambda d, h=0: dt.datetime(2024, 1, d, h)
    parts = [[(1, day(10), "a"), (2, day(10, 5), "a"), (3, day(8), "b")], [(4, day(9), "b")], [(5 + i, day(2), "a") for i in range(40)] + [(90, day(10, 4), "b")],
             [(91, day(20), "a")], [(92, day(20), "a")]]
    for p in parts:
        spark.createDataFrame(p, schema).coalesce(1).write.mode("append").parquet(scratch + "/in")
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(scratch + "/in")
    agg = closed_windows(src, "ts", "1 day", "2 hours", ["k"], ["event_id"])
    writer = (agg.writeStream.format("parquet").outputMode("append").option("path", scratch + "/out")
              .option("checkpointLocation", scratch + "/ck").trigger(availableNow=True))
    metrics = run_with_metrics(spark, writer, scratch + "/metrics")
    by = {r["metric"]: r["n"] for r in metrics.groupBy("metric").agg(F.sum("value").alias("n")).collect()}
    assert by["rows_dropped_by_watermark"] == 40 and by["rows_read"] == 47
    assert metrics.agg(F.count_distinct("watermark")).first()[0] > 2
    got = sorted((r["window_start"].day, r["k"], r["n_events"]) for r in spark.read.parquet(scratch + "/out").collect())
    assert got == [(8, "b", 1), (9, "b", 1), (10, "a", 2), (10, "b", 1)]


TABLE = DeclaredTable([DeclaredColumn("k", "string", not_null="fail"), DeclaredColumn("n", "int", default="7"), DeclaredColumn("s", "string", not_null="drop"),
                       DeclaredColumn("m", "map<string,string>")], [Check("positive", "n > 0")])


def test_declared_table_defaults_and_drops(spark):
    df = spark.createDataFrame([("a", None, "x"), ("b", "-1", "x"), ("c", "2", None)], "k string, n string, s string")
    out = TABLE.rows(df)
    assert out.dtypes == [("k", "string"), ("n", "int"), ("s", "string"), ("m", "map<string,string>")]
    assert sorted(tuple(r)[:3] for r in out.collect()) == [("a", 7, "x"), ("b", -1, "x")]
    broken = TABLE.conform(df).agg(*TABLE.counts()).first().asDict()
    assert broken == {"rows": 3, "broken_k_not_null": 0, "broken_s_not_null": 1, "broken_positive": 1}


def test_null_key_stops_the_batch(spark, scratch):
    schema = "k string, n string, s string"
    for rows in ([("a", "1", "x")], [(None, "1", "x"), ("b", "1", "x")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(scratch + "/in")
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(scratch + "/in")
    with pytest.raises(PySparkException, match="k_not_null"):
        stream_to_table(TABLE.rows(src, observe="t"), scratch + "/out", scratch + "/ck")
    assert [r["k"] for r in spark.read.parquet(scratch + "/out").collect()] == ["a"]  # the batch before is there, nothing of the bad one


def test_chain_order_and_errors(spark, scratch):
    same = lambda d: d
    d = lambda t, **kw: sc.StreamDefinition(t, same, **kw)
    chain = [d("c", source_table="b"), d("b", source_table="a"), d("a", source_folder="x")]
    assert [x.table for x in sc.in_order(chain)] == ["a", "b", "c"]
    for bad in ([d("a", source_table="b"), d("b", source_table="a")], [d("a", source_table="nowhere")], [d("a"), d("b", source_table="a")],
                [d("a", source_folder="x"), d("a", source_folder="y")]):
        with pytest.raises(ValueError):
            sc.in_order(bad)
    os.makedirs(scratch + "/landing")
    chain = [sc.StreamDefinition("lines", lambda f: f.select("value"), source_folder=scratch + "/landing"),
             sc.StreamDefinition("long_ones", lambda f: f.where("length(value) > 2"), source_table="lines")]
    prefix = "chain_" + os.path.basename(scratch).replace("-", "_") + "_"
    for n, want in ((0, {"lines": 2, "long_ones": 2}), (1, {"lines": 2, "long_ones": 2}), (None, {"lines": 0, "long_ones": 0})):
        if n is not None:
            with open(f"{scratch}/landing/{n}.txt", "w") as f:
                f.write(f"{n}\nlong {n}\n")
        assert sc.run_chain(spark, chain, scratch + "/tables", prefix) == want
    assert sorted(r["value"] for r in spark.table(prefix + "long_ones").collect()) == ["long 0", "long 1"]
    for t in ("lines", "long_ones"):
        spark.sql(f"DROP TABLE {prefix}{t}")


def test_all_strings_schema(spark, scratch):
    docs = [{"a b": 1, "x": {"y": 1.5, "z": []}, "e": {}, "n": None, "BIGINT": "t"}, {"x": 7, "k": [{"q": 1}, {"r": "t"}], "BIGINT": True}]
    df = spark.createDataFrame([(json.dumps(d),) for d in docs] + [("<html>",)], "value string")
    schema = infer_all_strings(df)
    assert schema.simpleString() == "struct<BIGINT:string,a b:string,e:string,k:array<struct<q:string,r:string>>,n:string,x:string>"
    assert all_strings("OBJECT<a: ARRAY<DECIMAL(3,1)>, `b: c`: OBJECT<d: DATE>>").simpleString() == "struct<a:array<string>,b: c:struct<d:string>>"
    df.coalesce(1).write.text(scratch + "/in")
    stream_to_table(stream_all_strings(spark, scratch + "/in"), scratch + "/out", scratch + "/ck")
    got = spark.read.parquet(scratch + "/out").orderBy("BIGINT").collect()
    assert [r["x"] for r in got] == [None, '{"y":1.5,"z":[]}', "7"] or {r["x"] for r in got} == {None, '{"y":1.5,"z":[]}', "7"}
    assert [r["_corrupt_record"] for r in got if r["_corrupt_record"]] == ["<html>"]


def test_sketches_merge_within_their_error(spark):
    df = spark.range(60_000).select((F.col("id") % 3).alias("part"), F.col("id"), (F.col("id") % 777).alias("few"),
                                    F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("half"), F.lit(None).cast("date").alias("none"))
    parts = pf.part_profiles(df, ["id", "few", "half", "none"])
    assert parts.count() == 12
    got = {r["column_name"]: r for r in pf.merged_profile(parts).collect()}
    for c, n in (("id", 60_000), ("few", 777), ("half", 30_000), ("none", 0)):
        assert abs(got[c]["approx_distinct"] - n) <= 5 * 1.04 / 2 ** 7 * n
    assert (got["id"]["min_value"], got["id"]["max_value"], got["id"]["n_rows"]) == ("0", "59999", 60_000)
    assert (got["half"]["n_nulls"], got["half"]["max_value"], got["none"]["min_value"]) == (30_000, "9998", None)
    replaced = parts.where("part <> 2").unionByName(pf.part_profiles(df.where("part = 2"), ["id", "few", "half", "none"]))
    assert {r["column_name"]: r["approx_distinct"] for r in pf.merged_profile(replaced).collect()} == {c: r["approx_distinct"] for c, r in got.items()}


def test_type_rules_on_the_untyped_document(spark):
    doc = {"version": 1, "in_network": [{"name": ["n"], "negotiated_rates": [{"provider_references": [1, "2"], "negotiated_prices": [
        {"negotiated_rate": "1.0", "service_code": "11", "billing_code_modifier": ["a", 2]}, 5]}], "bundled_codes": {"a": 1}}, "item"],
        "provider_references": [{"provider_group_id": 1.5, "location": None, "provider_groups": [{"npi": [1, "x"], "tin": {"type": 3}}, {"tin": "t"}]}]}
    df = spark.createDataFrame([("f", json.dumps(doc)), ("g", "{}"), ("h", "<html>")], "file_path string, value string")
    got = sorted((r["rule"], r["path"]) for r in ct.type_audit(df.select("file_path", F.try_parse_json("value").alias("doc"))).collect())
    rate = "$.in_network[0].negotiated_rates[0]"
    assert got == sorted([
        ("root.version.type", "$.version"), ("in_network.name.type", "$.in_network[0].name"), ("in_network.type", "$.in_network[1]"),
        ("in_network.bundled_codes.type", "$.in_network[0].bundled_codes"), ("negotiated_rates.provider_references.type", f"{rate}.provider_references[1]"),
        ("negotiated_prices.negotiated_rate.type", f"{rate}.negotiated_prices[0].negotiated_rate"),
        ("negotiated_prices.service_code.type", f"{rate}.negotiated_prices[0].service_code"),
        ("negotiated_prices.billing_code_modifier.type", f"{rate}.negotiated_prices[0].billing_code_modifier[1]"),
        ("negotiated_prices.type", f"{rate}.negotiated_prices[1]"),
        ("provider_references.provider_groups.npi.type", "$.provider_references[0].provider_groups[0].npi[1]"),
        ("provider_references.provider_groups.tin.type.type", "$.provider_references[0].provider_groups[0].tin.type"),
        ("provider_references.provider_groups.tin.type", "$.provider_references[0].provider_groups[1].tin")])
