"""Smaller helpers: conform, defaults, column-exists branch, rule split,
observed metrics, summaries, views, a pivot inside a stream."""

import json

from pyspark.sql import Observation
from pyspark.sql import functions as F

from nestwork.operators import quality as qa
from nestwork.operators import reshape as rs
from nestwork.operators.profile import array_paths, column_profile
from nestwork.sources.sinks import conform, temp_view, write_summary


def test_conform_to_declared_schema(spark):
    df = spark.createDataFrame([("a", "1")], "file_type string, n string")
    out = conform(df, "file_type string, n int, file_downloaded map<string,string>")
    assert out.dtypes == [("file_type", "string"), ("n", "int"), ("file_downloaded", "map<string,string>")]
    assert out.first().file_downloaded is None


def test_defaults_and_column_exists_branch(spark):
    df = spark.createDataFrame([(None, [1, 2])], "a string, xs array<int>")
    d = qa.with_defaults(df, {"a": F.lit("x"), "b": F.array()})
    r = d.first()
    assert r.a == "x" and r.b == []
    assert rs.explode_if_present(df, "xs", "x").count() == 2
    assert rs.explode_if_present(df, "missing", "x").first().x is None


def test_rule_split_and_observed_counts(spark):
    df = spark.createDataFrame([("in_network_files", "l"), ("in_network_files", None), ("x", "l")],
                               "file_type string, file_location string")
    rules = {"valid_file_type": "file_type = 'in_network_files'", "file_location_not_null": "file_location IS NOT NULL"}
    kept, bad = qa.expect_or_drop(df, rules)
    assert kept.count() == 1
    assert sorted(r._failed_rules[0] for r in bad.collect()) == ["file_location_not_null", "valid_file_type"]
    obs = Observation("rules")
    qa.observe_rules(df, "rules", rules)
    df.observe(obs, F.count_if(~qa.passes(rules["valid_file_type"])).alias("bad_type")).collect()
    assert obs.get["bad_type"] == 1
    counts = {(r.table_name, r.rule): (r.n_rows, r.n_failed)
              for r in qa.rule_counts(df, [("t", None, rules)]).collect()}
    assert counts == {("t", "valid_file_type"): (3, 1), ("t", "file_location_not_null"): (3, 1)}


def test_summary_and_view(spark, scratch):
    res = spark.createDataFrame([(json.dumps({"file_path": "a", "status": "done"}),)], "processing_result string")
    write_summary(res, scratch + "/summary", schema="file_path string, status string")
    assert spark.read.parquet(scratch + "/summary").first().status == "done"
    temp_view(res, "nestwork_results_view")
    assert spark.sql("SELECT count(*) AS n FROM nestwork_results_view").first().n == 1


def test_profile_and_path_limit(spark):
    df = spark.createDataFrame([(1, None), (3, "b")], "a int, b string")
    p = {r.column_name: r for r in column_profile(df, approx_distinct=True).collect()}
    assert (p["a"].n_rows, p["a"].n_nulls, p["a"].min_value, p["a"].max_value) == (2, 0, "1", "3")
    assert p["b"].n_nulls == 1 and p["b"].approx_distinct == 1
    docs = spark.createDataFrame([("f", json.dumps({"a": [1], "b": [{"c": []}], "z": [2]}))], "file_path string, t string")
    docs = docs.select("file_path", F.try_parse_json("t").alias("doc"))
    assert [r.path for r in array_paths(docs).orderBy("path").collect()] == ["a.item", "b.item", "b.item.c.item", "z.item"]
    assert [r.path for r in array_paths(docs, limit=2).collect()] == ["a.item", "b.item"]


def test_pivot_inside_a_stream(spark, scratch):
    """The general explode + pivot also runs on a stream (update mode)."""
    src = scratch + "/docs"
    spark.createDataFrame([("d1", '{"x": "1", "y": "2"}'), ("d2", '{"x": "3"}')], "id string, t string") \
        .write.parquet(src)
    stream = spark.readStream.schema("id string, t string").parquet(src)
    kv = rs.explode_object(stream.select("id", F.try_parse_json("t").alias("v")), "v", keep=["id"])
    piv = kv.groupBy("id").agg(*[F.max(F.when(F.col("key") == k, F.expr("try_variant_get(value, '$', 'string')")))
                                 .alias(k) for k in ("x", "y")])
    q = (piv.writeStream.outputMode("update").foreachBatch(lambda d, b: d.write.mode("append").parquet(scratch + "/o"))
         .option("checkpointLocation", scratch + "/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {(r.id, r.x, r.y) for r in spark.read.parquet(scratch + "/o").collect()}
    assert got == {("d1", "1", "2"), ("d2", "3", None)}


def test_array_paths_at_any_depth(spark):
    from pyspark.sql import functions as F

    from nestwork.operators.profile import array_paths

    deep = "1"
    for i in range(12):
        deep = f'{{"a{i}": [{deep}]}}'
    docs = spark.createDataFrame([("f", deep), ("g", '{"a11": []}'), ("h", "7")], "file_path string, t string")
    out = array_paths(docs.select("file_path", F.try_parse_json("t").alias("doc"))).collect()
    assert len(out) == 12 and max(r["depth"] for r in out) == 12


def test_invalid_definition_is_an_error(spark, scratch):
    import pytest

    from nestwork.sources.config import DEFINITION_SCHEMA, ingest_definitions

    defs = spark.createDataFrame([("index", "", "json", "off", "1 day", "in", 1, False)], DEFINITION_SCHEMA + ", valid boolean")
    with pytest.raises(ValueError, match="index"):
        ingest_definitions(spark, defs, scratch, scratch)
