"""Rescued fields, reasons from the parsers, and no document lost in chunking."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestwork.operators import chunking as ch
from nestwork.operators import flatten as fl
from nestwork.operators import rescue as R
from nestwork.sources.schemas import RATES_SCHEMA, RATES_SCHEMA_WITH_CORRUPT

OK = {"version": "1", "plan_id": 5, "in_network": [{"name": "n", "negotiated_rates": [
    {"negotiated_prices": [{"negotiated_rate": 1}], "provider_references": [1], "provider_groups": [{"npi": [1, "2"]}]}]}]}


def plain(value, kind, path="$"):
    """The same walk over Python values."""
    if value is None:
        return {}
    if isinstance(kind, T.StructType):
        if not isinstance(value, dict):
            return {path: value}
        out = {f"{path}.{k}": v for k, v in value.items() if k not in kind.fieldNames()}
        for f in kind.fields:
            out |= plain(value.get(f.name), f.dataType, f"{path}.{f.name}")
        return out
    if isinstance(kind, T.ArrayType):
        if not isinstance(value, list):
            return {path: value}
        return {k: v for i, x in enumerate(value) for k, v in plain(x, kind.elementType, f"{path}[{i}]").items()}
    fits = {T.LongType: type(value) is int, T.DoubleType: type(value) in (int, float), T.StringType: not isinstance(value, (dict, list))}
    return {} if fits[type(kind)] else {path: value}


DOCS = [OK, {}, {**OK, "extra": {"a": [1]}}, {**OK, "version": {"a": 1}, "in_network": {"a": 1}}, [1], "text", 7, {**OK, "in_network": None},
        {**OK, "in_network": [{"zz": None, "negotiated_rates": [{"negotiated_prices": [{"negotiated_rate": "n/a", "q": 1}],
                                                                "provider_references": [1, "x", 2.5]}, 3]}, 7]},
        {**OK, "it's": 1, "provider_references": [{"provider_group_id": True, "provider_groups": [{"tin": {"type": [1]}}]}]}]


def test_rescued_fields_equal_a_plain_walk(spark):
    rows = [(i, json.dumps(d)) for i, d in enumerate(DOCS)]
    got = R.read_with_rescue(spark.createDataFrame(rows, "i int, value string"), RATES_SCHEMA, keep=["i"]).collect()
    for r in got:
        want = plain(DOCS[r["i"]], RATES_SCHEMA)
        found = {k: json.loads(v) for k, v in json.loads(r[R.RESCUED] or "{}").items()}
        assert found == want, DOCS[r["i"]]
        assert (r["reason"] is None) == (not want)


def test_reasons_come_from_the_parsers(spark):
    texts = ["<html>", '{"a": 1, "a": 2}', '{"version": "1"', "", None]
    got = R.read_with_rescue(spark.createDataFrame([(t,) for t in texts], "value string"), RATES_SCHEMA)
    reasons = {r["value"]: r["reason"] for r in got.collect()}
    assert "repeated key" in reasons['{"a": 1, "a": 2}']
    assert {reasons[t] for t in texts if t != texts[1]} == {"not valid JSON"}
    index = fl.index_quarantine(spark.createDataFrame([(t, t) for t in texts], "index_file_source_id string, value string"))
    assert {r["index_file_source_id"]: r["reason"] for r in index.collect()} == reasons


def test_micro_batches_are_split_once_and_replayed(spark, scratch):
    read = R.read_with_rescue(spark.createDataFrame([(json.dumps(d),) for d in DOCS], "value string"), RATES_SCHEMA)
    write = R.split_writer(scratch + "/t")
    write(read, 0)
    write(read, 1)
    write(read, 1)  # a replay
    n = [R.split_table(spark, scratch + "/t", read.schema, s).count() for s in ("kept", "quarantine")]
    good = sum(not plain(d, RATES_SCHEMA) for d in DOCS)
    assert n == [2 * good, 2 * (len(DOCS) - good)]


def bronze(spark, hide):
    rows = [(f"f{i}", json.dumps({"in_network": [{"negotiated_rates": [{"negotiated_prices": [{"billing_class": c, "negotiated_rate": float(k)}
                                                                                             for k, c in enumerate("abca")]}] * i}]})) for i in range(4)]
    rows.append(("page", "<html>"))
    df = spark.createDataFrame(rows, "file_path string, value string").select(
        "file_path", F.from_json("value", RATES_SCHEMA_WITH_CORRUPT, {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("doc"),
        F.when(~F.col("file_path").isin(hide), F.try_parse_json("value")).alias("vdoc"))
    return df.withColumn("has_variant", F.col("vdoc").isNotNull())


def test_documents_without_a_variant_are_chunked_from_their_typed_form(spark):
    """A VARIANT that is missing (as over the parser's limit) changes no chunk and loses no document."""
    paths = ["in_network.item.negotiated_rates.item", "in_network.item.negotiated_rates.item.negotiated_prices.item"]
    results = []
    for hide in ([""], ["f1", "f3"]):
        docs = ch.with_typed_fallback(bronze(spark, hide), "vdoc", "doc", "has_variant")
        assert docs.where("typed IS NOT NULL").count() == len(set(hide) - {""})
        rate = lambda c: sorted((r["file_path"], r["chunk_id"], r["n_objects"], r["first_pos"]) for r in c.collect())
        prices = lambda c: sorted((r["file_path"], str(r["j"])) for r in c.select(
            "file_path", F.transform("items", lambda x: F.try_variant_get(x, "$.negotiated_rate", "double")).alias("j")).collect())
        chunks = ch.array_chunks(docs, paths[0], 2, typed="typed")
        split = ch.split_by_field(docs, paths[1], "billing_class", 3, typed="typed")
        multi = ch.multi_path_chunks(docs, [{"path": p, "chunk_size": 3} for p in paths], typed="typed")
        results.append((rate(chunks), rate(split), prices(split), rate(multi), prices(multi),
                        sorted(map(tuple, ch.outcomes(docs, paths, typed="typed").collect()))))
    assert results[0] == results[1]
    assert results[0][-1] == [(p, 5, 3, 1, 1) for p in paths]
    scan = ch.with_typed_fallback(bronze(spark, [""]), "vdoc", "doc", "has_variant")
    assert "Exchange" not in scan._jdf.queryExecution().executedPlan().toString()


def test_only_values_that_do_not_fit_are_walked(spark):
    """One pass tells that a document fits; whatever the plain walk rescues does not match the pattern."""
    from nestwork.functions.variant import fits_sql

    docs = [*DOCS, {**OK, "in_network": [{"negotiated_rates": []}, None, {}]}, {**OK, "in_network": [{"name": "n"}, {"name": 1}]}]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "i int, value string").withColumn("v", F.try_parse_json("value"))
    fits = {r["i"]: r["fits"] for r in df.select("i", F.expr(fits_sql("v", R.schema_pattern(RATES_SCHEMA))).alias("fits")).collect()}
    assert fits[1] and fits[7] and fits[len(DOCS)]
    assert not any(fits[i] for i, d in enumerate(docs) if plain(d, RATES_SCHEMA))
