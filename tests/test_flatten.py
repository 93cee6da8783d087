"""Index flatten on hand-made hazard rows (FIXTURES F4)."""

import json

from pyspark.sql import functions as F

from nestwork.functions.keys import hash_key
from nestwork.operators import flatten as fl


def bronze(spark, docs):
    rows = [(f"src{i}", d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "index_file_source_id string, value string")


def test_bad_json_is_quarantined_not_lost(spark):
    b = bronze(spark, ["not json at all", '{"a": 1, "a": 2}', {"reporting_entity_name": "x"}, [1, 2]])
    assert fl.flatten_index(b).count() == 0
    q = {r.index_file_source_id: r.reason for r in fl.index_quarantine(b).collect()}
    assert q == {"src0": "not valid JSON", "src1": "JSON that a VARIANT cannot hold: too large, or a repeated key",
                 "src2": "no reporting_structure", "src3": "root is not an object"}


def test_empty_shapes_give_no_rows(spark):
    b = bronze(spark, [{}, {"reporting_structure": []},
                       {"reporting_structure": [{"in_network_files": []}]},
                       {"reporting_structure": [{"in_network_files": None}]}])
    assert fl.flatten_index(b).count() == 0


def test_object_and_array_allowed_amount_give_one_row_each(spark):
    entry = {"description": "d", "location": "https://x/a.json"}
    b = bronze(spark, [{"reporting_structure": [{"allowed_amount_file": entry}]},
                       {"reporting_structure": [{"allowed_amount_file": [entry]}]}])
    rows = fl.allowed_amount_file_index(fl.flatten_index(b)).collect()
    assert len(rows) == 2
    assert {r.file_location for r in rows} == {"https://x/a.json"}


def test_two_structures_same_entry_position_stay_two_rows(spark):
    e = {"description": "d", "location": "https://x/a.json"}
    b = bronze(spark, [{"reporting_entity_name": "n", "reporting_structure": [
        {"in_network_files": [e]}, {"in_network_files": [e]}]}])
    rows = fl.in_network_file_index(fl.flatten_index(b)).collect()
    assert len(rows) == 2
    assert len({r.in_network_file_index_id for r in rows}) == 2
    assert sorted(r.structure_pos for r in rows) == [0, 1]


def test_null_parts_give_distinct_non_null_keys(spark):
    b = bronze(spark, [{"reporting_structure": [{"in_network_files": [
        {"description": None, "location": "https://x/1"}, {"description": "d", "location": None}]}]}])
    rows = fl.in_network_file_index(fl.flatten_index(b)).collect()
    ids = [r.in_network_file_index_id for r in rows]
    assert all(ids) and len(set(ids)) == 2


def test_key_parts_do_not_slide(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc")], "x string, y string")
    keys = [r.k for r in df.select(hash_key("x", "y").alias("k")).collect()]
    assert keys[0] != keys[1]


def test_plan_rows_and_sibling_types(spark):
    doc = {"reporting_entity_name": "E", "reporting_entity_type": "T", "reporting_structure": [{
        "reporting_plans": [{"plan_name": "p", "plan_id_type": "EIN", "plan_id": "1", "plan_market_type": "group"}],
        "in_network_files": [{"description": "d", "location": "https://x/1"}]}]}
    flat = fl.flatten_index(bronze(spark, [doc]))
    plans = fl.reporting_plans(flat).collect()
    assert len(plans) == 1 and plans[0].reporting_plan_id == "1" and plans[0].file_location is None
    assert fl.in_network_file_index(flat).count() == 1


def test_flatten_plan_has_no_exchange(spark):
    b = bronze(spark, [{"reporting_structure": [{"in_network_files": [{"location": "l"}]}]}])
    plan = fl.in_network_file_index(fl.flatten_index(b))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
