"""Contract audit: each kind of rule fires on a seeded fault, and only there."""

import json

from nestwork.operators import contract as ct
from nestwork.operators import rates as rt

GOOD = {"reporting_entity_name": "e", "reporting_entity_type": "t", "last_updated_on": "2024-01-31", "version": "1",
        "provider_references": [{"provider_group_id": 1, "provider_groups": [
            {"npi": ["1", "2"], "tin": {"type": "ein", "value": "9"}}]}],
        "in_network": [{"negotiation_arrangement": "ffs", "name": "n", "billing_code_type": "CPT",
                        "billing_code_type_version": "1", "billing_code": "1", "description": "d",
                        "negotiated_rates": [{"provider_references": [1], "negotiated_prices": [
                            {"negotiated_type": "negotiated", "negotiated_rate": 1.0, "expiration_date": "2025-01-01",
                             "billing_class": "professional", "service_code": ["11"]}]}]}]}


def audit(spark, doc):
    df = spark.createDataFrame([("f", json.dumps(doc))], "file_path string, value string")
    return sorted((r.rule, r.path) for r in ct.audit(rt.parse_rates(df)).collect())


def test_clean_document_has_no_violation(spark):
    assert audit(spark, GOOD) == []


def test_each_rule_kind(spark):
    bad = json.loads(json.dumps(GOOD))
    bad["plan_name"] = "only one plan field"
    bad["last_updated_on"] = "01/31/2024"
    ref = bad["provider_references"][0]
    ref["location"] = "http://insecure"
    ref["provider_groups"][0]["npi"] = ["1", "1"]
    ref["provider_groups"][0]["tin"]["type"] = "ssn"
    item = bad["in_network"][0]
    item["negotiation_arrangement"] = "barter"
    item["bundled_codes"] = [{"billing_code_type": "CPT"}]
    rate = item["negotiated_rates"][0]
    rate["provider_groups"] = [{"npi": ["3"], "tin": {"type": "ein", "value": "1"}}]
    price = rate["negotiated_prices"][0]
    del price["service_code"]
    del price["expiration_date"]
    price["billing_code_modifier"] = ["26", "26"]
    bad["provider_references"].append({"provider_group_id": 2})
    got = {r for r, _ in audit(spark, bad)}
    assert got == {
        "root.plan_name.dependentRequired", "root.last_updated_on.date",
        "provider_references.location.pattern", "provider_references.anyOf",
        "provider_references.provider_groups.npi.uniqueItems", "provider_references.provider_groups.tin.type.enum",
        "in_network.negotiation_arrangement.enum",
        "in_network.bundled_codes.billing_code_type_version.required", "in_network.bundled_codes.billing_code.required",
        "in_network.bundled_codes.description.required",
        "negotiated_rates.oneOf", "negotiated_prices.oneOf", "negotiated_prices.expiration_date.required",
        "negotiated_prices.billing_code_modifier.uniqueItems"}


def test_paths_point_at_the_element(spark):
    bad = json.loads(json.dumps(GOOD))
    bad["in_network"][0]["negotiated_rates"][0]["negotiated_prices"][0]["billing_class"] = "BAD"
    assert ("negotiated_prices.billing_class.enum",
            "$.in_network[0].negotiated_rates[0].negotiated_prices[0].billing_class") in audit(spark, bad)


def test_nodes_without_a_wrong_type_are_not_walked(spark):
    """One pass tells which documents and nodes hold no wrong type; unknown fields and nulls are no fault."""
    from pyspark.sql import functions as F

    from nestwork.functions.variant import fits_sql

    price = {"negotiated_rate": 1, "service_code": ["01"], "additional_information": None, "own": 2.5}
    ok = {"version": "1", "other": True, "in_network": [{"name": "n", "negotiated_rates": [{"provider_references": [1], "negotiated_prices": [price, {
        **price, "negotiated_rate": 1.25}]}, {"provider_groups": [{"npi": [], "tin": {"type": "ein"}}]}]}]}
    bad = [{**ok, "version": 1}, {**ok, "in_network": [{"name": "n"}, 7]}, {**ok, "in_network": {"a": 1}}]
    bad += [{**ok, "in_network": [{"negotiated_rates": [{"negotiated_prices": [price, {**price, k: v}]}]}]} for k, v in (
        ("negotiated_rate", "1"), ("service_code", "01"), ("service_code", ["01", 2]), ("billing_class", {"a": 1}))]
    df = spark.createDataFrame([(str(i), json.dumps(d)) for i, d in enumerate([ok, *bad])], "file_path string, value string")
    df = df.select("file_path", F.try_parse_json("value").alias("doc"))
    fits = {r[0]: r[1] for r in df.select("file_path", F.expr(fits_sql("doc", ct._level_pattern("root")))).collect()}
    assert fits == {str(i): i == 0 for i in range(len(bad) + 1)}
    assert sorted(r["file_path"] for r in ct.type_audit(df).collect()) == [str(i + 1) for i in range(len(bad))]
