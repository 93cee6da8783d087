"""Rate files: typed parse, quarantine, large npi, reference resolution."""

import json

from nestwork.operators import rates as rt


def docs(spark, texts):
    return rt.parse_rates(spark.createDataFrame([(f"f{i}", t) for i, t in enumerate(texts)],
                                                "file_path string, value string"))


DOC = {"reporting_entity_name": "e", "reporting_entity_type": "t", "last_updated_on": "2024-01-01",
       "version": "1", "provider_references": [
           {"provider_group_id": 7, "provider_groups": [{"npi": ["3000000007", "1"], "tin": {"type": "ein", "value": "x"}}]}],
       "in_network": [{"billing_code": "B", "negotiated_rates": [
           {"negotiated_prices": [{"negotiated_rate": 1.5, "billing_class": "both"}], "provider_references": [7, 8]}]}]}


def test_npi_above_int_range_is_kept(spark):
    g = rt.provider_groups(docs(spark, [json.dumps(DOC)])).collect()
    assert g[0].npi == "3000000007,1" and g[0].n_npi == 2


def test_corrupt_text_is_dropped_to_quarantine(spark):
    parsed = docs(spark, [json.dumps(DOC), "<html>oops</html>",
                          json.dumps({**DOC, "in_network": [{"negotiated_rates": [
                              {"negotiated_prices": [{"negotiated_rate": "n/a"}]}]}]})])
    kept, bad = rt.split_valid(parsed)
    assert [r.file_path for r in kept.collect()] == ["f0"]
    assert sorted(r.file_path for r in bad.collect()) == ["f1", "f2"]


def test_unresolved_reference_keeps_a_null_row(spark):
    r = rt.resolved_rates(docs(spark, [json.dumps(DOC)])).orderBy("provider_group_id").collect()
    assert [(x.provider_group_id, x.tin_value) for x in r] == [(7, "x"), (8, None)]


def test_rates_fact_one_row_per_price(spark):
    f = rt.rates_fact(docs(spark, [json.dumps(DOC)])).collect()
    assert len(f) == 1 and f[0].negotiated_rate == 1.5 and f[0].provider_references == "7,8"


def test_inline_groups_beside_references(spark):
    group = {"npi": ["5"], "tin": {"type": "npi", "value": "5"}}
    price = [{"negotiated_rate": 2.0}]
    doc = {**DOC, "in_network": [{"billing_code": "B", "name": "n", "bundled_codes": [{"billing_code": "C"}], "negotiated_rates": [
        {"negotiated_prices": price, "provider_groups": [group, group]},
        {"negotiated_prices": price, "provider_groups": [group], "provider_references": [7, 9]},
        {"negotiated_prices": price, "provider_references": []},
        {"negotiated_prices": [{"negotiated_rate": 1.0, "service_code": ["11"], "additional_information": "i"}]}]}]}
    d = docs(spark, [json.dumps(doc)])
    got = sorted((r.rate_pos, r.source, r.provider_group_id or 0, r.group_pos, r.tin_value) for r in rt.resolved_rates(d).collect())
    assert got == [(0, "inline", 0, 0, "5"), (0, "inline", 0, 1, "5"), (1, "inline", 0, 0, "5"), (1, "reference", 7, 0, "x"),
                   (1, "unresolved", 9, None, None), (2, "none", 0, None, None), (3, "none", 0, None, None)]
    groups = rt.provider_groups(d).collect()
    assert sorted((g.source, g.rate_pos if g.source == "inline" else g.ref_pos, g.group_pos) for g in groups) == [
        ("inline", 0, 0), ("inline", 0, 1), ("inline", 1, 0), ("reference", 0, 0)]
    fact = {r.rate_pos: r for r in rt.rates_fact(d).collect()}
    assert [fact[i].n_inline_groups for i in range(4)] == [2, 1, 0, 0]
    assert (fact[3].service_code, fact[3].additional_information, fact[3].name, fact[3].bundled_codes[0].billing_code) == (["11"], "i", "n", "C")
