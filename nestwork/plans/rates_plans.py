"""Rate-file queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import rates as rt
from ..sources.bronze import rates_bronze_table, rates_typed_table
from ..sources.rates_docs import BUNDLED, COVERED, INLINE, UNRESOLVED, rate_sort_key, with_type_faults
from ..sources.tables import table


def rates_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing folder of rate files plus saved HTML pages from failed downloads."""
    pages = table(spark, sf_dir, "pages").select(F.col("url").alias("file_path"), F.col("html").alias("value"))
    return rates_bronze_table(spark, sf_dir).select("file_path", "value").unionByName(pages)


def valid_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed rate documents that passed the parse (stored typed, read leaf by leaf)."""
    kept, _ = rt.split_valid(rates_typed_table(spark, sf_dir))
    return kept


def q_expect_or_drop(spark, sf_dir):
    """Q2: every landed file with its verdict; kept files carry their sizes."""
    parsed = rt.parse_rates(rates_landing(spark, sf_dir))
    ok = rt.is_valid("doc")
    return parsed.select(
        "file_path",
        F.when(ok, F.lit("kept")).otherwise(F.lit("dropped")).alias("status"),
        F.when(ok, F.size("doc.in_network")).alias("n_in_network"),
        F.when(ok, F.aggregate("doc.in_network", F.lit(0), lambda acc, it: acc + F.size(it["negotiated_rates"])))
        .alias("n_rates"),
    )


def q_rates_fact(spark, sf_dir):
    """M1 with lists of codes written as text."""
    codes = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["billing_code"], x["description"])), ",")
    lists = {c: F.array_join(c, ",") for c in ("service_code", "billing_code_modifier")}
    return rt.rates_fact(valid_rates(spark, sf_dir)).withColumns(lists | {c: codes(c) for c in ("bundled_codes", "covered_services")})


def q_provider_groups(spark, sf_dir):
    return rt.provider_groups(valid_rates(spark, sf_dir))


def q_resolved_rates(spark, sf_dir):
    return rt.resolved_rates(valid_rates(spark, sf_dir))


_PATH = "'rates/' || l_partkey || '/part-0.json'"
_RATE_POS = f"row_number() OVER (PARTITION BY l_partkey ORDER BY {', '.join(rate_sort_key())}) - 1"
_BILLING_CLASS = ("CASE WHEN l_linenumber = 7 THEN 'BAD' WHEN l_returnflag = 'R' THEN 'institutional' "
                  "WHEN l_returnflag = 'A' THEN 'professional' ELSE 'both' END")
_NPI = "CAST(1000000000 + l_suppkey AS VARCHAR) || ',' || CAST(3000000000 + l_suppkey AS VARCHAR)"
_TIN = "lpad(CAST(l_suppkey AS VARCHAR), 9, '0')"
_EXPIRATION = ("CASE WHEN l_partkey % 50 = 0 THEN NULL WHEN l_linenumber = 6 THEN strftime(l_shipdate, '%m/%d/%Y') "
               "ELSE strftime(l_shipdate, '%Y-%m-%d') END")

ORACLE = {
    "expect_or_drop": f"""
SELECT {_PATH} AS file_path, 'kept' AS status, 1 AS n_in_network, count(*)::INTEGER AS n_rates
FROM lineitem GROUP BY l_partkey
UNION ALL
SELECT url, 'dropped', NULL, NULL FROM pages""",
    "rates_fact": f"""
SELECT {_PATH} AS file_path, 0::BIGINT AS in_network_pos, {_RATE_POS} AS rate_pos, 0::BIGINT AS price_pos,
       CAST(l_partkey AS VARCHAR) AS billing_code, 'LOCAL' AS billing_code_type, '1' AS billing_code_type_version,
       CASE WHEN {BUNDLED} THEN 'bundle' WHEN {COVERED} THEN 'capitation' ELSE 'ffs' END AS negotiation_arrangement,
       p_name AS name, p_type AS description, CASE WHEN {BUNDLED} THEN p_brand || ':' || p_type END AS bundled_codes,
       CASE WHEN {COVERED} THEN p_brand || ':' || p_type END AS covered_services,
       'negotiated' AS negotiated_type, l_extendedprice AS negotiated_rate, {_EXPIRATION} AS expiration_date,
       {_BILLING_CLASS} AS billing_class,
       CASE WHEN NOT (l_quantity = 1 AND l_returnflag = 'A') THEN lpad(l_linenumber::VARCHAR, 2, '0') END AS service_code,
       CASE WHEN l_linenumber = 5 THEN '26,26' ELSE '' END AS billing_code_modifier,
       CASE WHEN l_linenumber = 2 THEN 'order ' || l_orderkey END AS additional_information,
       CASE WHEN NOT {INLINE} THEN CAST(CASE WHEN {UNRESOLVED} THEN -1 - l_suppkey ELSE l_suppkey END AS VARCHAR) END AS provider_references,
       ({INLINE})::INTEGER AS n_inline_groups
FROM lineitem JOIN part ON p_partkey = l_partkey""",
    "provider_groups": f"""
WITH p AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE NOT ({INLINE} OR {UNRESOLVED})),
  r AS (SELECT *, {_RATE_POS} AS rate_pos FROM lineitem)
SELECT {_PATH} AS file_path, 'reference' AS source, row_number() OVER (PARTITION BY l_partkey ORDER BY l_suppkey) - 1 AS ref_pos,
       l_suppkey AS provider_group_id, NULL::BIGINT AS in_network_pos, NULL::BIGINT AS rate_pos, 0::BIGINT AS group_pos,
       {_NPI} AS npi, 2 AS n_npi, 'ein' AS tin_type, {_TIN} AS tin_value
FROM p
UNION ALL SELECT {_PATH}, 'inline', NULL, NULL, 0, rate_pos, 0, {_NPI}, 2, 'ein', {_TIN} FROM r WHERE {INLINE}""",
    "resolved_rates": f"""
WITH r AS (SELECT *, {_RATE_POS} AS rate_pos FROM lineitem)
SELECT {_PATH} AS file_path, 0::BIGINT AS in_network_pos, rate_pos, CAST(l_partkey AS VARCHAR) AS billing_code,
       CASE WHEN {UNRESOLVED} THEN -1 - l_suppkey WHEN NOT {INLINE} THEN l_suppkey END AS provider_group_id,
       CASE WHEN {INLINE} THEN 'inline' WHEN {UNRESOLVED} THEN 'unresolved' ELSE 'reference' END AS source,
       CASE WHEN NOT {UNRESOLVED} THEN 0::BIGINT END AS group_pos, CASE WHEN NOT {UNRESOLVED} THEN {_NPI} END AS npi,
       CASE WHEN NOT {UNRESOLVED} THEN 'ein' END AS tin_type, CASE WHEN NOT {UNRESOLVED} THEN {_TIN} END AS tin_value
FROM r""",
}

QUERIES = {
    "expect_or_drop": q_expect_or_drop,
    "rates_fact": q_rates_fact,
    "provider_groups": q_provider_groups,
    "resolved_rates": q_resolved_rates,
}


# ------------------------------------------------------------ step 12: audit
from ..operators import contract as ct  # noqa: E402


def q_contract_audit(spark, sf_dir):
    """Q4: one row per contract violation over the rate files."""
    return ct.audit(valid_rates(spark, sf_dir))


_PRICE = "'$.in_network[0].negotiated_rates[' || rate_pos || '].negotiated_prices[0]'"
ORACLE["contract_audit"] = f"""
WITH r AS (SELECT *, {_RATE_POS} AS rate_pos FROM lineitem)
SELECT {_PATH} AS file_path, 'negotiated_prices.billing_class.enum' AS rule, {_PRICE} || '.billing_class' AS path
FROM r WHERE l_linenumber = 7
UNION ALL SELECT {_PATH}, 'negotiated_prices.oneOf', {_PRICE} FROM r
WHERE l_linenumber = 7 OR (l_quantity = 1 AND l_returnflag = 'A')
UNION ALL SELECT {_PATH}, 'negotiated_prices.expiration_date.required', {_PRICE} || '.expiration_date' FROM r
WHERE l_partkey % 50 = 0
UNION ALL SELECT {_PATH}, 'negotiated_prices.expiration_date.date', {_PRICE} || '.expiration_date' FROM r
WHERE l_linenumber = 6 AND l_partkey % 50 <> 0
UNION ALL SELECT {_PATH}, 'negotiated_prices.billing_code_modifier.uniqueItems', {_PRICE} || '.billing_code_modifier'
FROM r WHERE l_linenumber = 5
UNION ALL SELECT DISTINCT {_PATH}, 'root.plan_name.dependentRequired', '$.plan_name'
FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size = 50"""
QUERIES["contract_audit"] = q_contract_audit


def q_contract_types(spark, sf_dir):
    """Q4, type rules: values of a wrong JSON type in rate files with seeded ones."""
    docs = with_type_faults(rates_bronze_table(spark, sf_dir).select("file_path", "value"))
    return ct.type_audit(docs.select("file_path", F.try_parse_json("value").alias("doc")))


_RATE = "'$.in_network[0].negotiated_rates[' || rate_pos || ']"
ORACLE["contract_types"] = f"""
WITH r AS (SELECT *, {_RATE_POS} AS rate_pos FROM lineitem),
  g AS (SELECT l_partkey, row_number() OVER (PARTITION BY l_partkey ORDER BY l_suppkey) - 1 AS pos
        FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE NOT ({INLINE} OR {UNRESOLVED})))
SELECT {_PATH} AS file_path, 'negotiated_prices.negotiated_rate.type' AS rule, {_RATE}.negotiated_prices[0].negotiated_rate' AS path FROM r WHERE l_partkey % 20 = 5
UNION ALL SELECT DISTINCT {_PATH}, 'root.version.type', '$.version' FROM r WHERE l_partkey % 20 = 6
UNION ALL SELECT {_PATH}, 'negotiated_prices.service_code.type', {_RATE}.negotiated_prices[0].service_code' FROM r
WHERE l_partkey % 20 = 7 AND NOT (l_quantity = 1 AND l_returnflag = 'A')
UNION ALL SELECT {_PATH}, 'negotiated_rates.provider_groups.npi.type', {_RATE}.provider_groups[0].npi[0]' FROM r WHERE l_partkey % 20 = 8 AND {INLINE}
UNION ALL SELECT {_PATH}, 'provider_references.provider_groups.npi.type', '$.provider_references[' || pos || '].provider_groups[0].npi[0]' FROM g
WHERE l_partkey % 20 = 8"""
QUERIES["contract_types"] = q_contract_types
