"""Index pipeline queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import hash_key, sql_hash_key
from ..operators import flatten as fl
from ..sources.bronze import index_bronze_table
from ..sources.index_docs import with_index_faults
from ..sources.tables import table


def index_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows (source id, path, JSON text) for the table-derived index files."""
    return index_bronze_table(spark, sf_dir).select("index_file_source_id", "file_path", "value")


def index_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows with the VARIANT, parsed as they are read."""
    return index_bronze_table(spark, sf_dir).select("index_file_source_id", "file_path", "doc")


def landing_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing folder: the index files plus saved web pages (failed downloads
    that stored an HTML page instead of JSON)."""
    pages = table(spark, sf_dir, "pages").select(
        hash_key("url").alias("index_file_source_id"), F.col("url").alias("file_path"), F.col("html").alias("value"))
    return index_bronze(spark, sf_dir).unionByName(pages)


def flat_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fl.flatten_parsed(index_parsed(spark, sf_dir))


def q_in_network_file_index(spark, sf_dir):
    return fl.in_network_file_index(flat_index(spark, sf_dir))


def q_reporting_plans(spark, sf_dir):
    return fl.reporting_plans(flat_index(spark, sf_dir))


def q_allowed_amount_index(spark, sf_dir):
    return fl.allowed_amount_file_index(flat_index(spark, sf_dir))


def q_index_quarantine(spark, sf_dir):
    return fl.index_quarantine(landing_bronze(spark, sf_dir))


# ---------------------------------------------------------------- oracles
_SRC = sql_hash_key("'index/' || c_custkey || '/part-0.json'")

_ORDERS_POS = """
  o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS structure_pos
        FROM orders),
  d AS (SELECT c_custkey, c_name, c_mktsegment, {src} AS index_file_source_id FROM customer)""".format(src=_SRC)

ORACLE = {
    "in_network_file_index": f"""
WITH {_ORDERS_POS},
  f AS (SELECT l_orderkey, CAST(l_linenumber AS VARCHAR) AS file_description,
               'https://h/' || l_partkey || '-' || l_suppkey || '.json.gz' AS file_location FROM lineitem),
  fp AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY file_description, file_location) - 1 AS entry_pos FROM f),
  r AS (SELECT d.index_file_source_id, d.c_name AS reporting_entity_name, d.c_mktsegment AS reporting_entity_type,
               'in_network_files' AS file_type, fp.file_description, fp.file_location,
               o.structure_pos, fp.entry_pos
        FROM fp JOIN o ON fp.l_orderkey = o.o_orderkey JOIN d ON d.c_custkey = o.o_custkey)
SELECT {sql_hash_key('index_file_source_id', 'reporting_entity_name', 'reporting_entity_type', 'file_type',
                     'file_description', 'file_location', 'structure_pos', 'entry_pos')} AS in_network_file_index_id, *
FROM r""",
    "reporting_plans": f"""
WITH {_ORDERS_POS},
  r AS (SELECT d.index_file_source_id, d.c_name AS reporting_entity_name, d.c_mktsegment AS reporting_entity_type,
               'reporting_plans' AS file_type, 'EIN' AS reporting_plan_id_type, CAST(o.o_orderkey AS VARCHAR) AS reporting_plan_id,
               o.o_orderstatus AS reporting_plan_market_type, o.o_orderpriority AS reporting_plan_name,
               CAST(NULL AS VARCHAR) AS file_description, CAST(NULL AS VARCHAR) AS file_location,
               o.structure_pos, CAST(0 AS BIGINT) AS entry_pos
        FROM o JOIN d ON d.c_custkey = o.o_custkey)
SELECT {sql_hash_key('index_file_source_id', 'reporting_entity_name', 'reporting_entity_type', 'file_type',
                     'reporting_plan_id_type', 'reporting_plan_id', 'reporting_plan_market_type', 'reporting_plan_name',
                     'file_description', 'file_location', 'structure_pos', 'entry_pos')} AS reporting_plan_index_id, *
FROM r""",
    "allowed_amount_index": f"""
WITH {_ORDERS_POS},
  r AS (SELECT d.index_file_source_id, d.c_name AS reporting_entity_name, d.c_mktsegment AS reporting_entity_type,
               'allowed_amount_file' AS file_type, 'allowed amount file' AS file_description,
               'https://h/allowed/' || o.o_orderkey || '.json' AS file_location,
               o.structure_pos, CAST(0 AS BIGINT) AS entry_pos
        FROM o JOIN d ON d.c_custkey = o.o_custkey WHERE o.o_orderstatus = 'F')
SELECT {sql_hash_key('index_file_source_id', 'reporting_entity_name', 'reporting_entity_type', 'file_type',
                     'file_description', 'file_location', 'structure_pos', 'entry_pos')} AS allowed_amount_file_index_id, *
FROM r""",
    "index_quarantine": f"""
SELECT {sql_hash_key('url')} AS index_file_source_id, 'not valid JSON' AS reason FROM pages""",
}

QUERIES = {
    "in_network_file_index": q_in_network_file_index,
    "reporting_plans": q_reporting_plans,
    "allowed_amount_index": q_allowed_amount_index,
    "index_quarantine": q_index_quarantine,
}


# ------------------------------------------------- step 2-3: reshape + rules
from ..operators import quality as qa  # noqa: E402
from ..operators import reshape as rs  # noqa: E402

# The expectations declared on the three index tables.
INDEX_RULES = [
    ("in_network_file_index", "file_type LIKE 'in_network%'",
     {"valid_file_type": "file_type = 'in_network_files'", "file_location_not_null": "file_location IS NOT NULL"}),
    ("reporting_plans", "file_type LIKE 'reporting%'",
     {"valid_file_type": "file_type = 'reporting_plans'", "file_location_is_null": "file_location IS NULL"}),
    ("allowed_amount_file_index", "file_type LIKE 'allowed%'",
     {"valid_file_type": "file_type = 'allowed_amount_file'", "file_location_not_null": "file_location IS NOT NULL"}),
]

ORDER_KEYS = ["o_custkey", "o_orderstatus", "o_orderpriority", "o_comment"]


def q_pivot_keys(spark, sf_dir):
    """Explode each order object into (key, value) rows, pivot back by key."""
    orders = table(spark, sf_dir, "orders")
    docs = orders.select("o_orderkey", F.try_parse_json(F.to_json(F.struct(
        "o_custkey", "o_orderstatus", "o_orderpriority"))).alias("v"))
    kv = rs.explode_object(docs, "v", keep=["o_orderkey"])
    return rs.pivot_values(kv, ["o_orderkey"], "key", "value", ORDER_KEYS)


def q_explode_outer_rows(spark, sf_dir):
    """In-network entries per structure element, keeping elements with none."""
    parsed = index_parsed(spark, sf_dir)
    elems = parsed.select("index_file_source_id",
                          F.posexplode(fl._structure_array("doc")).alias("structure_pos", "structure"))
    files = elems.select(
        "index_file_source_id", "structure_pos",
        F.posexplode_outer(F.expr("try_cast(try_variant_get(structure, '$.in_network_files', 'variant') AS ARRAY<VARIANT>)"))
        .alias("entry_pos", "entry"))
    return files.select(
        "index_file_source_id", F.col("structure_pos").cast("bigint").alias("structure_pos"),
        F.col("entry_pos").cast("bigint").alias("entry_pos"),
        F.try_variant_get("entry", "$.location", "string").alias("file_location"))


def q_expectation_counts(spark, sf_dir):
    """Q1: per-table, per-rule failure counts over the flat rows of index files with seeded faults (one pass)."""
    docs = with_index_faults(index_bronze(spark, sf_dir))
    return qa.rule_counts(fl.flatten_index(docs), INDEX_RULES)


ORACLE.update({
    "pivot_keys": """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, o_orderpriority,
       CAST(NULL AS VARCHAR) AS o_comment FROM orders""",
    "explode_outer_rows": f"""
WITH {_ORDERS_POS},
  f AS (SELECT l_orderkey, CAST(l_linenumber AS VARCHAR) AS file_description,
               'https://h/' || l_partkey || '-' || l_suppkey || '.json.gz' AS file_location FROM lineitem),
  fp AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY file_description, file_location) - 1 AS entry_pos FROM f)
SELECT d.index_file_source_id, o.structure_pos, fp.entry_pos, fp.file_location
FROM o JOIN d ON d.c_custkey = o.o_custkey LEFT JOIN fp ON fp.l_orderkey = o.o_orderkey""",
    "expectation_counts": """
WITH o AS (SELECT o_custkey AS c, count(*) AS n_plan, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_aa FROM orders GROUP BY 1),
  l AS (SELECT o_custkey AS c, count(*) AS n_in FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1),
  n AS (SELECT sum(n_in) AS n_in, sum(n_plan) AS n_plan, sum(n_aa) AS n_aa, coalesce(sum(n_in) FILTER (WHERE c % 7 = 0), 0) AS misnamed,
               coalesce(sum(n_in) FILTER (WHERE c % 5 = 0), 0) AS no_loc, coalesce(sum(n_aa) FILTER (WHERE c % 5 = 0), 0) AS no_aa,
               coalesce(sum(n_plan) FILTER (WHERE c % 11 = 0 AND c % 5 <> 0), 0) AS plan_loc FROM o LEFT JOIN l USING (c))
SELECT 'in_network_file_index' AS table_name, 'valid_file_type' AS rule, n_in::BIGINT AS n_rows, misnamed::BIGINT AS n_failed FROM n
UNION ALL SELECT 'in_network_file_index', 'file_location_not_null', n_in, no_loc FROM n
UNION ALL SELECT 'reporting_plans', 'valid_file_type', n_plan, 0 FROM n
UNION ALL SELECT 'reporting_plans', 'file_location_is_null', n_plan, plan_loc FROM n
UNION ALL SELECT 'allowed_amount_file_index', 'valid_file_type', n_aa, 0 FROM n
UNION ALL SELECT 'allowed_amount_file_index', 'file_location_not_null', n_aa, no_aa FROM n""",
})

QUERIES.update({
    "pivot_keys": q_pivot_keys,
    "explode_outer_rows": q_explode_outer_rows,
    "expectation_counts": q_expectation_counts,
})
