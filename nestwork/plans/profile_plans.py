"""Profile, structure discovery and plan-to-file links."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import flatten as fl
from ..operators import profile as pf
from ..session import scratch_path
from ..sources.tables import table
from .index_plans import _ORDERS_POS, index_parsed, landing_bronze

LINEITEM_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def q_column_profile(spark, sf_dir):
    return pf.column_profile(table(spark, sf_dir, "lineitem"), LINEITEM_COLUMNS)


def q_profile_parts(spark, sf_dir):
    """A5: statistics with distinct-count sketches, stored for each shipping year, then merged; the estimate is held
    against the exact count within five standard errors."""
    lines = table(spark, sf_dir, "lineitem")
    root = scratch_path(spark, "profile_parts")
    pf.part_profiles(lines, LINEITEM_COLUMNS, F.year("l_shipdate")).write.partitionBy("part").parquet(root)
    merged = pf.merged_profile(spark.read.parquet(root))
    exact = lines.agg(*[F.count_distinct(F.col(c)).alias(c) for c in LINEITEM_COLUMNS])
    exact = exact.select(F.expr(f"stack({len(LINEITEM_COLUMNS)}, {', '.join(f"'{c}', {c}" for c in LINEITEM_COLUMNS)}) AS (column_name, n_distinct)"))
    near = F.abs(F.col("approx_distinct") - F.col("n_distinct")) <= F.greatest(F.lit(1.0), 5 * 1.04 / 2 ** (pf.SKETCH_LG / 2) * F.col("n_distinct"))
    return merged.join(exact, "column_name").select("column_name", "n_rows", "n_nulls", "min_value", "max_value", near.alias("sketch_holds"))


def q_json_array_paths(spark, sf_dir):
    # a document is known by its path too, which is shorter to move than the key made of it
    return pf.array_paths(index_parsed(spark, sf_dir), key="file_path").select("path", "depth", "n_docs")


def q_json_root_types(spark, sf_dir):
    """A6 (root type): kinds of landed documents, index files and saved pages."""
    landed = landing_bronze(spark, sf_dir).select(F.try_parse_json("value").alias("doc"))
    return pf.root_type(landed)


def q_plan_file_links(spark, sf_dir):
    return plan_file_links(index_parsed(spark, sf_dir))


def plan_file_links(parsed):
    """M3: each in-network file with the plans of its own structure element.

    The association stays one row per file with the plan ids as a list: no
    pairing of every plan with every file is emitted."""
    elems = parsed.select("index_file_source_id",
                          F.posexplode(fl._structure_array("doc")).alias("structure_pos", "s"))
    with_plans = elems.select(
        "index_file_source_id", "structure_pos", "s",
        F.expr("transform(coalesce(try_cast(try_variant_get(s, '$.reporting_plans', 'variant') AS ARRAY<VARIANT>), "
               "array()), p -> try_variant_get(p, '$.plan_id', 'string'))").alias("plan_ids"))
    files = with_plans.select(
        "index_file_source_id", "structure_pos", "plan_ids",
        F.posexplode(F.expr("try_cast(try_variant_get(s, '$.in_network_files', 'variant') AS ARRAY<VARIANT>)"))
        .alias("entry_pos", "f"))
    return files.select(
        "index_file_source_id", F.col("structure_pos").cast("bigint").alias("structure_pos"),
        F.col("entry_pos").cast("bigint").alias("entry_pos"),
        F.try_variant_get("f", "$.location", "string").alias("file_location"),
        F.array_join(F.array_sort("plan_ids"), ",").alias("plan_ids"),
        F.size("plan_ids").alias("n_plans"))


def _profile_sql() -> str:
    parts = []
    for c in LINEITEM_COLUMNS:
        parts.append(f"SELECT '{c}' AS column_name, count(*) AS n_rows, count_if({c} IS NULL) AS n_nulls, "
                     f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM lineitem")
    return "\nUNION ALL ".join(parts)


ORACLE = {
    "profile_parts": f"SELECT *, true AS sketch_holds FROM ({_profile_sql()})",
    "column_profile": _profile_sql(),
    "json_array_paths": """
WITH n AS (SELECT count(DISTINCT o_custkey) AS n FROM orders)
SELECT 'reporting_structure.item' AS path, 1 AS depth, n AS n_docs FROM n
UNION ALL SELECT 'reporting_structure.item.reporting_plans.item', 2, n FROM n
UNION ALL SELECT 'reporting_structure.item.in_network_files.item', 2, n FROM n""",
    "json_root_types": """
SELECT 'object' AS root_type, count(DISTINCT o_custkey) AS n_docs FROM orders
UNION ALL SELECT 'not JSON', count(*) FROM pages""",
    "plan_file_links": f"""
WITH {_ORDERS_POS},
  f AS (SELECT l_orderkey, CAST(l_linenumber AS VARCHAR) AS file_description,
               'https://h/' || l_partkey || '-' || l_suppkey || '.json.gz' AS file_location FROM lineitem),
  fp AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY file_description, file_location) - 1 AS entry_pos FROM f)
SELECT d.index_file_source_id, o.structure_pos, fp.entry_pos, fp.file_location,
       CAST(o.o_orderkey AS VARCHAR) AS plan_ids, 1 AS n_plans
FROM fp JOIN o ON fp.l_orderkey = o.o_orderkey JOIN d ON d.c_custkey = o.o_custkey""",
}

QUERIES = {
    "profile_parts": q_profile_parts,
    "column_profile": q_column_profile,
    "json_array_paths": q_json_array_paths,
    "plan_file_links": q_plan_file_links,
    "json_root_types": q_json_root_types,
}
