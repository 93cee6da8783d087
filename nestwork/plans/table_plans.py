"""Queries over readers, catalog tables, summaries and small column helpers, each written and read back in Spark."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.names import trimmed
from ..functions.udfs import distance_km, with_name_status
from ..operators import profile as pf
from ..operators import quality as qa
from ..operators import reshape as rs
from ..session import scratch_path
from ..sources import catalog
from ..sources.files import read_json, rows_from_paths, stream_whole_files
from ..sources.sinks import FILES_PER_TASK, append_table, stream_to_table, write_document_files, write_json_chunks, write_summary
from ..sources.tables import table, tasks_for
from .index_plans import index_parsed

SUPPLIER = ["s_suppkey", "s_name", "s_nationkey"]


def q_json_readers(spark, sf_dir):
    """Suppliers as pretty-printed gzipped documents, one in each file, and as JSON Lines; both are read with the written schema."""
    root = scratch_path(spark, "json_readers")
    rows = table(spark, sf_dir, "supplier").select(*SUPPLIER)
    pretty = rows.select(F.to_json(F.struct(*SUPPLIER), {"pretty": "true"}).alias("value"))
    write_document_files(pretty, f"{root}/documents", "value", tasks_for(rows, FILES_PER_TASK), compression="gzip")
    rows.write.json(f"{root}/lines")
    out = None
    for name, multi in (("documents", True), ("lines", False)):
        read = read_json(spark, f"{root}/{name}", schema=rows.schema, multi_line=multi)
        part = read.select(F.lit(name).alias("kind"), *SUPPLIER, F.col("_corrupt_record").isNull().alias("whole"))
        out = part if out is None else out.unionByName(part)
    return out


def q_catalog_table(spark, sf_dir):
    """Orders appended to a named table in two parts, analysed for the optimizer, and read by name."""
    root = scratch_path(spark, "catalog_table")
    name = root.rsplit("/", 1)[1].replace("-", "_")
    catalog.drop_table_if_exists(spark, name)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    catalog.save_table(orders.where("o_orderkey % 2 = 0"), name, f"{root}/table")
    append_table(orders.where("o_orderkey % 2 = 1"), name)
    catalog.analyze(spark, name)
    stats = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {name} o_orderkey").collect()}
    return catalog.read_table(spark, name).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("o_orderkey").alias("first_key"), F.round(F.sum("o_totalprice"), 2).alias("total")).withColumn(
        "stored_max_key", F.lit(int(stats["max"])).cast("long"))


def q_summary_table(spark, sf_dir):
    """Results of processed files as JSON texts, repartitioned, and one overwritten summary of them; the
    classes of files come as a list of paths."""
    root = scratch_path(spark, "summary")
    pages = table(spark, sf_dir, "pages")
    paths = rows_from_paths(spark, [f"pages/{x}" for x in ("even", "odd")])
    kind = F.concat(F.lit("pages/"), F.when(F.col("page_id") % 2 == 0, "even").otherwise("odd"))
    results = pages.select(kind.alias("path"), F.to_json(F.struct(
        F.col("url").alias("file_path"), (F.length("html") > 1000).alias("success"), F.length("html").alias("n_chars"))).alias("processing_result"))
    schema = "file_path string, success boolean, n_chars long"
    write_json_chunks(results, f"{root}/results", max_records=100, partitions=3)
    back = spark.read.schema(results.schema).json(f"{root}/results").join(paths, "path").select("processing_result")
    for part in (back.limit(0), back):  # the second run overwrites the first
        write_summary(part, f"{root}/summary", schema=schema)
    return spark.read.schema(schema).parquet(f"{root}/summary")


def q_column_helpers(spark, sf_dir):
    """X5, X16, X17, U2-U4, Q5, F4 over parts: distances, trimmed names, name status, parameter checks, a column that may be absent."""
    part = table(spark, sf_dir, "part")
    rows = part.select("p_partkey", F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("raw"), F.when(F.col("p_size") % 3 == 0, " ").otherwise(
        F.col("p_brand")).alias("brand"), F.concat("p_brand", F.when(F.col("p_size") % 2 == 0, ".json.gz?x").otherwise(".html")).alias("file"),
        F.when(F.col("p_size") % 5 > 0, F.col("p_size").cast("double")).alias("miles"), F.array("p_size", "p_partkey").alias("xs"))
    rows = with_name_status(rows, "file", "status")
    rows = rs.explode_if_present(rs.explode_if_present(rows, "xs", "x"), "absent", "y")
    return rows.select("p_partkey", trimmed("raw").alias("name"), F.round(distance_km("miles").cast("double"), 3).alias("km"),
                       F.col("status.success").alias("is_json"), F.col("status.message").alias("message"), qa.non_empty("raw", "brand").alias("complete"),
                       F.col("x").cast("long").alias("x"), F.col("y").cast("string").alias("y"),
                       (F.current_timestamp() > F.to_timestamp(F.lit("2020-01-01"))).alias("has_time"))


def q_first_array_paths(spark, sf_dir):
    """L1: the first two array paths of the index files, in path order."""
    return pf.array_paths(index_parsed(spark, sf_dir), key="file_path", limit=2).select("path", "depth", "n_docs")


def q_stream_clean_source(spark, sf_dir):
    """S3: whole files streamed with a clean-up that moves the files of finished batches to an archive; none is read twice."""
    root = scratch_path(spark, "stream_clean")
    for name in ("supplier", "customer"):
        table(spark, sf_dir, name).repartition(5).select(F.to_json(F.struct("*")).alias("value")).write.text(f"{root}/landing/{name}")
    src = stream_whole_files(spark, f"{root}/landing/*", max_files_per_trigger=2, clean_source="archive", archive_dir=f"{root}/archive")
    rows = src.select(F.explode(F.split(F.rtrim("value", F.lit("\n")), "\n")).alias("value"))
    for _ in range(2):  # a second run finds nothing new
        stream_to_table(rows, f"{root}/lines", f"{root}/_checkpoints/lines")
    name = F.coalesce(F.get_json_object("value", "$.s_name"), F.get_json_object("value", "$.c_name"))
    return spark.read.schema("value string").parquet(f"{root}/lines").select(name.alias("name"))


ORACLE = {
    "json_readers": """
SELECT k AS kind, s_suppkey, s_name, s_nationkey, true AS whole FROM supplier, (VALUES ('documents'), ('lines')) t(k)""",
    "catalog_table": """
SELECT o_orderstatus, count(*) AS n_rows, min(o_orderkey) AS first_key, round(sum(o_totalprice), 2) AS total,
       (SELECT max(o_orderkey) FROM orders) AS stored_max_key FROM orders GROUP BY 1""",
    "summary_table": "SELECT url AS file_path, length(html) > 1000 AS success, length(html) AS n_chars FROM pages",
    "column_helpers": """
SELECT p_partkey, trim(p_name) AS name, CASE WHEN p_size % 5 > 0 THEN round((p_size * 1.60934)::FLOAT::DOUBLE, 3) END AS km,
       p_size % 2 = 0 AS is_json, CASE WHEN p_size % 2 = 0 THEN 'ok' ELSE 'Error: The file is not a JSON file' END AS message,
       p_size % 3 <> 0 AS complete, unnest([p_size::BIGINT, p_partkey]) AS x, NULL::VARCHAR AS y, true AS has_time FROM part""",
    "first_array_paths": """
WITH n AS (SELECT count(DISTINCT o_custkey) AS n FROM orders)
SELECT 'reporting_structure.item' AS path, 1 AS depth, n AS n_docs FROM n
UNION ALL SELECT 'reporting_structure.item.in_network_files.item', 2, n FROM n""",
    "stream_clean_source": "SELECT s_name AS name FROM supplier UNION ALL SELECT c_name FROM customer",
}

QUERIES = {
    "json_readers": q_json_readers,
    "catalog_table": q_catalog_table,
    "summary_table": q_summary_table,
    "column_helpers": q_column_helpers,
    "first_array_paths": q_first_array_paths,
    "stream_clean_source": q_stream_clean_source,
}
