"""File-name rules and download bookkeeping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names as nm
from ..operators import cdc
from ..operators import flatten as fl
from ..sources.index_docs import ALLOWED_PREFIX, LOCATION_PREFIX
from ..sources.tables import table
from .index_plans import ORACLE as INDEX_ORACLE
from .index_plans import flat_index

OUTPUT_FOLDER = "uncompressed"


def landed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File paths seen by the downloader: index locations and crawled pages."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    locs = lines.select(F.concat(F.lit(LOCATION_PREFIX), F.col("l_partkey").cast("string"), F.lit("-"),
                                 F.col("l_suppkey").cast("string"), F.lit(".json.gz")).alias("file_path")).distinct()
    allowed = orders.where(F.col("o_orderstatus") == "F").select(
        F.concat(F.lit(ALLOWED_PREFIX), F.col("o_orderkey").cast("string"), F.lit(".json")).alias("file_path"))
    pages = table(spark, sf_dir, "pages").select(F.col("url").alias("file_path"))
    return locs.unionByName(allowed).unionByName(pages)


def q_file_names(spark, sf_dir):
    """X7-X11, X18 (U1/U3 re-aimed as native columns)."""
    df = landed_names(spark, sf_dir)
    # base and JSON names are computed once; the other columns read them
    named = df.select("file_path", nm.base_name("file_path").alias("base_name"))
    named = named.select("file_path", "base_name", nm.json_file_name("base_name").alias("json_name"))
    ok = F.col("json_name").isNotNull()
    return named.select(
        "file_path", "base_name", "json_name",
        nm.url_stem("base_name").alias("url_stem"),
        nm.strip_gz("base_name").alias("gz_stripped"),
        nm.is_compressed("file_path").alias("is_compressed"),
        F.when(ok, nm.join_path(F.lit(OUTPUT_FOLDER), F.col("json_name"))).alias("output_path"),
        ok.alias("status_success"),
        F.when(ok, F.lit("ok")).otherwise(F.lit("Error: The file is not a JSON file")).alias("status_message"),
    )


def download_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Download attempts per file location, derived from lineitem: returned lines
    were fetched, accepted ones failed once and, when closed, were fetched on retry."""
    lines = table(spark, sf_dir, "lineitem")
    loc = F.concat(F.lit(LOCATION_PREFIX), F.col("l_partkey").cast("string"), F.lit("-"),
                   F.col("l_suppkey").cast("string"), F.lit(".json.gz"))
    attempt = F.explode(F.filter(F.array(
        F.when(F.col("l_returnflag") == "R", F.struct(F.lit(1).alias("attempt"), F.lit("success").alias("status"))),
        F.when(F.col("l_returnflag") == "A", F.struct(F.lit(1).alias("attempt"), F.lit("error").alias("status"))),
        F.when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"),
               F.struct(F.lit(2).alias("attempt"), F.lit("success").alias("status"))),
    ), lambda x: x.isNotNull()))
    return lines.select(loc.alias("file_location"), attempt.alias("a")).select("file_location", "a.*")


def latest_results(spark, sf_dir):
    res = download_results(spark, sf_dir)
    return cdc.latest_per_key(res, ["file_location"], ["attempt", "status"], ["attempt", "status"])


def located_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In-network files as (id, file_location), ready to move: the key as 32 bytes, not as the 64 digits that ``file_id`` gives again."""
    rows = fl.in_network_file_index(flat_index(spark, sf_dir))
    return rows.select(F.unhex("in_network_file_index_id").alias("id"), "file_location")


def file_id() -> Column:
    return F.lower(F.hex("id")).alias("in_network_file_index_id")


def q_pending_files(spark, sf_dir):
    """In-network files with a location and no download result yet."""
    rows = located_files(spark, sf_dir).where(F.col("file_location").isNotNull())
    done = download_results(spark, sf_dir).select("file_location")
    return rows.join(done, "file_location", "left_anti").select(file_id(), "file_location")


def q_file_status(spark, sf_dir):
    """Every in-network file with its latest download result (or none)."""
    rows = located_files(spark, sf_dir)
    latest = latest_results(spark, sf_dir)
    return rows.join(latest, "file_location", "left").select(
        file_id(), "file_location",
        F.col("status").alias("download_status"), F.col("attempt").alias("download_attempts"))


_NAMES = """
  f AS (SELECT DISTINCT 'https://h/' || l_partkey || '-' || l_suppkey || '.json.gz' AS file_path FROM lineitem
        UNION ALL SELECT 'https://h/allowed/' || o_orderkey || '.json' FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT url FROM pages),
  b AS (SELECT file_path, string_split(file_path, '/')[-1] AS base_name FROM f),
  n AS (SELECT *, split_part(split_part(lower(base_name), '?', 1), '#', 1) AS nm FROM b),
  j AS (SELECT *, CASE WHEN regexp_matches(nm, '\\.(gz|gzip)$') THEN regexp_replace(nm, '(\\.json)?\\.(gz|gzip)$', '') || '.json'
                       WHEN suffix(nm, '.json') THEN nm END AS json_name FROM n)"""

_RESULTS = """
  res AS (SELECT 'https://h/' || l_partkey || '-' || l_suppkey || '.json.gz' AS file_location, 1 AS attempt, 'success' AS status
          FROM lineitem WHERE l_returnflag = 'R'
          UNION ALL SELECT 'https://h/' || l_partkey || '-' || l_suppkey || '.json.gz', 1, 'error' FROM lineitem WHERE l_returnflag = 'A'
          UNION ALL SELECT 'https://h/' || l_partkey || '-' || l_suppkey || '.json.gz', 2, 'success' FROM lineitem
          WHERE l_returnflag = 'A' AND l_linestatus = 'F'),
  lr AS (SELECT file_location, arg_max(attempt, (attempt, status)) AS attempt, arg_max(status, (attempt, status)) AS status
         FROM res GROUP BY file_location)"""

_INNET = INDEX_ORACLE["in_network_file_index"].strip()

ORACLE = {
    "file_names": f"""
WITH {_NAMES}
SELECT file_path, base_name, json_name,
       regexp_replace(split_part(split_part(base_name, '?', 1), '#', 1), '(?i)\\.json(\\.gz|\\.gzip)?$', '') AS url_stem,
       regexp_replace(base_name, '\\.gz$', '') AS gz_stripped,
       regexp_matches(lower(split_part(file_path, '?', 1)), '\\.(gz|gzip)$') AS is_compressed,
       CASE WHEN json_name IS NOT NULL THEN 'uncompressed/' || json_name END AS output_path,
       json_name IS NOT NULL AS status_success,
       CASE WHEN json_name IS NULL THEN 'Error: The file is not a JSON file' ELSE 'ok' END AS status_message
FROM j""",
    "pending_files": f"""
WITH inn AS ({_INNET}), {_RESULTS.strip().rstrip(',')}
SELECT in_network_file_index_id, file_location FROM inn
WHERE file_location IS NOT NULL AND file_location NOT IN (SELECT file_location FROM res)""",
    "file_status": f"""
WITH inn AS ({_INNET}), {_RESULTS.strip()}
SELECT in_network_file_index_id, inn.file_location, lr.status AS download_status, lr.attempt AS download_attempts
FROM inn LEFT JOIN lr ON inn.file_location = lr.file_location""",
}

QUERIES = {
    "file_names": q_file_names,
    "pending_files": q_pending_files,
    "file_status": q_file_status,
}
