"""Sink round trips: write, then read back what was written."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import chunking as ch
from ..operators import flatten as fl
from ..operators import quality as qa
from ..session import scratch_path
from ..sources.files import list_files
from ..sources.sinks import write_index_split, write_json_chunks, write_partitioned
from .chunk_plans import ORACLE as CHUNK_ORACLE
from .chunk_plans import CLASS_CHUNK, PRICE_PATH, rate_docs
from .index_plans import ORACLE as INDEX_ORACLE
from .index_plans import flat_index

CHUNK_ROWS = 1000


def _write_index_chunks(spark, sf_dir):
    root = scratch_path(spark, "chunk_sink")
    rows = fl.in_network_file_index(flat_index(spark, sf_dir))
    write_json_chunks(rows, f"{root}/in_network", max_records=CHUNK_ROWS, compression="gzip")
    return root, rows.schema


def q_chunk_sink(spark, sf_dir):
    """K4: in-network rows as gzipped JSON files of at most 1,000 rows, read back."""
    root, schema = _write_index_chunks(spark, sf_dir)
    return spark.read.schema(schema).json(f"{root}/in_network")


def q_partition_sink(spark, sf_dir):
    """Chunks split by billing class, one folder per
    category, each chunk's JSON written under its file name; read back."""
    root = scratch_path(spark, "partition_sink")
    chunks = ch.split_by_field(rate_docs(spark, sf_dir), PRICE_PATH, "billing_class", CLASS_CHUNK, typed="typed")
    out = chunks.select("category_dir", "file_path", "chunk_name", "n_objects", ch.chunk_json().alias("json"))
    write_partitioned(out, f"{root}/by_category", ["category_dir"], compression="gzip")
    # the schema written is known: no inference pass; category_dir comes from the folders
    back = spark.read.schema("file_path string, chunk_name string, n_objects int, json string").json(
        f"{root}/by_category")
    return back.select("file_path", "category_dir", "chunk_name", F.col("n_objects").cast("int").alias("n_objects"),
                       F.size(F.from_json("json", "array<string>")).alias("n_parsed"))


def q_manifest(spark, sf_dir):
    """List the written chunk files; count empty and misnamed ones, over-long chunks and rows read back."""
    root, schema = _write_index_chunks(spark, sf_dir)
    files = list_files(spark, f"{root}/in_network", glob="part-*")
    checks = files.agg(F.count_if(~qa.passes("length > 0")).alias("n_empty"),
                       F.count_if(~F.col("path").endswith(".json.gz")).alias("n_not_json"))
    back = spark.read.schema(schema).json(f"{root}/in_network").groupBy(F.col("_metadata.file_path").alias("f")).agg(
        F.count(F.lit(1)).alias("n"))
    sizes = back.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count_if(F.col("n") > CHUNK_ROWS).alias("n_too_long"))
    return sizes.select("*", checks.select(F.struct("*")).scalar().alias("c")).select("n_rows", "n_too_long", "c.*")


def q_index_split_sink(spark, sf_dir):
    """One flatten written once by file type; the in-network table is read back
    with partition pruning (``PartitionFilters`` on ``file_type``)."""
    root = scratch_path(spark, "index_split")
    write_index_split(flat_index(spark, sf_dir), f"{root}/index_files")
    back = spark.read.parquet(f"{root}/index_files").where(F.col("file_type") == "in_network_files")
    return fl.in_network_file_index(back)


ORACLE = {
    "index_split_sink": INDEX_ORACLE["in_network_file_index"],
    "chunk_sink": INDEX_ORACLE["in_network_file_index"],
    "manifest": f"""
SELECT count(*) AS n_rows, 0::BIGINT AS n_too_long, 0::BIGINT AS n_empty, 0::BIGINT AS n_not_json
FROM ({INDEX_ORACLE['in_network_file_index']})""",
    "partition_sink": f"""
SELECT file_path, category_dir, chunk_name, n_objects, n_objects AS n_parsed
FROM ({CHUNK_ORACLE['split_by_field']})""",
}

QUERIES = {
    "chunk_sink": q_chunk_sink,
    "partition_sink": q_partition_sink,
    "manifest": q_manifest,
    "index_split_sink": q_index_split_sink,
}
