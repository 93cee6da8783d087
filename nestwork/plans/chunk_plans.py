"""Chunking queries over the rate files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import chunking as ch
from ..sources.bronze import rates_variant_table
from ..sources.rates_docs import BUNDLED, INLINE, UNRESOLVED, rate_sort_key
from ..sources.tables import table

RATE_PATH = "in_network.item.negotiated_rates.item"
PRICE_PATH = "in_network.item.negotiated_rates.item.negotiated_prices.item"
REF_PATH = "provider_references.item"
RATE_CHUNK = 8
REF_CHUNK = 10
CLASS_CHUNK = 5


def rate_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rate files as VARIANT, or typed where the VARIANT parser refuses them."""
    return ch.with_typed_fallback(rates_variant_table(spark, sf_dir), "vdoc", "doc", "has_variant")


def landed_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing folder: rate files and the web pages that failed downloads left behind."""
    pages = table(spark, sf_dir, "pages").select(F.col("url").alias("file_path"), F.try_parse_json("html").alias("doc"))
    return rate_docs(spark, sf_dir).unionByName(pages, allowMissingColumns=True)


def _rate_sum(items: str, price_path: str = "$.negotiated_prices[0].negotiated_rate") -> F.Column:
    return F.round(F.aggregate(items, F.lit(0.0).cast("double"),
                               lambda acc, x: acc + F.coalesce(F.try_variant_get(x, price_path, "double"), F.lit(0.0))), 2)


def q_array_chunks(spark, sf_dir):
    c = ch.array_chunks(rate_docs(spark, sf_dir), RATE_PATH, RATE_CHUNK, typed="typed")
    return c.select("file_path", "json_path", "chunk_id", "chunk_name", "n_objects", "first_pos",
                    _rate_sum("items").alias("sum_rate"))


def q_structured_chunks(spark, sf_dir):
    """The wrapped JSON text is parsed again, and its items are counted and summed."""
    c = ch.structured_chunks(rate_docs(spark, sf_dir), RATE_PATH, RATE_CHUNK, typed="typed")
    back = c.withColumn("back", F.try_parse_json("json")).withColumn(
        "held", F.expr("try_cast(try_variant_get(back, '$.in_network.negotiated_rates', 'variant') AS ARRAY<VARIANT>)"))
    return back.select("file_path", "chunk_name", "n_objects", "wrapper", F.size("held").alias("n_wrapped"), _rate_sum("held").alias("sum_wrapped"),
                       F.expr("array_join(json_object_keys(json), ',')").alias("root_keys"))


def q_multi_path_split(spark, sf_dir):
    cfg = [{"path": RATE_PATH, "output_subdir": "rates", "chunk_size": RATE_CHUNK},
           {"path": REF_PATH, "output_subdir": "providers", "chunk_size": REF_CHUNK}]
    c = ch.multi_path_chunks(rate_docs(spark, sf_dir), cfg, typed="typed")
    return c.select("file_path", "output_subdir", "chunk_id", "chunk_name", "n_objects", "first_pos")


def split_by_class(spark, sf_dir):
    return ch.split_by_field(rate_docs(spark, sf_dir), PRICE_PATH, "billing_class", CLASS_CHUNK, typed="typed")


def q_split_by_field(spark, sf_dir):
    c = split_by_class(spark, sf_dir)
    return c.select("file_path", "category", "category_dir", "chunk_id", "chunk_name", "n_objects", "first_pos",
                    _rate_sum("items", "$.negotiated_rate").alias("sum_rate"))


def q_category_counts(spark, sf_dir):
    return ch.counts_per(split_by_class(spark, sf_dir), ["category"])


def q_chunk_outcomes(spark, sf_dir):
    """Every landed document is chunked, has no items, or is quarantined: the three add up to the documents in."""
    out = ch.outcomes(landed_docs(spark, sf_dir), [RATE_PATH, REF_PATH, "in_network.item.bundled_codes.item"], typed="typed")
    return out.withColumn("complete", F.col("n_documents") == F.col("n_chunked") + F.col("n_without_items") + F.col("n_quarantined"))


_PATH = "'rates/' || l_partkey || '/part-0.json'"
_RATE_POS = f"row_number() OVER (PARTITION BY l_partkey ORDER BY {', '.join(rate_sort_key())}) - 1"
_CLASS = ("CASE WHEN l_linenumber = 7 THEN 'BAD' WHEN l_returnflag = 'R' THEN 'institutional' "
          "WHEN l_returnflag = 'A' THEN 'professional' ELSE 'both' END")
_RATED = f"SELECT l_partkey, l_extendedprice, {_CLASS} AS category, {_RATE_POS} AS rate_pos FROM lineitem"

ORACLE = {
    "array_chunks": f"""
WITH r AS ({_RATED})
SELECT {_PATH} AS file_path, '{RATE_PATH}' AS json_path, CAST(rate_pos // {RATE_CHUNK} + 1 AS INTEGER) AS chunk_id,
       printf('chunk_%04d.json', rate_pos // {RATE_CHUNK} + 1) AS chunk_name, count(*)::INTEGER AS n_objects,
       min(rate_pos) AS first_pos, round(sum(l_extendedprice), 2) AS sum_rate
FROM r GROUP BY l_partkey, rate_pos // {RATE_CHUNK}""",
    "structured_chunks": f"""
WITH r AS ({_RATED})
SELECT {_PATH} AS file_path, printf('structured_%04d.json', rate_pos // {RATE_CHUNK} + 1) AS chunk_name,
       count(*)::INTEGER AS n_objects, 'in_network.negotiated_rates' AS wrapper, count(*)::INTEGER AS n_wrapped,
       round(sum(l_extendedprice), 2) AS sum_wrapped, 'in_network' AS root_keys
FROM r GROUP BY l_partkey, rate_pos // {RATE_CHUNK}""",
    "multi_path_split": f"""
WITH r AS ({_RATED}),
  s AS (SELECT l_partkey, row_number() OVER (PARTITION BY l_partkey ORDER BY l_suppkey) - 1 AS pos
        FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE NOT ({INLINE} OR {UNRESOLVED})))
SELECT {_PATH} AS file_path, 'rates' AS output_subdir, CAST(rate_pos // {RATE_CHUNK} + 1 AS INTEGER) AS chunk_id,
       printf('chunk_%04d.json', rate_pos // {RATE_CHUNK} + 1) AS chunk_name, count(*)::INTEGER AS n_objects,
       min(rate_pos) AS first_pos
FROM r GROUP BY l_partkey, rate_pos // {RATE_CHUNK}
UNION ALL
SELECT {_PATH}, 'providers', CAST(pos // {REF_CHUNK} + 1 AS INTEGER), printf('chunk_%04d.json', pos // {REF_CHUNK} + 1),
       count(*)::INTEGER, min(pos)
FROM s GROUP BY l_partkey, pos // {REF_CHUNK}""",
    "split_by_field": f"""
WITH r AS ({_RATED}),
  c AS (SELECT *, row_number() OVER (PARTITION BY l_partkey, category ORDER BY rate_pos) - 1 AS k FROM r)
SELECT {_PATH} AS file_path, category, 'category_' || category AS category_dir,
       CAST(k // {CLASS_CHUNK} + 1 AS INTEGER) AS chunk_id, printf('%s_%04d.json', category, k // {CLASS_CHUNK} + 1) AS chunk_name,
       count(*)::INTEGER AS n_objects, min(rate_pos) AS first_pos, round(sum(l_extendedprice), 2) AS sum_rate
FROM c GROUP BY l_partkey, category, k // {CLASS_CHUNK}""",
    "category_counts": f"""
WITH r AS ({_RATED}),
  c AS (SELECT l_partkey, category, count(*) AS n FROM r GROUP BY l_partkey, category)
SELECT category, sum(n)::BIGINT AS n_objects, sum(CAST(ceil(n / {CLASS_CHUNK}) AS BIGINT))::BIGINT AS n_chunks
FROM c GROUP BY category""",
}

ORACLE["chunk_outcomes"] = f"""
WITH d AS (SELECT l_partkey, any_value(p_size) AS p_size, bool_or(NOT ({INLINE} OR {UNRESOLVED})) AS has_refs
           FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_partkey),
  n AS (SELECT (SELECT count(*) FROM d) AS docs, (SELECT count(*) FROM pages) AS pages,
               (SELECT count(*) FROM d WHERE has_refs) AS refs, (SELECT count(*) FROM d WHERE {BUNDLED}) AS bundled),
  p AS (SELECT '{RATE_PATH}' AS json_path, docs AS n_chunked, docs, pages FROM n UNION ALL SELECT '{REF_PATH}', refs, docs, pages FROM n
        UNION ALL SELECT 'in_network.item.bundled_codes.item', bundled, docs, pages FROM n)
SELECT json_path, docs + pages AS n_documents, n_chunked, docs - n_chunked AS n_without_items, pages AS n_quarantined, true AS complete FROM p"""

QUERIES = {
    "chunk_outcomes": q_chunk_outcomes,
    "array_chunks": q_array_chunks,
    "structured_chunks": q_structured_chunks,
    "multi_path_split": q_multi_path_split,
    "split_by_field": q_split_by_field,
    "category_counts": q_category_counts,
}
