"""Profiles and structure discovery.

``column_profile`` computes every column's statistics in ONE aggregation
(partial aggregation map-side, one tiny exchange) and stacks the single result
row into one row per column.  ``array_paths`` walks documents level by level
with one generator per level: an array is recorded once (without its value) and
its children are expanded, so the plan is a straight chain with no re-scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def column_profile(df: DataFrame, columns: Sequence[str] | None = None, approx_distinct: bool = False,
                   rsd: float = 0.05) -> DataFrame:
    """One row per column: n_rows, n_nulls, min_value, max_value (as text) and,
    optionally, ``approx_distinct`` (HyperLogLog++, mergeable)."""
    columns = list(columns or df.columns)
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(columns):
        aggs += [F.count_if(F.col(c).isNull()).alias(f"z{i}"),
                 F.min(c).cast("string").alias(f"lo{i}"), F.max(c).cast("string").alias(f"hi{i}")]
        if approx_distinct:
            aggs.append(F.approx_count_distinct(c, rsd).alias(f"d{i}"))
    one = df.agg(*aggs)
    fields = ["column_name", "n_rows", "n_nulls", "min_value", "max_value"] + (["approx_distinct"] if approx_distinct else [])
    rows = []
    for i, c in enumerate(columns):
        parts = [f"'{c}'", "n", f"z{i}", f"lo{i}", f"hi{i}"] + ([f"d{i}"] if approx_distinct else [])
        rows.append(", ".join(parts))
    return one.select(F.expr(f"stack({len(columns)}, {', '.join(rows)}) AS ({', '.join(fields)})"))


#: lg of the sketch's size: a relative standard error of about 0.8 %.
SKETCH_LG = 14


def part_profiles(df: DataFrame, columns: Sequence[str] | None = None, part: str | Column = "part") -> DataFrame:
    """A5, stored by part (file, day, batch): part, column_name, n_rows, n_nulls, min and max as text, and a distinct-count sketch.

    Partial aggregation with one row per part and column; parts may be added or replaced on their own."""
    columns = list(columns or df.columns)
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(columns):
        aggs += [F.count_if(F.col(c).isNull()).alias(f"z{i}"), F.min(c).cast("string").alias(f"lo{i}"), F.max(c).cast("string").alias(f"hi{i}"),
                 F.min(_sortable(df, c)).alias(f"a{i}"), F.max(_sortable(df, c)).alias(f"b{i}"),
                 F.hll_sketch_agg(F.col(c).cast("string"), F.lit(SKETCH_LG)).alias(f"s{i}")]
    one = df.groupBy((F.col(part) if isinstance(part, str) else part).alias("part")).agg(*aggs)
    rows = ", ".join(f"'{c}', n, z{i}, lo{i}, hi{i}, a{i}, b{i}, s{i}" for i, c in enumerate(columns))
    names = "column_name, n_rows, n_nulls, min_value, max_value, min_key, max_key, sketch"
    return one.select("part", F.expr(f"stack({len(columns)}, {rows}) AS ({names})"))


def _sortable(df: DataFrame, column: str) -> Column:
    """A number by which values of any part compare (NULL for text, which compares as it is)."""
    kind = dict(df.dtypes)[column]
    if kind in ("timestamp", "timestamp_ntz", "date"):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    return F.lit(None).cast("double") if kind in ("string", "boolean", "binary") else F.col(column).cast("double")


def merged_profile(parts: DataFrame) -> DataFrame:
    """Part profiles as one row per column: exact counts, minimum and maximum, and the merged sketch's estimate."""
    low = F.min_by("min_value", F.struct("min_key", "min_value"))
    high = F.max_by("max_value", F.struct("max_key", "max_value"))
    return parts.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"),
        low.alias("min_value"), high.alias("max_value"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx_distinct"))


_CHILDREN = """
CASE WHEN _items IS NOT NULL THEN concat(
  array(struct(_path AS path, CAST(NULL AS VARIANT) AS v, true AS rec)),
  transform(_items, x -> struct(CASE WHEN _path = '' THEN 'item' ELSE _path || '.item' END AS path, x AS v, false AS rec)))
ELSE coalesce(transform(map_entries(try_cast(_v AS MAP<STRING, VARIANT>)),
  e -> struct(CASE WHEN _path = '' THEN e.key ELSE _path || '.' || e.key END AS path, e.value AS v, false AS rec)), array()) END"""


def nesting(docs: DataFrame, doc: str = "doc") -> int:
    """The deepest nesting of any document, from the brackets of its inferred schema (one aggregation)."""
    brackets = F.split(F.regexp_replace(F.schema_of_variant(doc), "[^<>]", ""), "")
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(acc, c):
        now = acc["now"] + F.when(c == "<", 1).when(c == ">", -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(acc["most"], now).alias("most"))

    return docs.agg(F.max(F.aggregate(brackets, start, step, lambda acc: acc["most"])).alias("d")).first()["d"] or 0


def array_paths(docs: DataFrame, doc: str = "doc", key: str = "file_path", limit: int | None = None) -> DataFrame:
    """Every distinct array path (``a.item.b.item`` form) with the number of
    documents that contain it, at any depth.  ``limit`` keeps the first paths in
    path order (L1); by default every path is returned."""
    levels = nesting(docs, doc)
    nodes = docs.select(F.col(key).alias("_key"), F.lit("").alias("_path"), F.col(doc).alias("_v"), F.lit(False).alias("_rec"))
    for _ in range(levels + 1):
        nodes = nodes.withColumn("_items", F.expr("try_cast(_v AS ARRAY<VARIANT>)")).select("_key", F.explode(
            F.when(F.col("_rec"), F.array(F.struct(F.col("_path").alias("path"), F.lit(None).cast("variant").alias("v"),
                                                   F.lit(True).alias("rec"))))
            .otherwise(F.expr(_CHILDREN))).alias("n")).select(
            "_key", F.col("n.path").alias("_path"), F.col("n.v").alias("_v"), F.col("n.rec").alias("_rec"))
    found = nodes.where(F.col("_rec")).select(
        "_key", F.when(F.col("_path") == "", F.lit("item")).otherwise(F.concat("_path", F.lit(".item"))).alias("path"))
    out = (found.distinct().groupBy("path").agg(F.count(F.lit(1)).alias("n_docs"))
           .withColumn("depth", F.size(F.filter(F.split("path", r"\."), lambda x: x == "item"))))
    return out.orderBy("path").limit(limit) if limit else out


def root_type(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """Root kind per document ('object', 'array', scalar type name) with counts."""
    kind = F.expr(f"CASE WHEN {doc} IS NULL THEN 'not JSON' "
                  f"WHEN try_cast({doc} AS MAP<STRING, VARIANT>) IS NOT NULL THEN 'object' "
                  f"WHEN try_cast({doc} AS ARRAY<VARIANT>) IS NOT NULL THEN 'array' "
                  f"ELSE lower(schema_of_variant({doc})) END")
    return docs.groupBy(kind.alias("root_type")).agg(F.count(F.lit(1)).alias("n_docs"))
