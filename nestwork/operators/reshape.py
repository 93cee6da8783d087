"""General reshaping operators.

``explode_object`` / ``explode_array`` turn one VARIANT into (pos, key, value)
rows, like SQL ``LATERAL variant_explode``.  ``pivot_values`` is the general
key/value -> columns pivot (a two-phase aggregation with map-side combine);
use the row-local ``try_variant_get`` form instead when the keys are known and
unique per document, since it needs no exchange.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.variant import array_items, as_entries, object_entries


def explode_object(df: DataFrame, v: str, keep: Sequence[str] = (), outer: bool = False) -> DataFrame:
    """Object -> rows (pos, key, value) with keys in sorted order."""
    gen = F.posexplode_outer if outer else F.posexplode
    return df.select(*keep, gen(object_entries(v)).alias("pos", "key", "value"))


def explode_array(df: DataFrame, v: str, keep: Sequence[str] = (), outer: bool = False) -> DataFrame:
    """Array -> rows (pos, key=NULL, value)."""
    gen = F.posexplode_outer if outer else F.posexplode
    return df.select(*keep, gen(array_items(v)).alias("pos", "value")).select(
        *keep, "pos", F.lit(None).cast("string").alias("key"), "value")


def explode_entries(df: DataFrame, v: str, keep: Sequence[str] = (), outer: bool = False) -> DataFrame:
    """Array or single object -> rows (pos, value); an object counts as one entry."""
    gen = F.posexplode_outer if outer else F.posexplode
    return df.select(*keep, gen(as_entries(v)).alias("pos", "value"))


def explode_if_present(df: DataFrame, column: str, alias: str, outer: bool = False) -> DataFrame:
    """explode ``column`` when the frame has it, else add a NULL column."""
    if column in df.columns:
        gen = F.explode_outer if outer else F.explode
        return df.withColumn(alias, gen(F.col(column)))
    return df.withColumn(alias, F.lit(None))


def pivot_values(df: DataFrame, group_cols: Sequence[str], key_col: str, value_col: str,
                 keys: Iterable[str], agg: str = "max") -> DataFrame:
    """Pivot (key, value) rows into one column per key, grouping on ``group_cols``.

    Values are read as strings.  ``agg='max'`` gives an order-free answer;
    ``agg='first'`` keeps the first non-NULL value seen (order-dependent).
    """
    keys = list(keys)
    value = F.col(value_col)
    if dict(df.dtypes)[value_col] == "variant":
        value = F.expr(f"try_variant_get({value_col}, '$', 'string')")
    prepared = df.select(*group_cols, F.col(key_col).alias("_k"), value.alias("_v"))
    fn = (lambda c: F.first(c, ignorenulls=True)) if agg == "first" else F.max
    return prepared.groupBy(*group_cols).pivot("_k", keys).agg(fn("_v"))
