"""Rescue of fields that a declared schema does not hold.

Open Spark has no rescued-data column.  Each document is read twice in its row: typed by the
declared schema, and as a VARIANT.  The VARIANT is walked along the schema with nested ``transform``
calls: keys that the schema lacks and values of another kind than it declares come out with their
paths and their JSON text.  All of it is built-in expressions in one row, so there is no exchange, and it
runs alike in batch and in streams.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import hash_key
from ..functions.variant import SCALAR_TYPES, array_pattern, fits_sql, object_pattern

RESCUED = "_rescued_data"
#: Kinds of VARIANT values that a declared leaf takes; text takes any scalar, as the JSON reader does.
_KINDS = {T.LongType: "^BIGINT$", T.IntegerType: "^BIGINT$", T.DoubleType: "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$", T.BooleanType: "^BOOLEAN$",
          T.StringType: "^(?!OBJECT|ARRAY).*$"}


#: The same kinds in the schema of a whole value, where the items of an array share one type.
_PATTERNS = {T.LongType: "(?:BIGINT|VOID)", T.IntegerType: "(?:BIGINT|VOID)", T.BooleanType: "(?:BOOLEAN|VOID)", T.StringType: SCALAR_TYPES,
             T.DoubleType: "(?:BIGINT|DOUBLE|FLOAT|VOID|DECIMAL[(][0-9]+, ?[0-9]+[)])"}


def schema_pattern(kind: T.DataType) -> str:
    """Pattern of the ``schema_of_variant`` text of values of which ``kind`` holds everything."""
    if isinstance(kind, T.StructType):
        return object_pattern({f.name: schema_pattern(f.dataType) for f in kind.fields}, is_open=False)
    return array_pattern(schema_pattern(kind.elementType)) if isinstance(kind, T.ArrayType) else _PATTERNS[type(kind)]


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


_NONE = "CAST(array() AS ARRAY<STRUCT<path: STRING, json: STRING>>)"


def _found(value: str, path: str) -> str:
    return f"array(struct({path} AS path, to_json({value}) AS json))"


def surplus_sql(value: str, kind: T.DataType, path: str = "'$'", depth: int = 0) -> str:
    """ARRAY<STRUCT<path, json>> of what ``kind`` does not hold of the VARIANT ``value``; missing and null values fit."""
    if isinstance(kind, T.StructType):
        names = ", ".join(_quoted(f.name) for f in kind.fields)
        m, e, p = f"m{depth}", f"e{depth}", f"p{depth}"
        parts = [f"transform(filter(map_entries({m}), {e} -> {e}.key NOT IN ({names})), "
                 f"{e} -> struct(concat({p}, '.', {e}.key) AS path, to_json({e}.value) AS json))"]
        parts += [surplus_sql(f"{m}[{_quoted(f.name)}]", f.dataType, f"concat({p}, {_quoted('.' + f.name)})", depth + 1) for f in kind.fields]
        body = f"transform(array({path}), {p} -> concat({', '.join(parts)}))[0]"
        inner, bad = f"try_cast({value} AS MAP<STRING, VARIANT>)", _found(value, path)
        # most values fit, which one pass over them tells; only others are walked
        return f"CASE WHEN {fits_sql(value, schema_pattern(kind))} THEN {_NONE} ELSE {_bound(value, inner, m, body, bad)} END"
    if isinstance(kind, T.ArrayType):
        a, x, i = f"a{depth}", f"x{depth}", f"i{depth}"
        items = surplus_sql(x, kind.elementType, f"concat({path}, '[', CAST({i} AS STRING), ']')", depth + 1)
        return _bound(value, f"try_cast({value} AS ARRAY<VARIANT>)", a, f"flatten(transform({a}, ({x}, {i}) -> {items}))", _found(value, path))
    return (f"CASE WHEN {value} IS NULL OR is_variant_null({value}) OR schema_of_variant({value}) RLIKE {_quoted(_KINDS[type(kind)])} "
            f"THEN {_NONE} ELSE {_found(value, path)} END")


def _bound(value: str, inner: str, name: str, body: str, bad: str) -> str:
    """``body`` over ``inner`` (bound once); nothing for missing and null values, ``bad`` for values of another kind."""
    return (f"CASE WHEN {value} IS NULL OR is_variant_null({value}) THEN {_NONE} "
            f"ELSE transform(array({inner}), {name} -> CASE WHEN {name} IS NULL THEN {bad} ELSE {body} END)[0] END")


def rescued(variant: str, schema: T.StructType) -> Column:
    """JSON text of the surplus as one object, path to value; NULL if there is none.

    A root that is no object is rescued whole, under ``$``."""
    return F.expr(f"transform(array({surplus_sql(variant, schema)}), s -> CASE WHEN size(s) > 0 THEN "
                  "to_json(map_from_entries(transform(s, e -> struct(e.path, e.json)))) END)[0]")


def unreadable_reason(variant: str, text: str) -> Column:
    """Why a text gave no VARIANT, as the JSON parsers tell it; NULL if it gave one."""
    return (F.when(F.col(variant).isNotNull(), None)
            .when(F.get_json_object(text, "$").isNotNull(), "JSON that a VARIANT cannot hold: too large, or a repeated key")
            .otherwise("not valid JSON"))


def read_with_rescue(texts: DataFrame, schema: T.StructType, value_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """``keep``, the text, ``doc`` (typed), ``_rescued_data`` and ``reason`` (NULL for rows to keep).

    A row is kept if its text is a JSON document, the typed reader took it whole and nothing had to be rescued.
    A document that only the VARIANT parser refuses can't be compared with the schema; it is set aside with that reason.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = texts.select(*keep, F.col(value_col).alias("value"), F.from_json(value_col, with_corrupt, options).alias("doc"),
                          F.try_parse_json(value_col).alias("_v"))
    out = parsed.select(*keep, "value", "doc", rescued("_v", schema).alias(RESCUED), unreadable_reason("_v", "value").alias("_unread"))
    reason = (F.col("_unread").isNotNull(), F.col("_unread")), (F.col(RESCUED).isNotNull(), F.lit("fields outside the schema")), \
        (F.col("doc").isNull() | F.col("doc._corrupt_record").isNotNull(), F.lit("does not fit the schema"))
    case = F.when(*reason[0]).when(*reason[1]).when(*reason[2])
    return out.select(*keep, "value", "doc", RESCUED, case.alias("reason")).withColumn("row_key", hash_key("value"))


def split_writer(root: str):
    """foreachBatch sink: the kept and the set-aside rows of a micro-batch in one pass, one folder each.

    A replayed batch overwrites its own folder."""
    def write(batch: DataFrame, batch_id: int) -> None:
        kept = F.when(F.col("reason").isNull(), "kept").otherwise("quarantine")
        (batch.withColumn("status", kept).write.mode("overwrite").option("compression", "zstd").partitionBy("status")
         .parquet(f"{root}/batch={batch_id}"))
    return write


def split_table(spark, root: str, schema: T.StructType, status: str) -> DataFrame:
    """One side of what ``split_writer`` wrote; the other side's folders are not read."""
    both = T.StructType([*schema.fields, T.StructField("status", T.StringType()), T.StructField("batch", T.IntegerType())])
    return spark.read.schema(both).option("basePath", root).parquet(root).where(F.col("status") == status).drop("status", "batch")
