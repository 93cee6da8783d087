"""Array chunking.

A JSON path in the splitter's dotted form (``in_network.item.negotiated_rates.item``;
``item`` = every element of an array) selects items in document order.  Items
are gathered inside each document row with ``transform``/``flatten`` and cut
with ``slice``: chunk numbers are local to the document, so there is no global
sort and no exchange.  Splitting by a field sorts (category, position) pairs
inside the row, O(n log n), then slices each category's run the same way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import safe_category
from ..functions.variant import dotted_to_json_path


def _let(value_sql: str, name: str, body_sql: str) -> str:
    """Bind ``value_sql`` once to the lambda variable ``name`` for ``body_sql``."""
    return f"transform(array({value_sql}), {name} -> {body_sql})[0]"


def items_sql(doc: str, json_path: str) -> str:
    """SQL for ARRAY<VARIANT> of the items a dotted path selects, in document order."""
    cur = f"array({doc})"
    for i, seg in enumerate(json_path.split(".")):
        v = f"n{i}"
        if seg == "item":
            cur = f"flatten(transform({cur}, {v} -> coalesce(try_cast({v} AS ARRAY<VARIANT>), array())))"
        else:
            key = dotted_to_json_path(seg)
            cur = (f"filter(transform({cur}, {v} -> try_variant_get({v}, '{key}', 'variant')), "
                   f"{v}x -> {v}x IS NOT NULL)")
    return cur


def typed_items_sql(doc: str, json_path: str) -> str:
    """The same items from a typed document, each made a VARIANT of its own: no VARIANT holds the whole
    document, so its size limit does not matter.  The path must exist in the declared schema."""
    cur = f"array({doc})"
    for i, seg in enumerate(json_path.split(".")):
        v = f"t{i}"
        cur = f"flatten({cur})" if seg == "item" else f"transform({cur}, {v} -> {v}.{seg})"
        cur = f"filter({cur}, {v}x -> {v}x IS NOT NULL)"
    return f"transform({cur}, t -> to_variant_object(t))"


def any_items_sql(doc: str, json_path: str, typed: str | None) -> str:
    """Items of the VARIANT, or of the typed document where there is no VARIANT."""
    if typed is None:
        return items_sql(doc, json_path)
    return (f"CASE WHEN {doc} IS NOT NULL THEN {items_sql(doc, json_path)} "
            f"WHEN {typed} IS NOT NULL THEN {typed_items_sql(typed, json_path)} ELSE array() END")


def with_typed_fallback(bronze: DataFrame, variant: str, typed: str, flag: str, keep: Sequence[str] = ("file_path",),
                        corrupt: str = "_corrupt_record") -> DataFrame:
    """``keep``, ``doc`` (VARIANT) and ``typed`` (only where there is no VARIANT and the typed reader took the text).

    The two kinds are read side by side, so the wide typed column is read only from row groups that hold
    a document without a VARIANT."""
    kind = bronze.schema[typed].dataType.simpleString()
    have = bronze.where(F.col(flag)).select(*keep, F.col(variant).alias("doc"), F.lit(None).cast(kind).alias("typed"))
    rest = bronze.where(~F.coalesce(F.col(flag), F.lit(False))).select(
        *keep, F.lit(None).cast("variant").alias("doc"),
        F.when(F.col(f"{typed}.{corrupt}").isNull(), F.col(typed)).cast(kind).alias("typed"))
    return have.unionByName(rest)


def outcomes(docs: DataFrame, json_paths: Sequence[str], doc: str = "doc", typed: str | None = None) -> DataFrame:
    """Per path: documents in, chunked, without items, and quarantined (neither form could be read).  One pass."""
    read = F.col(doc).isNotNull() if typed is None else F.col(doc).isNotNull() | F.col(typed).isNotNull()
    sizes = F.array(*[F.struct(F.lit(p).alias("json_path"), F.expr(f"size({any_items_sql(doc, p, typed)})").alias("n")) for p in json_paths])
    rows = docs.select(read.alias("read"), F.explode(sizes).alias("s")).select("read", "s.*")
    return rows.groupBy("json_path").agg(
        F.count(F.lit(1)).alias("n_documents"), F.count_if(F.col("read") & (F.col("n") > 0)).alias("n_chunked"),
        F.count_if(F.col("read") & (F.col("n") <= 0)).alias("n_without_items"), F.count_if(~F.col("read")).alias("n_quarantined"))


def _chunks_sql(arr: str, size: int) -> str:
    """ARRAY<ARRAY<...>>: consecutive slices of ``size`` (none for an empty array)."""
    return (f"CASE WHEN size({arr}) <= 0 THEN array() ELSE "
            f"transform(sequence(0, CAST(ceil(size({arr}) / {size}) AS INT) - 1), "
            f"c -> slice({arr}, c * {size} + 1, {size})) END")


def wrapper_keys(json_path: str) -> list[str]:
    """Parent keys of a path with whole ``item`` segments dropped."""
    return [p for p in json_path.split(".") if p != "item"]


def array_chunks(docs: DataFrame, json_path: str, chunk_size: int = 1000, first_chunk: int = 1,
                 doc: str = "doc", keep: Sequence[str] = ("file_path",), prefix: str = "chunk",
                 typed: str | None = None) -> DataFrame:
    """One row per (document, chunk) with its items (ARRAY<VARIANT>)."""
    keep = list(keep)
    chunks = F.expr(_let(any_items_sql(doc, json_path, typed), "its", _chunks_sql("its", chunk_size)))
    out = docs.select(*keep, F.posexplode(chunks).alias("_c", "items"))
    chunk_id = F.col("_c") + F.lit(first_chunk)
    return out.select(
        *keep, F.lit(json_path).alias("json_path"), chunk_id.cast("int").alias("chunk_id"),
        F.format_string(f"{prefix}_%04d.json", chunk_id).alias("chunk_name"),
        F.size("items").alias("n_objects"),
        (F.col("_c") * F.lit(chunk_size)).cast("bigint").alias("first_pos"),
        "items",
    )


def chunk_json(items: str = "items") -> Column:
    """Compact JSON text of a chunk."""
    return F.to_json(F.col(items))


def structured_json(json_path: str, items: str = "items") -> Column:
    """The chunk re-wrapped in its parent path, e.g. {"data": {"records": [...]}}."""
    text = F.to_json(F.col(items))
    for key in reversed(wrapper_keys(json_path)):
        text = F.concat(F.lit('{"' + key.replace('"', '\\"') + '":'), text, F.lit("}"))
    return text


def structured_chunks(docs: DataFrame, json_path: str, chunk_size: int = 1000, first_chunk: int = 1,
                      doc: str = "doc", keep: Sequence[str] = ("file_path",), typed: str | None = None) -> DataFrame:
    """Chunks named ``structured_NNNN.json`` with the wrapped JSON text."""
    out = array_chunks(docs, json_path, chunk_size, first_chunk, doc, keep, prefix="structured", typed=typed)
    return out.withColumn("wrapper", F.lit(".".join(wrapper_keys(json_path)))).withColumn(
        "json", structured_json(json_path))


def multi_path_chunks(docs: DataFrame, path_configs: Sequence[dict], first_chunk: int = 1, doc: str = "doc",
                      keep: Sequence[str] = ("file_path",), typed: str | None = None) -> DataFrame:
    """Several paths in ONE pass over the documents, each with its own
    output folder and chunk size (``path``, ``output_subdir``, ``chunk_size``)."""
    keep = list(keep)
    per_path = []
    for cfg in path_configs:
        path, size = cfg["path"], int(cfg.get("chunk_size", 1000))
        sub = cfg.get("output_subdir", path.replace(".", "_"))
        per_path.append(
            f"struct('{path}' AS json_path, '{sub}' AS output_subdir, "
            f"{_let(any_items_sql(doc, path, typed), 'its', _chunks_sql('its', size))} AS chunks, {size} AS chunk_size)")
    step = docs.select(*keep, F.explode(F.expr(f"array({', '.join(per_path)})")).alias("p"))
    out = step.select(*keep, "p.json_path", "p.output_subdir", "p.chunk_size",
                      F.posexplode("p.chunks").alias("_c", "items"))
    chunk_id = F.col("_c") + F.lit(first_chunk)
    return out.select(
        *keep, "json_path", "output_subdir", chunk_id.cast("int").alias("chunk_id"),
        F.format_string("chunk_%04d.json", chunk_id).alias("chunk_name"),
        F.size("items").alias("n_objects"),
        (F.col("_c") * F.col("chunk_size")).cast("bigint").alias("first_pos"), "items",
    )


def split_by_field(docs: DataFrame, json_path: str, split_field: str, chunk_size: int = 1000,
                   first_chunk: int = 1, doc: str = "doc", keep: Sequence[str] = ("file_path",),
                   typed: str | None = None) -> DataFrame:
    """Items grouped by the value at ``split_field`` (dotted, NULL -> 'null'),
    each category cut into chunks in document order."""
    keep = list(keep)
    field = dotted_to_json_path(split_field)
    cat = f"coalesce(try_variant_get(x, '{field}', 'string'), CAST(try_variant_get(x, '{field}', 'variant') AS STRING), 'null')"
    runs = _let(
        any_items_sql(doc, json_path, typed), "its",
        _let(f"array_sort(transform(its, (x, i) -> struct({cat} AS c, i AS p)))", "s",
             "CASE WHEN size(s) = 0 THEN array() ELSE " +
             _let("filter(sequence(0, size(s) - 1), i -> i = 0 OR s[i].c <> s[i - 1].c)", "b",
                  "transform(b, (st, j) -> struct(s[st].c AS category, "
                  "transform(slice(s, st + 1, (CASE WHEN j + 1 < size(b) THEN b[j + 1] ELSE size(s) END) - st), "
                  "e -> struct(e.p AS pos, its[e.p] AS item)) AS run))") + " END"))
    step = docs.select(*keep, F.explode(F.expr(runs)).alias("r"))
    out = step.select(*keep, F.col("r.category").alias("category"),
                      F.posexplode(F.expr(_chunks_sql("r.run", chunk_size))).alias("_c", "entries"))
    chunk_id = F.col("_c") + F.lit(first_chunk)
    safe = safe_category(F.col("category"))
    return out.select(
        *keep, F.lit(split_field).alias("split_field"), "category",
        F.concat(F.lit("category_"), safe).alias("category_dir"),
        chunk_id.cast("int").alias("chunk_id"),
        F.format_string("%s_%04d.json", safe, chunk_id).alias("chunk_name"),
        F.size("entries").alias("n_objects"),
        F.col("entries")[0]["pos"].cast("bigint").alias("first_pos"),
        F.transform("entries", lambda e: e["item"]).alias("items"),
    )


def counts_per(chunks: DataFrame, by: Sequence[str]) -> DataFrame:
    """A3/A4: objects and chunks per path or category (partial aggregation)."""
    return chunks.groupBy(*by).agg(F.sum("n_objects").alias("n_objects"), F.count(F.lit(1)).alias("n_chunks"))


def lookup(v: str, dotted: str) -> Column:
    """Dotted path lookup on a VARIANT, NULL when missing."""
    return F.try_variant_get(F.col(v), dotted_to_json_path(dotted), "string")
