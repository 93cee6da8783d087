"""Helpers over semi-structured values.

All of these are built-in Spark expressions; nothing leaves the JVM.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse(text_col) -> Column:
    """``try_parse_json``: NULL for text that is not JSON or has duplicate keys."""
    c = F.col(text_col) if isinstance(text_col, str) else text_col
    return F.try_parse_json(c)


def dotted_to_json_path(path: str) -> str:
    """``a.b.c`` -> ``$.a.b.c`` (keys with odd characters are bracket-quoted)."""
    if path.startswith("$"):
        return path
    out = "$"
    for part in path.split("."):
        if re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", part):
            out += "." + part
        else:
            out += "['" + part.replace("'", "\\'") + "']"
    return out


def get_string(v, path: str) -> Column:
    """Dotted-path lookup returning STRING, NULL when missing."""
    c = F.col(v) if isinstance(v, str) else v
    return F.try_variant_get(c, dotted_to_json_path(path), "string")


def get_path(v, path: str, type_: str) -> Column:
    c = F.col(v) if isinstance(v, str) else v
    return F.try_variant_get(c, dotted_to_json_path(path), type_)


def as_entries(v: str) -> Column:
    """Normalise a value to a list of entries: an array stays, an object (or a
    scalar) becomes a one-element array, JSON null and SQL NULL become empty.
    Row-local: no shuffle."""
    return F.expr(
        f"CASE WHEN {v} IS NULL OR is_variant_null({v}) THEN array() "
        f"ELSE coalesce(try_cast({v} AS ARRAY<VARIANT>), array({v})) END"
    )


def object_entries(v: str) -> Column:
    """Object -> MAP<STRING, VARIANT> (keys in sorted order); NULL otherwise."""
    return F.expr(f"try_cast({v} AS MAP<STRING, VARIANT>)")


def array_items(v: str) -> Column:
    """Array -> ARRAY<VARIANT>; NULL for anything else."""
    return F.expr(f"try_cast({v} AS ARRAY<VARIANT>)")


#: Scalar types as ``schema_of_variant`` writes them; a null fits every type.
SCALAR_TYPES = r"(?:STRING|BIGINT|DOUBLE|FLOAT|BOOLEAN|BINARY|DATE|TIMESTAMP(?:_NTZ)?|UUID|VOID|DECIMAL[(][0-9]+, ?[0-9]+[)])"


def object_pattern(fields: dict[str, str], is_open: bool) -> str:
    """Pattern of a ``schema_of_variant`` text: an object (or null) with any of ``fields``, each of its own pattern.

    An open object may hold other scalar fields too.  Names that need quotes and objects of very many fields do not match."""
    one = [f"{name}: {kind}" for name, kind in fields.items()]
    if is_open:
        known = "|".join(f"{name}: " for name in fields)
        one.append(f"(?!{known})[A-Za-z_][A-Za-z0-9_]*: {SCALAR_TYPES}")
    return f"(?>OBJECT<(?:(?>{'|'.join(one)})(?:, (?>{'|'.join(one)})){{0,100}}+)?>|VOID)"


def array_pattern(item: str) -> str:
    """An array (or null) whose items all match ``item``."""
    return f"(?>ARRAY<{item}>|VOID)"


def fits_sql(value: str, pattern: str) -> str:
    """True where one pass over the VARIANT ``value`` shows that it matches; false means that it has to be walked."""
    return f"coalesce(schema_of_variant({value}) RLIKE '^{pattern}$', false)"
