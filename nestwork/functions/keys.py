"""Surrogate keys.

Keys are SHA-256 over the parts joined with a unit separator, with a fixed
token standing in for NULL, so a NULL part never blanks the key and parts
cannot slide into each other (``('ab','c')`` differs from ``('a','bc')``).
DuckDB's ``sha256`` returns the same lower-case hex, so oracles can rebuild
every key.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Part separator and NULL token (ASCII unit and record separators).
KEY_SEPARATOR = "\x1f"
NULL_TOKEN = "\x1e"


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_safe_concat(*cols) -> Column:
    """``concat_ws`` over string casts, NULL parts replaced by a token."""
    parts = [F.coalesce(_as_col(c).cast("string"), F.lit(NULL_TOKEN)) for c in cols]
    return F.concat_ws(KEY_SEPARATOR, *parts)


def hash_key(*cols) -> Column:
    """SHA-256 hex key over the given columns (NULL-safe, separator-safe)."""
    return F.sha2(null_safe_concat(*cols), 256)


def source_id(metadata_col: str = "file_metadata") -> Column:
    """Key of one source file: path, name, size and time, the same however the file is split."""
    fields = ["file_path", "file_name", "file_size", "file_modification_time"]
    return hash_key(*[F.col(f"{metadata_col}.{f}") for f in fields])


def sql_hash_key(*exprs: str) -> str:
    """The same key as DuckDB SQL text, for oracle queries."""
    parts = ", ".join(f"coalesce(CAST({e} AS VARCHAR), chr(30))" for e in exprs)
    return f"sha256(concat_ws(chr(31), {parts}))"
