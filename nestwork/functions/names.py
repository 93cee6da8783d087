"""File-name rules as column expressions.

All built-in string functions: they stay in whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def base_name(path) -> Column:
    """Last path segment of a path or URL (fragment and query string kept)."""
    return F.element_at(F.split(_c(path), "/"), -1)


def json_file_name(path) -> Column:
    """Lower-case base name cut at '?': ``*.json.gz``/``*.gz``/``*.gzip`` ->
    ``*.json``, ``*.json`` kept, anything else NULL (not a JSON file)."""
    name = F.substring_index(F.lower(base_name(path)), "?", 1)
    name = F.substring_index(name, "#", 1)
    stem = F.regexp_replace(name, r"(\.json)?\.(gz|gzip)$", "")
    return (F.when(name.rlike(r"\.(gz|gzip)$"), F.concat(stem, F.lit(".json")))
            .when(name.endswith(".json"), name))


def is_json_name(path) -> Column:
    return json_file_name(path).isNotNull()


def url_stem(path) -> Column:
    """Base name of a URL with query/fragment and ``.json``/``.json.gz`` removed."""
    name = F.substring_index(F.substring_index(base_name(path), "?", 1), "#", 1)
    return F.regexp_replace(name, r"(?i)\.json(\.gz|\.gzip)?$", "")


def strip_gz(name) -> Column:
    """Drop a trailing ``.gz``."""
    return F.regexp_replace(_c(name), r"\.gz$", "")


def is_compressed(name) -> Column:
    """Compressed by suffix (query string ignored)."""
    return F.lower(F.substring_index(_c(name), "?", 1)).rlike(r"\.(gz|gzip)$")


def join_path(*parts) -> Column:
    """X11: join path parts with single slashes."""
    joined = F.concat_ws("/", *[_c(p) for p in parts])
    return F.regexp_replace(joined, r"(?<!:)/{2,}", "/")


def safe_category(category) -> Column:
    """Keep letters, digits, space, '-' and '_', trimmed.  When that changes the
    value, a short hash of the original is appended so two categories never share
    a folder."""
    c = F.coalesce(_c(category), F.lit("null"))
    cleaned = F.trim(F.regexp_replace(c, r"[^\p{L}\p{N} _-]", ""))
    return F.when(cleaned == c, cleaned).otherwise(
        F.concat(cleaned, F.lit("_"), F.substring(F.sha2(c, 256), 1, 8)))


def chunk_name(n, prefix: str = "chunk") -> Column:
    """Zero-padded chunk file name."""
    return F.format_string(f"{prefix}_%04d.json", _c(n))


def trimmed(c) -> Column:
    """X17."""
    return F.trim(_c(c))
