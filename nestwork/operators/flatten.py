"""Flatten index documents into file rows.

Row-local by design: every step is a generator over one document row
(``posexplode`` of a VARIANT cast to array or map), so the plan has no
exchange and works the same in batch and in streams.  The reference pivots
key/value rows per level, which needs a shuffle and streaming state; reading
the known leaves with ``try_variant_get`` gives the same columns without one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import hash_key
from .rescue import unreadable_reason
from ..functions.variant import array_items, as_entries, get_path, get_string, object_entries

# The leaf keys of an index entry, and the file types of a structure element.
ENTRY_LEAVES = ("description", "plan_id_type", "plan_id", "plan_market_type", "plan_name", "location")
FILE_TYPES = ("in_network_files", "reporting_plans", "allowed_amount_file")

FLAT_COLUMNS = [
    "index_file_source_id", "reporting_entity_name", "reporting_entity_type", "file_type",
    "structure_pos", "entry_pos", "file_description", "file_location",
    "reporting_plan_id_type", "reporting_plan_id", "reporting_plan_market_type", "reporting_plan_name",
]


def parse_documents(bronze: DataFrame, value_col: str = "value", keep=("index_file_source_id",)) -> DataFrame:
    """Add ``doc`` (VARIANT) next to the kept columns; bad JSON gives NULL."""
    return bronze.select(*keep, F.try_parse_json(F.col(value_col)).alias("doc"))


def _structure_array(doc: str = "doc") -> Column:
    return array_items(f"try_variant_get({doc}, '$.reporting_structure', 'variant')")


def quarantine_reason(doc: str = "doc", text: str | None = None) -> Column:
    """Why a parsed document cannot be flattened, or NULL when it can; a text without a VARIANT is
    read again by the streaming JSON parser, which tells broken JSON from JSON that a VARIANT cannot hold."""
    unread = unreadable_reason(doc, text) if text else F.when(F.col(doc).isNull(), F.lit("not valid JSON"))
    return F.coalesce(
        unread,
        F.when(object_entries(doc).isNull(), F.lit("root is not an object"))
        .when(F.expr(f"try_variant_get({doc}, '$.reporting_structure', 'variant')").isNull(),
              F.lit("no reporting_structure"))
        .when(_structure_array(doc).isNull(), F.lit("reporting_structure is not an array"))
    )


def flatten_parsed(parsed: DataFrame, carry=("index_file_source_id",)) -> DataFrame:
    """Documents with a ``doc`` VARIANT column -> one row per (structure, file type, entry)."""
    carry = list(carry)
    level1 = parsed.select(
        *carry,
        get_string("doc", "reporting_entity_name").alias("reporting_entity_name"),
        get_string("doc", "reporting_entity_type").alias("reporting_entity_type"),
        F.posexplode(_structure_array("doc")).alias("structure_pos", "structure"),
    )
    level2 = level1.select(
        *carry, "reporting_entity_name", "reporting_entity_type", "structure_pos",
        F.explode(object_entries("structure")).alias("file_type", "file_value"),
    )
    level3 = level2.select(
        *carry, "reporting_entity_name", "reporting_entity_type", "file_type", "structure_pos",
        F.posexplode(as_entries("file_value")).alias("entry_pos", "entry"),
    )
    return level3.select(
        *carry, "reporting_entity_name", "reporting_entity_type", "file_type",
        F.col("structure_pos").cast("bigint").alias("structure_pos"),
        F.col("entry_pos").cast("bigint").alias("entry_pos"),
        get_string("entry", "description").alias("file_description"),
        get_string("entry", "location").alias("file_location"),
        get_string("entry", "plan_id_type").alias("reporting_plan_id_type"),
        get_string("entry", "plan_id").alias("reporting_plan_id"),
        get_string("entry", "plan_market_type").alias("reporting_plan_market_type"),
        get_string("entry", "plan_name").alias("reporting_plan_name"),
    )


def flatten_index(bronze: DataFrame, value_col: str = "value", carry=("index_file_source_id",)) -> DataFrame:
    """Bronze rows (source id + JSON text) -> flat file rows of every type."""
    return flatten_parsed(parse_documents(bronze, value_col, keep=carry), carry)


def index_quarantine(bronze: DataFrame, value_col: str = "value",
                     carry=("index_file_source_id",)) -> DataFrame:
    """Documents that cannot be flattened, with the reason; nothing vanishes silently."""
    parsed = bronze.select(*carry, F.try_parse_json(F.col(value_col)).alias("doc"), F.col(value_col).alias("_text"))
    return (parsed.select(*carry, quarantine_reason("doc", "_text").alias("reason"))
            .where(F.col("reason").isNotNull()))


def in_network_file_index(flat: DataFrame) -> DataFrame:
    """F1 prefix filter + key: one row per in-network file entry."""
    rows = flat.where(F.col("file_type").startswith("in_network"))
    return rows.select(
        hash_key("index_file_source_id", "reporting_entity_name", "reporting_entity_type", "file_type",
                 "file_description", "file_location", "structure_pos", "entry_pos").alias("in_network_file_index_id"),
        "index_file_source_id", "reporting_entity_name", "reporting_entity_type", "file_type",
        "file_description", "file_location", "structure_pos", "entry_pos",
    )


def reporting_plans(flat: DataFrame) -> DataFrame:
    rows = flat.where(F.col("file_type").startswith("reporting"))
    return rows.select(
        hash_key("index_file_source_id", "reporting_entity_name", "reporting_entity_type", "file_type",
                 "reporting_plan_id_type", "reporting_plan_id", "reporting_plan_market_type",
                 "reporting_plan_name", "file_description", "file_location",
                 "structure_pos", "entry_pos").alias("reporting_plan_index_id"),
        "index_file_source_id", "reporting_entity_name", "reporting_entity_type", "file_type",
        "reporting_plan_id_type", "reporting_plan_id", "reporting_plan_market_type", "reporting_plan_name",
        "file_description", "file_location", "structure_pos", "entry_pos",
    )


def allowed_amount_file_index(flat: DataFrame) -> DataFrame:
    rows = flat.where(F.col("file_type").startswith("allowed"))
    return rows.select(
        hash_key("index_file_source_id", "reporting_entity_name", "reporting_entity_type", "file_type",
                 "file_description", "file_location", "structure_pos", "entry_pos").alias("allowed_amount_file_index_id"),
        "index_file_source_id", "reporting_entity_name", "reporting_entity_type", "file_type",
        "file_description", "file_location", "structure_pos", "entry_pos",
    )
