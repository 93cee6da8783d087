"""Bronze tables: the landed documents, written once as parquet under the
shared checkpoint folder and read by every later stage (the reference keeps
its bronze stage as a stored table too).

Writing cuts the lineage (no re-build of the documents per query, nothing
kept in executor memory, so a lost executor costs a re-read, not a re-build),
and the stored columns let Catalyst prune: the typed rate documents are read
leaf by leaf (nested schema pruning), the VARIANT of rate files is never re-parsed.
Index files are kept as text and parsed where they are read: a VARIANT beside it doubles what is written.
Rate files are kept as text, and as typed and VARIANT forms of their own: a query pays for the form it reads.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import hash_key
from ..session import NO_OLD_SHUFFLES, scratch_path, with_settings
from .change_log import change_log
from .index_docs import index_documents
from .rates_docs import rates_documents
from .schemas import RATES_SCHEMA_WITH_CORRUPT
from .tables import table, tasks_for

#: A VARIANT is stored as it is: all readers walk it whole, and shredding it into columns costs more than parsing it, on writing and on reading.
WHOLE_VARIANTS = {"spark.sql.variant.inferShreddingSchema": "false"}

_WRITTEN: dict[tuple[str, str, str], str] = {}

JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}


def enough_partitions(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """A setting by which the joins under a builder have partitions that grow with the lines (AQE joins small ones and splits hot ones)."""
    now = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return {"spark.sql.shuffle.partitions": str(max(now, tasks_for(table(spark, sf_dir, "lineitem"))))}


def materialized(spark: SparkSession, name: str, sf_dir: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Write ``build()`` once per application and source folder; read it back.

    The builders hash-spread their rows over ``tasks_for`` tasks, a file each, and the documents are
    parsed and written where they were grouped: every later stage explodes each document into many rows,
    so balanced input files (not AQE-coalesced, skewed ones) decide its parallelism, and no file or task
    grows with the table.  The hash is deterministic, so a retried task writes the same rows."""
    key = (spark.sparkContext.applicationId, name, sf_dir.rstrip("/"))
    path = _WRITTEN.get(key)
    if path is None:
        path = scratch_path(spark, f"bronze-{name}")
        with with_settings(spark, WHOLE_VARIANTS | NO_OLD_SHUFFLES | enough_partitions(spark, sf_dir)):
            build().write.mode("overwrite").option("compression", "zstd").parquet(path)
        _WRITTEN[key] = path
    return spark.read.parquet(path)


def index_bronze_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(index_file_source_id, file_path, value, doc VARIANT) per index file; the text is stored, the VARIANT is parsed where it is read."""
    def build():
        docs = index_documents(spark, sf_dir)
        return docs.select(hash_key("file_path").alias("index_file_source_id"), "file_path", "value")
    return materialized(spark, "index", sf_dir, build).withColumn("doc", F.try_parse_json("value"))


def rates_bronze_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_path, value) per rate file."""
    return materialized(spark, "rates", sf_dir, lambda: rates_documents(spark, sf_dir))


def rates_typed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_path, doc typed struct with _corrupt_record) per rate file; written only where a query reads the typed form."""
    def build():
        doc = F.from_json("value", RATES_SCHEMA_WITH_CORRUPT, JSON_OPTIONS)
        return rates_bronze_table(spark, sf_dir).select("file_path", doc.alias("doc"))
    return materialized(spark, "rates_typed", sf_dir, build)


def rates_variant_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_path, doc, vdoc VARIANT, has_variant) per rate file.

    ``has_variant`` is false for documents that the VARIANT parser refuses (too large, repeated keys): only
    these are read by the typed parser too, into ``doc``, and a filter on it skips row groups by their statistics."""
    def build():
        parsed = rates_bronze_table(spark, sf_dir).select("file_path", "value", F.try_parse_json("value").alias("vdoc"))
        refused = F.when(F.col("vdoc").isNull(), F.col("value"))
        return parsed.select("file_path", F.from_json(refused, RATES_SCHEMA_WITH_CORRUPT, JSON_OPTIONS).alias("doc"), "vdoc",
                             F.col("vdoc").isNotNull().alias("has_variant"))
    return materialized(spark, "rates_variant", sf_dir, build)


def change_log_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change feed as an append-only table, range-clustered on
    (_commit_version, event_id): each file holds a contiguous version range, so
    a version filter skips files and row groups from parquet statistics.  (A
    folder per version would explode at scale; statistics do not.)"""
    def build():
        n = tasks_for(table(spark, sf_dir, "events"))
        return (change_log(spark, sf_dir).repartitionByRange(n, "_commit_version", "event_id")
                .sortWithinPartitions("_commit_version", "event_id"))
    return materialized(spark, "change_log", sf_dir, build)
