"""Config-driven ingestion (S17, Q5): one bronze stream per JSON definition.

Definitions are read by Spark (``multiLine`` JSON, one file per
definition), checked with a rule (every parameter present and non-blank), and
only then turned into streams.  The driver loops over definitions, which are
a handful of metadata rows, never over data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.quality import non_empty
from .files import stream_lines, stream_whole_files
from .sinks import stream_to_table

# The keys of one ingestion definition.
DEFINITION_SCHEMA = ("file_type string, file_desc string, file_extention string, cleanSource string, "
                     "cleanSource_retentionDuration string, volume_sub_path string, maxFilesPerTrigger long")
REQUIRED_KEYS = ["file_type", "file_desc", "cleanSource", "cleanSource_retentionDuration", "volume_sub_path"]


def load_definitions(spark: SparkSession, config_dir: str, prefix: str | None = None) -> DataFrame:
    glob = f"{prefix}*.json" if prefix else "*.json"
    defs = spark.read.schema(DEFINITION_SCHEMA).option("multiLine", True).option("pathGlobFilter", glob).json(config_dir)
    return defs.withColumn("valid", non_empty(*REQUIRED_KEYS) & F.col("maxFilesPerTrigger").isNotNull())


def ingest_definitions(spark: SparkSession, defs: DataFrame, landing_root: str, out_root: str,
                       whole_file: bool = True, wait: bool = True) -> dict[str, StreamingQuery]:
    """Start one triggered bronze stream per definition; an invalid one stops the run before any starts."""
    started: dict[str, StreamingQuery] = {}
    rows = defs.collect()  # a few definition rows
    bad = [d.file_type or "(no file_type)" for d in rows if not d.valid]
    if bad:
        raise ValueError(f"invalid ingestion definitions: {', '.join(sorted(bad))}")
    for d in rows:
        src_path = f"{landing_root.rstrip('/')}/{d.volume_sub_path}"
        reader = stream_whole_files if whole_file else stream_lines
        kwargs = {"max_files_per_trigger": d.maxFilesPerTrigger}
        if whole_file:
            kwargs["clean_source"] = d.cleanSource
        stream = reader(spark, src_path, **kwargs)
        name = f"{d.file_type}_bronze"
        started[name] = stream_to_table(stream, f"{out_root}/{name}", f"{out_root}/_checkpoints/{name}",
                                        query_name=name, wait=wait)
    return started
