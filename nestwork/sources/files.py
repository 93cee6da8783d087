"""File readers, batch and streaming.

Every reader is a plain Spark reader; the hidden ``_metadata`` column gives the
file path, name, size, block and modification time next to the data.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.keys import source_id
from .schemas import CORRUPT_COLUMN


def _bronze_columns(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Source id from every metadata field, metadata, ingest and record times."""
    return df.select(
        source_id("_metadata").alias("index_file_source_id"),
        F.col("_metadata").alias("file_metadata"),
        F.current_timestamp().alias("ingest_time"),
        F.col("_metadata.file_modification_time").alias("rcrd_timestamp"),
        F.col(value_col).alias("value"),
    )


def _file_source_options(reader, max_files_per_trigger: int | None, glob: str | None,
                         clean_source: str = "off", archive_dir: str | None = None):
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))  # S2
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if clean_source and clean_source.lower() != "off":  # S3
        reader = reader.option("cleanSource", clean_source.lower())
        if archive_dir:
            reader = reader.option("sourceArchiveDir", archive_dir)
    return reader


def stream_whole_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                       glob: str | None = None, clean_source: str = "off", archive_dir: str | None = None) -> DataFrame:
    """One row per whole file (``wholetext``), with bronze columns."""
    r = spark.readStream.format("text").option("wholetext", True)
    r = _file_source_options(r, max_files_per_trigger, glob, clean_source, archive_dir)
    return _bronze_columns(r.load(path))


def read_whole_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Batch twin of S1 (``format().load()``: ``read.text`` would reset ``wholetext``)."""
    r = spark.read.format("text").option("wholetext", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return _bronze_columns(r.load(path))


def stream_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                 glob: str | None = None, clean_source: str = "off", archive_dir: str | None = None) -> DataFrame:
    """One row per line (JSON Lines documents), with bronze columns."""
    r = _file_source_options(spark.readStream.format("text"), max_files_per_trigger, glob, clean_source, archive_dir)
    return _bronze_columns(r.load(path))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return _bronze_columns(spark.read.format("text").load(path))


def _json_reader(reader, schema: StructType, multi_line: bool, with_corrupt: bool):
    if with_corrupt and CORRUPT_COLUMN not in schema.fieldNames():
        schema = StructType(schema.fields + [StructField(CORRUPT_COLUMN, StringType())])
    return (reader.schema(schema).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT_COLUMN).option("multiLine", multi_line))


def stream_json(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False,
                max_files_per_trigger: int | None = None, glob: str | None = None,
                with_corrupt: bool = True) -> DataFrame:
    """JSON with a declared schema, PERMISSIVE, corrupt rows kept aside
    in ``_corrupt_record`` (gz is decompressed by suffix)."""
    r = _file_source_options(spark.readStream, max_files_per_trigger, glob)
    df = _json_reader(r, schema, multi_line, with_corrupt).json(path)
    return df.select("*", source_id("_metadata").alias("index_file_source_id"),
                     F.col("_metadata").alias("file_metadata"), F.current_timestamp().alias("ingest_time"),
                     F.col("_metadata.file_modification_time").alias("rcrd_timestamp"))


def read_json(spark: SparkSession, path: str, schema: StructType | None = None, multi_line: bool = False,
              primitives_as_string: bool = False) -> DataFrame:
    """Batch JSON (multi-line documents or JSON Lines)."""
    r = spark.read.option("multiLine", multi_line)
    if schema is not None:
        r = _json_reader(r, schema, multi_line, True)
    elif primitives_as_string:
        r = r.option("primitivesAsString", True)
    return r.json(path)


def all_strings(variant_schema: str) -> StructType:
    """The schema text that ``schema_of_variant_agg`` gives, with every leaf (also one whose type differs between documents) as STRING."""
    pieces = re.split(r"(`(?:[^`]|``)*`)", variant_schema)  # quoted names stay as they are
    for i in range(0, len(pieces), 2):
        text = pieces[i].replace("OBJECT<>", "STRING")
        text = re.sub(r"(: ?|ARRAY<)(?!OBJECT<|ARRAY<|STRING)[A-Z_]+(?:\([0-9, ]+\))?", r"\1STRING", text)
        pieces[i] = re.sub(r"(: ?|ARRAY<|^)OBJECT<", r"\1STRUCT<", text)
    parsed = StructType.fromDDL("x " + "".join(pieces))["x"].dataType
    if not isinstance(parsed, StructType):
        raise ValueError("the documents are no objects")
    return parsed


def infer_all_strings(texts: DataFrame, value_col: str = "value") -> StructType:
    """One schema for documents that differ in their fields; a mergeable aggregate, only the schema reaches the driver."""
    return all_strings(texts.agg(F.schema_of_variant_agg(F.try_parse_json(value_col))).first()[0] or "OBJECT<>")


def stream_all_strings(spark: SparkSession, path: str, max_files_per_trigger: int | None = None, whole_files: bool = False) -> DataFrame:
    """JSON documents streamed with the schema that the landed files have now, every leaf a string.

    Documents that don't parse keep NULL fields and their text in ``_corrupt_record``."""
    schema = infer_all_strings((read_whole_files if whole_files else read_lines)(spark, path))
    schema = StructType([*schema.fields, StructField(CORRUPT_COLUMN, StringType())])
    src = (stream_whole_files if whole_files else stream_lines)(spark, path, max_files_per_trigger)
    doc = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN})
    return src.withColumn("doc", doc).select("index_file_source_id", "doc.*")


def rows_from_paths(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, index) rows of a short list of paths, as a job's parameters give it."""
    return spark.createDataFrame([(p, i) for i, p in enumerate(paths)], "path string, index int")


def list_files(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """A directory listing as a DataFrame; contents are pruned from the scan."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path).select("path", "length", "modificationTime")


def parse_json_column(df: DataFrame, column: str, out: str = "doc") -> DataFrame:
    """JSON stored in a string column -> VARIANT (then G1-G4 apply)."""
    return df.withColumn(out, F.try_parse_json(F.col(column)))
