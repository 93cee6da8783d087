"""Writers (K1-K8, K10, K11).

Streams are written with ``availableNow`` (triggered, not continuous) and a
checkpoint; batch outputs use Spark's file commit protocol.  Paths are always
under caller-given shared storage, never a machine-local folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


#: For writers of very many files into a new folder: each task moves its own files when it commits, instead of
#: the driver moving all of them one by one; the folder is read only after the job has ended.  In a local folder
#: (other stores are not concerned) files come without checksum files, which double the files and the time.
MANY_FILES = {"mapreduce.fileoutputcommitter.algorithm.version": "2",
              "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}

#: Files of one document each that one task writes, at most and about.
FILES_PER_TASK = 2000


def write_document_files(texts: DataFrame, path: str, key: str, tasks: int, **options: str) -> None:
    """One text file for each row, written by ``tasks`` tasks: the time goes into files, not bytes, so a small table is spread too."""
    texts.repartition(tasks, key).write.options(**MANY_FILES, **options).option("maxRecordsPerFile", 1).text(path)


def stream_to_table(df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (),
                    fmt: str = "parquet", query_name: str | None = None, wait: bool = True) -> StreamingQuery:
    """Append a stream to a table folder, processing what is available now."""
    w = df.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode("append")
    if fmt == "parquet":
        w = w.option("compression", "zstd")  # keys are hex text, of which the default codec saves nothing
    if partition_by:
        w = w.partitionBy(*partition_by)
    if query_name:
        w = w.queryName(query_name)
    q = w.trigger(availableNow=True).start(path)
    if wait:
        q.awaitTermination()
    return q


def conform(df: DataFrame, schema_ddl: str, defaults: dict | None = None) -> DataFrame:
    """K2: select and cast to a declared schema; missing columns take their default."""
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(schema_ddl)
    defaults = defaults or {}
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            c = F.col(f.name).cast(f.dataType)
        else:
            c = (defaults.get(f.name) if f.name in defaults else F.lit(None)).cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def append_table(df: DataFrame, name: str) -> None:
    """K3: append to a named catalog table."""
    df.write.mode("append").saveAsTable(name)


def write_json_chunks(df: DataFrame, path: str, max_records: int = 1000, partitions: int | None = None, **options: str) -> None:
    """K4/K6: JSON files of at most ``max_records`` rows each (no counting pass)."""
    if partitions:
        df = df.repartition(partitions)
    df.write.mode("overwrite").options(**MANY_FILES, **options).option("maxRecordsPerFile", int(max_records)).json(path)


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = "json",
                      max_records: int | None = None, **options: str) -> None:
    """One folder per value of the (string) partition columns.

    No shuffle: the file writer sorts each task's rows by the partition
    columns and keeps one file open at a time, so a category holding a third of
    all rows is still written by every task in parallel (never by one task)."""
    w = df.write.mode("overwrite").options(**options).partitionBy(*partition_by)
    if max_records:
        w = w.option("maxRecordsPerFile", int(max_records))
    w.format(fmt).save(path)


def write_summary(results: DataFrame, path: str, json_col: str = "processing_result", schema=None) -> None:
    """K7: parse per-file result JSON in Spark and overwrite the summary (no driver loop)."""
    parsed = results.select(F.from_json(F.col(json_col), schema).alias("r")).select("r.*") if schema is not None \
        else results
    parsed.write.mode("overwrite").parquet(path)


def temp_view(df: DataFrame, name: str) -> DataFrame:
    """K8: pipeline-scoped view."""
    df.createOrReplaceTempView(name)
    return df


def write_index_split(flat: DataFrame, path: str) -> None:
    """One flatten, three tables: the flat index rows are written ONCE,
    partitioned by ``file_type``; each table is then a partition-pruned read
    (the reference explodes the same input again for every sibling table)."""
    flat.write.mode("overwrite").partitionBy("file_type").parquet(path)
