"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nestwork.session import scratch_path

# The white space of every contract here (space, tab to carriage return).
SPACE = r"\x20\x09-\x0D"
#: Rows of one Arrow batch handed to Python: long texts keep a batch within tens of MB.
BATCH_ROWS = 256


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under ``spark.checkpoint.dir`` and read it back.

    This cuts lineage: a lost executor costs a re-read.  The planner also knows the size of
    a written table, so it broadcasts it only below its own threshold.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the rows of the Arrow batches that Python workers get, unless the session asks for fewer."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))


def text_of(column: str = "text") -> Column:
    """The text with null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def quoted(column: str) -> str:
    """A column name that may hold dots or back ticks, quoted for ``F.col``."""
    return "`" + column.replace("`", "``") + "`"


def row_struct(df: DataFrame, alias: str = "row") -> Column:
    """All columns of a row in one struct, so helper columns never clash with extra ones."""
    return F.struct(*[F.col(quoted(c)) for c in df.columns]).alias(alias)


def unpacked(df: DataFrame, columns: list[str], struct: str = "row") -> list[Column]:
    """The columns of a row struct again, in their old order."""
    return [F.col(f"{struct}.{quoted(c)}").alias(c) for c in columns]


def unit_hash(*columns: Column) -> Column:
    """A uniform value in (0, 1) from the MD5 of the columns' text; the same in any SQL engine."""
    digits = F.substring(F.md5(F.concat_ws(":", *columns).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(2 ** 52))
