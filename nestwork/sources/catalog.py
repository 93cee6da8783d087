"""Catalog statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def save_table(df: DataFrame, name: str, path: str, mode: str = "append") -> None:
    """K3: append to (or create) a named table stored at ``path``."""
    df.write.mode(mode).format("parquet").option("path", path).saveAsTable(name)


def drop_table_if_exists(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def current_namespace(spark: SparkSession) -> tuple[str, str]:
    return spark.catalog.currentCatalog(), spark.catalog.currentDatabase()


def analyze(spark: SparkSession, name: str) -> None:
    """Column statistics for the cost-based optimizer (the profile query A5
    gives the same numbers as a DataFrame)."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """S14."""
    return spark.table(name)


def stream_table(spark: SparkSession, name: str) -> DataFrame:
    """A table as a streaming source (new files become new rows)."""
    return spark.readStream.table(name)
