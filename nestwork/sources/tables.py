"""Access to the parquet tables of a scale-factor folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Rows of a table that one task groups or lands, at most and about.
ROWS_PER_TASK = 200_000

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one table; Catalyst prunes columns and pushes filters."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tasks_for(rows: DataFrame, rows_per_task: int | None = None) -> int:
    """Tasks that share ``rows``: one a core at least, and so many that a task's share does not grow with the table.

    The count of a table scan comes from the parquet footers."""
    return max(1, rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // (rows_per_task or ROWS_PER_TASK)))
