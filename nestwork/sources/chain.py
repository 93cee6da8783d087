"""Chained table streams from definitions (S13, S17): each stream feeds a table that later ones stream from.

A definition names its table, its source (another definition's table, or a landing folder) and its
transformation.  Every stream has a checkpoint of its own, so a second run takes up only what is new.  The driver
loops over definitions, never over data.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .catalog import stream_table
from .files import stream_lines
from .sinks import stream_to_table


@dataclass(frozen=True)
class StreamDefinition:
    table: str
    transform: Callable[[DataFrame], DataFrame]
    source_table: str | None = None
    source_folder: str | None = None
    max_files_per_trigger: int = 100


def in_order(definitions: Sequence[StreamDefinition]) -> list[StreamDefinition]:
    """Every definition after the one that feeds it; an unknown source, a repeated table or a circle is an error."""
    by_name = {d.table: d for d in definitions}
    if len(by_name) < len(definitions):
        raise ValueError("a table is defined twice")
    for d in definitions:
        if (d.source_table is None) == (d.source_folder is None):
            raise ValueError(f"{d.table} needs one source, a table or a folder")
        if d.source_table is not None and d.source_table not in by_name:
            raise ValueError(f"{d.table} streams from {d.source_table}, which no definition fills")
    out: list[StreamDefinition] = []
    left = list(definitions)
    while left:
        ready = [d for d in left if d.source_table is None or d.source_table in {o.table for o in out}]
        if not ready:
            raise ValueError("definitions feed each other in a circle: " + ", ".join(d.table for d in left))
        out += ready
        left = [d for d in left if d not in ready]
    return out


def run_chain(spark: SparkSession, definitions: Sequence[StreamDefinition], root: str, prefix: str) -> dict[str, int]:
    """Run all streams once over what is there; tables are external ones named ``prefix`` + table under ``root``.

    Returns the rows that each stream read in this run."""
    root, read = root.rstrip("/"), {}
    for d in in_order(definitions):
        src = (stream_lines(spark, d.source_folder, d.max_files_per_trigger) if d.source_folder is not None
               else stream_table(spark, prefix + d.source_table))
        rows = d.transform(src)
        if not spark.catalog.tableExists(prefix + d.table):
            spark.catalog.createTable(prefix + d.table, path=f"{root}/{d.table}", source="parquet", schema=rows.schema)
        query = stream_to_table(rows, f"{root}/{d.table}", f"{root}/_checkpoints/{d.table}", query_name=prefix + d.table)
        spark.catalog.refreshTable(prefix + d.table)  # batch readers list the new files
        read[d.table] = sum(p["numInputRows"] for p in query.recentProgress)
    return read
