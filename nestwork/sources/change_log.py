"""Change log built from ``events`` (fixture F3).

Key ``user_id``; sequence ``(ts, event_id)``; ``error`` events are deletes,
``signup`` events inserts, the rest updates.  ``_commit_version`` groups 1,000
consecutive event ids and ``_commit_timestamp`` is the latest ``ts`` of its
version (a partial aggregate joined back on the version).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table

# Fixed values of the fixture layout.
EVENTS_PER_VERSION = 1000
CHANGE_TYPE_BY_EVENT = {"error": "delete", "signup": "insert"}
DEFAULT_CHANGE_TYPE = "update_postimage"


def change_type(event_type: Column) -> Column:
    out = None
    for ev, ct in CHANGE_TYPE_BY_EVENT.items():
        out = F.when(event_type == ev, F.lit(ct)) if out is None else out.when(event_type == ev, F.lit(ct))
    return out.otherwise(F.lit(DEFAULT_CHANGE_TYPE))


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    ev = ev.withColumn("_commit_version", F.floor(F.col("event_id") / EVENTS_PER_VERSION).cast("bigint"))
    commit_ts = ev.groupBy("_commit_version").agg(F.max("ts").alias("_commit_timestamp"))
    return ev.join(commit_ts, "_commit_version").withColumn("_change_type", change_type(F.col("event_type")))


def with_truncate_at_middle(log: DataFrame) -> DataFrame:
    """Add one ``truncate`` row at the last event of the middle commit version."""
    middle = log.agg(F.floor(F.max("_commit_version") / 2)).scalar()
    last_of_middle = (log.where(F.col("_commit_version") == middle)
                      .agg(F.max_by(F.struct(*log.columns), F.struct("ts", "event_id")).alias("r"))
                      .select("r.*"))
    return log.unionByName(last_of_middle.withColumn("_change_type", F.lit("truncate")))
