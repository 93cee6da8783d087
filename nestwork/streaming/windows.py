"""Watermarked tumbling windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def event_time(df: DataFrame, ts_col: str) -> DataFrame:
    """Watermarks need TIMESTAMP, not TIMESTAMP_NTZ.  A wall-clock (NTZ) time is
    turned into the instant with the same wall clock in UTC, so window bounds fall
    on wall-clock boundaries whatever the session time zone is."""
    if dict(df.dtypes).get(ts_col) == "timestamp_ntz":
        return df.withColumn(ts_col, F.from_utc_timestamp(F.col(ts_col).cast("timestamp"), F.current_timezone()))
    return df


def wall_clock(c) -> F.Column:
    """Inverse of ``event_time``: the UTC wall clock of an instant, as TIMESTAMP_NTZ."""
    return F.to_utc_timestamp(c, F.current_timezone()).cast("timestamp_ntz")


def tumbling_counts(df: DataFrame, ts_col: str, window: str, delay: str,
                    group_cols: Sequence[str] = (), value_col: str | None = None) -> DataFrame:
    """Counts (and sums) per tumbling window; rows older than the watermark are
    dropped by Spark and reported as ``numRowsDroppedByWatermark``.  Window
    bounds come out as TIMESTAMP_NTZ wall-clock times, the same in any session
    or client time zone."""
    aggs = [F.count(F.lit(1)).alias("n_events")]
    if value_col:
        aggs.append(F.sum(value_col).alias("sum_value"))
    return (event_time(df, ts_col).withWatermark(ts_col, delay)
            .groupBy(F.window(ts_col, window).alias("w"), *group_cols).agg(*aggs)
            .select(wall_clock(F.col("w.start")).alias("window_start"),
                    wall_clock(F.col("w.end")).alias("window_end"),
                    *group_cols, *[a for a in ["n_events", "sum_value"] if a == "n_events" or value_col]))


def closed_windows(df: DataFrame, ts_col: str, window: str, delay: str, group_cols: Sequence[str], id_cols: Sequence[str]) -> DataFrame:
    """Counts of windows that the watermark has closed, each once (append mode), over rows that came in time.

    Rows pass a keyed ``dropDuplicates`` under the watermark first.  There each row stands for itself, so Spark's
    number of dropped rows is exact (an aggregation would count its partial sums); repeats of a row within the
    watermark count once."""
    rows = event_time(df, ts_col).withWatermark(ts_col, delay).dropDuplicates([*id_cols, ts_col])
    return (rows.groupBy(F.window(ts_col, window).alias("w"), *group_cols).agg(F.count(F.lit(1)).alias("n_events"))
            .select(wall_clock(F.col("w.start")).alias("window_start"), wall_clock(F.col("w.end")).alias("window_end"), *group_cols, "n_events"))


def updates_to_folder(root: str):
    """foreachBatch sink for update mode: each batch's changed windows go to
    ``root/batch=<id>`` (a replay overwrites its own folder)."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{root}/batch={batch_id}")
    return write


def latest_updates(spark, root: str, keys: Sequence[str]) -> DataFrame:
    """The final value of every window: latest batch per key."""
    upd = spark.read.parquet(root)
    vals = [c for c in upd.columns if c not in keys and c != "batch"]
    return (upd.groupBy(*keys).agg(F.max_by(F.struct(*vals), F.col("batch")).alias("_r"))
            .select(*keys, "_r.*"))
