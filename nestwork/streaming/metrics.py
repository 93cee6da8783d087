"""Stream metrics as a table.

A listener gathers what each micro-batch reports: rows read, the watermark, rows that the watermark dropped, and the
observed metrics of the query.  ``run_with_metrics`` runs a triggered stream to its end and stores these as rows
of (batch_id, metric, value), a handful for each batch; every batch is reported, however many there are.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = "batch_id long, metric string, value long, watermark string"


class BatchMetrics(StreamingQueryListener):
    """Rows of the micro-batches of one query; its run is known only after the start, so rows are kept by run."""

    def __init__(self) -> None:
        self.rows: dict[str, dict[int, list[tuple]]] = {}
        self.ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end(self, run: str) -> threading.Event:
        with self._lock:
            return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        mark = (p.eventTime or {}).get("watermark")
        rows = [(p.batchId, "rows_read", int(p.numInputRows), mark),
                (p.batchId, "rows_dropped_by_watermark", sum(int(s.numRowsDroppedByWatermark) for s in p.stateOperators), mark)]
        for row in (p.observedMetrics or {}).values():
            rows += [(p.batchId, k, int(v), mark) for k, v in row.asDict().items() if v is not None]
        with self._lock:  # a batch without data may be reported again and again: the last report counts
            self.rows.setdefault(str(p.runId), {})[p.batchId] = rows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def of(self, run: str, timeout: float = 60) -> list[tuple]:
        """All rows of a run that has ended; reports come a little after the batches."""
        self._end(run).wait(timeout)
        with self._lock:
            return [r for _, rows in sorted(self.rows.get(run, {}).items()) for r in rows]


def run_with_metrics(spark: SparkSession, writer, path: str) -> DataFrame:
    """Start ``writer`` (a triggered ``DataStreamWriter``), wait for its end, and append its metrics to the table at ``path``."""
    listener = BatchMetrics()
    spark.streams.addListener(listener)
    try:
        query = writer.start()
        query.awaitTermination()
        rows = listener.of(str(query.runId))
    finally:
        spark.streams.removeListener(listener)
    spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)
