"""What Spark reports of running streams, kept as a table."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

COLUMNS = (
    "query string, run string, batch_id bigint, at string, input_n bigint, input_per_s double, processed_per_s double, "
    "trigger_ms bigint, write_ms bigint, state_rows bigint, state_bytes bigint"
)


class ProgressLog(StreamingQueryListener):
    """One row for each batch that read something: rows, rates, times and state.

    Rows are written when a stream has ended or ``EVERY`` have come together, not one by one.
    """

    EVERY = 100

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.rows: list[tuple] = []
        self.ended: dict[str, threading.Event] = {}
        self.lock = threading.Lock()

    def _end(self, run: str) -> threading.Event:
        with self.lock:
            return self.ended.setdefault(run, threading.Event())

    def flush(self) -> None:
        with self.lock:
            rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, COLUMNS).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if not p.numInputRows:
            return
        took, state = p.durationMs, p.stateOperators
        row = (p.name or str(p.id), str(p.runId), p.batchId, p.timestamp, p.numInputRows, p.inputRowsPerSecond, p.processedRowsPerSecond)
        row += (took.get("triggerExecution", 0), took.get("addBatch", 0))
        row += (sum(s.numRowsTotal for s in state), sum(s.memoryUsedBytes for s in state))
        with self.lock:
            self.rows.append(row)
            full = len(self.rows) >= self.EVERY
        if full:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until all that an ended stream reported is here; reports come a little after the batches."""
        self._end(str(query.runId)).wait(seconds)
        self.flush()


@contextmanager
def progress_log(spark: SparkSession, path: str) -> Iterator[ProgressLog]:
    """Streams that run inside the block are logged to the table at ``path``."""
    log = ProgressLog(spark, path)
    spark.streams.addListener(log)
    try:
        yield log
    finally:
        spark.streams.removeListener(log)
        log.flush()
