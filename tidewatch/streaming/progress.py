"""Batch sizes and timings of running streams, appended to a table."""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

PROGRESS = (
    "source string, batch_id bigint, input_rows bigint, add_batch_ms double, trigger_ms double, "
    "late_rows bigint"
)


class ProgressRecorder(StreamingQueryListener):
    """Appends the batches of all queries of a session to the table at ``path``, many at a time.

    At most ``most`` batches, or those of ``every_s`` seconds, wait in the driver; the end of a query and ``table`` write them
    too. A driver that dies loses the ones that wait.
    """

    def __init__(self, spark: SparkSession, path: str, most: int = 500, every_s: float = 60):
        self.spark, self.path, self.most, self.every_s = spark, path, most, every_s
        self.ended: dict[str, threading.Event] = {}
        self.waiting: list[tuple] = []
        self.written_at = time.monotonic()
        self.lock = threading.Lock()

    def flush(self) -> None:
        """Write what waits, as one file."""
        with self.lock:
            rows, self.waiting, self.written_at = self.waiting, [], time.monotonic()
        if rows:
            self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)

    def _end(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        p = event.progress
        took = p.durationMs or {}
        late = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        row = (p.name or str(p.id), p.batchId, p.numInputRows, float(took.get("addBatch", 0)),
               float(took.get("triggerExecution", 0)), late)
        with self.lock:
            self.waiting.append(row)
        if len(self.waiting) >= self.most or time.monotonic() - self.written_at >= self.every_s:
            self.flush()

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None:
        self.flush()
        self._end(str(event.runId)).set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until all batches of a query that has ended are in the table."""
        if not self._end(str(query.runId)).wait(seconds):
            raise TimeoutError(f"no end of query {query.name} was reported")

    def table(self) -> DataFrame:
        self.flush()
        return self.spark.read.schema(PROGRESS).parquet(self.path)
