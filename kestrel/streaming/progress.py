"""A table of what each micro-batch of each named query did.

``ProgressTable`` is a streaming query listener: for every batch it keeps the query's name, the batch id,
the rows read, the watermark, and over all stateful steps the rows held in state and the rows dropped
because the watermark had closed their window. Its rows are written to a folder ``FLUSH`` batches at a
time and when a query ends, so the driver holds few of them however long a query runs.

A dropped row is what arrives at the stateful step: after the partial aggregation, so a window's late
rows of one key count once per batch.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

SCHEMA = ("query string, run_id string, batch_id long, input_rows long, watermark string, state_rows long, "
          "late_rows long")
#: batches of one file of the table
FLUSH = 500


class ProgressTable(StreamingQueryListener):
    """Use as ``with ProgressTable(spark, path) as progress``: listens inside the block, and has written
    every batch of the queries that ended in it when ``read`` is called."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._lock = threading.Condition()
        self._rows: list[tuple] = []
        self._ended: set[str] = set()

    def __enter__(self) -> ProgressTable:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *failure) -> None:
        self.spark.streams.removeListener(self)
        self.flush()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        steps = p.stateOperators
        row = (p.name, str(p.runId), p.batchId, p.numInputRows, (p.eventTime or {}).get("watermark"),
               sum(s.numRowsTotal for s in steps), sum(s.numRowsDroppedByWatermark for s in steps))
        with self._lock:
            self._rows.append(row)
            full = len(self._rows) >= FLUSH
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended.add(str(event.runId))
            self._lock.notify_all()

    def flush(self) -> None:
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Wait until the events of an ended query have arrived (they come after it has ended)."""
        with self._lock:
            if not self._lock.wait_for(lambda: str(query.runId) in self._ended, seconds):
                raise TimeoutError(f"no end of query {query.name} was reported in {seconds} s")

    def read(self) -> DataFrame:
        self.flush()
        return self.spark.read.schema(SCHEMA).parquet(self.path)
