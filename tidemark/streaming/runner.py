"""Running streaming queries: lifecycle and progress metrics."""

from __future__ import annotations

import contextlib
import threading
from collections import defaultdict
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tidemark.operators import control

AVAILABLE_NOW = {"availableNow": True}


@contextlib.contextmanager
def state_width(spark: SparkSession, partitions: int | None = None) -> Iterator[int]:
    """Shuffle (and so state-store) partitions of streaming queries started
    inside the block.

    A stateful query fixes this width in its checkpoint at its first start.
    One partition per task slot (the default) spreads state over the whole
    cluster and keeps each micro-batch's state-store work in step with the
    cores, independent of the session's batch shuffle setting.
    """
    n = int(partitions or spark.sparkContext.defaultParallelism)
    with control.session_conf(spark, {"spark.sql.shuffle.partitions": str(n)}):
        yield n


def await_all(queries: Iterable[StreamingQuery], timeout: float | None = None) -> None:
    """Wait for every query to end; re-raise the first failure."""
    for q in queries:
        if timeout is None:
            q.awaitTermination()
        else:
            q.awaitTermination(timeout)
        exc = q.exception()
        if exc is not None:
            raise RuntimeError(f"streaming query {q.name or q.id} failed: {exc}")


def stop_all(spark: SparkSession) -> None:
    for q in spark.streams.active:
        q.stop()


def batches(query: StreamingQuery) -> list[dict]:
    """Progress reports of the batches still retained by the query."""
    return [dict(p) if not isinstance(p, dict) else p for p in query.recentProgress]


def rows_dropped_by_watermark(query: StreamingQuery) -> list[int]:
    """Late rows each batch dropped, summed over stateful operators."""
    out = []
    for p in query.recentProgress:
        ops = p["stateOperators"] if isinstance(p, dict) else p.stateOperators
        total = 0
        for op in ops or []:
            total += int(op["numRowsDroppedByWatermark"] if isinstance(op, dict)
                         else op.numRowsDroppedByWatermark)
        out.append(total)
    return out


def input_rows_per_batch(query: StreamingQuery) -> list[int]:
    out = []
    for p in query.recentProgress:
        out.append(int(p["numInputRows"] if isinstance(p, dict) else p.numInputRows))
    return out


class ProgressTable(StreamingQueryListener):
    """Writes the progress of every query as rows of a Parquet table (I15, I17):
    one row per micro-batch with input rows, late rows dropped, rows held in
    state and the watermark. ``run`` counts the starts of one checkpointed query
    since the listener was added, from 0.

    Callbacks only keep the numbers; one thread of its own appends them to the
    table, ``every`` batches at a time, so no job runs on Spark's event bus."""

    SCHEMA = (
        "query string, query_id string, run int, batch_id long, input_rows long,"
        " dropped_rows long, state_rows long, watermark string"
    )

    def __init__(self, spark: SparkSession, path: str, every: int = 100):
        self.spark, self.path, self.every = spark, path, every
        self._lock = threading.Condition()
        self._rows: list[tuple] = []
        self._runs: dict[str, list[str]] = defaultdict(list)
        self._ended: set[str] = set()
        self._writer = ThreadPoolExecutor(max_workers=1)
        self._writes: list = []

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._runs[str(event.id)].append(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        ops = p.stateOperators or []
        row = (
            p.name, str(p.id), self._runs[str(p.id)].index(str(p.runId)), int(p.batchId), int(p.numInputRows),
            sum(int(o.numRowsDroppedByWatermark) for o in ops), sum(int(o.numRowsTotal) for o in ops),
            (p.eventTime or {}).get("watermark"),
        )
        with self._lock:
            self._rows.append(row)
            if len(self._rows) >= self.every:
                self._hand_over()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended.add(str(event.runId))
            self._lock.notify_all()

    def _hand_over(self) -> None:
        rows, self._rows = self._rows, []
        if rows:
            self._writes.append(self._writer.submit(self._write, rows))

    def _write(self, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, self.SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def close(self, timeout: float = 60.0) -> None:
        """Wait until the started queries' ends are reported (their progress
        comes before), write what is left, and raise what a write raised."""
        started = {r for runs in self._runs.values() for r in runs}
        with self._lock:
            self._lock.wait_for(lambda: started <= self._ended, timeout)
            self._hand_over()
        for write in self._writes:
            write.result()
        self._writer.shutdown()


@contextlib.contextmanager
def progress_table(spark: SparkSession, path: str, every: int = 100) -> Iterator[ProgressTable]:
    """Record the progress of the queries that start and end inside the block."""
    table = ProgressTable(spark, path, every)
    spark.streams.addListener(table)
    try:
        yield table
    finally:
        try:
            table.close()
        finally:
            spark.streams.removeListener(table)
