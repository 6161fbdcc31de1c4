"""Throughput of streaming queries."""

from __future__ import annotations

import threading
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from gridpulse.session import PROGRESS_KEPT

THROUGHPUT = (
    "query STRING, batch_id BIGINT, input_rows BIGINT, seconds DOUBLE, "
    "rows_per_second DOUBLE, late_rows BIGINT, state_rows BIGINT"
)


def batch_throughput(progress) -> tuple:
    """The progress of one batch, in the order of ``THROUGHPUT``.

    ``input_rows`` counts each read of a batch: the serving sink reads its batches
    twice. ``late_rows`` counts what the watermark dropped, after the partial
    aggregation.
    """
    seconds = progress.durationMs.get("triggerExecution", 0) / 1000
    rows, state = progress.numInputRows, progress.stateOperators
    return (
        progress.name,
        progress.batchId,
        rows,
        seconds,
        rows / seconds if seconds else 0.0,
        sum(s.numRowsDroppedByWatermark for s in state),
        sum(s.numRowsTotal for s in state),
    )


def throughput(query: StreamingQuery) -> list[tuple]:
    """One row per batch of a query of a ``job_session``, which keeps PROGRESS_KEPT of them; an error beyond.

    For a query that runs longer, ``ThroughputReport`` sees every batch.
    """
    held = query.recentProgress
    if len(held) >= PROGRESS_KEPT:
        raise RuntimeError(f"{query.name} ran {PROGRESS_KEPT} batches or more: the first are no longer held")
    return [batch_throughput(p) for p in held]


def throughput_table(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    return spark.createDataFrame(throughput(query), THROUGHPUT)


def line(batch: tuple) -> str:
    name, number, rows, seconds, rate, late, _ = batch
    return f"[{name} batch {number}] {rows:,} rows in {seconds:.3f} s, {rate:,.0f} rows/s, {late:,} late"


class ThroughputReport(StreamingQueryListener):
    """Writes a line for each batch of each query of a session."""

    def __init__(self, write: Callable[[str], None] = print) -> None:
        self._write = write

    def onQueryStarted(self, event) -> None:
        self._write(f"[{event.name}] started")

    def onQueryProgress(self, event) -> None:
        self._write(line(batch_throughput(event.progress)))

    def onQueryIdle(self, event) -> None:
        """Nothing to report."""

    def onQueryTerminated(self, event) -> None:
        """The waiting job reports how a query ended."""


METRICS = (
    "query STRING, run STRING, batch_id BIGINT, at TIMESTAMP, input_rows BIGINT, no_house BIGINT, no_time BIGINT, "
    "late_rows BIGINT, written BIGINT, state_rows BIGINT, seconds DOUBLE, day DATE"
)


def batch_metrics(progress) -> tuple:
    """The progress of one batch, in the order of ``METRICS``; null where a query does not count."""
    ingested = progress.observedMetrics.get("ingested")
    rolled = progress.observedMetrics.get("rolled")
    read, no_house, no_time = (ingested["read"], ingested["no_house"], ingested["no_time"]) if ingested else (None,) * 3
    written = read - no_house - no_time if ingested else rolled["written"] if rolled else None
    at = datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00"))
    name, batch_id, _, seconds, _, late, state = batch_throughput(progress)
    rows = progress.numInputRows if read is None else read
    return (name, str(progress.runId), batch_id, at, rows, no_house, no_time, late, written, state, seconds, at.date())


class MetricsTable(StreamingQueryListener):
    """Appends a row per batch of each query of a session to a Parquet table, by day, for as long as the queries run.

    A batch whose counts Spark collected while it ran: nothing is read for it again. A trigger that found no data is left out.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self._path, self._ended, self._lock = spark, path, set(), threading.Condition()
        self._failed: Exception | None = None

    def onQueryStarted(self, event) -> None:
        """Nothing to store."""

    def onQueryProgress(self, event) -> None:
        try:
            row = self._spark.createDataFrame([batch_metrics(event.progress)], METRICS)
            row.coalesce(1).write.mode("append").partitionBy("day").parquet(self._path)
        except Exception as error:  # a listener must not stop the queries; ``wait_for`` and the caller see it
            self._failed = error

    def onQueryIdle(self, event) -> None:
        """Nothing was read."""

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended.add(str(event.runId))
            self._lock.notify_all()

    def wait_for(self, *queries: StreamingQuery, seconds: float = 60) -> None:
        """Until the last batches of ended queries are stored; raises what kept a row from being stored."""
        runs = {str(q.runId) for q in queries}
        with self._lock:
            if not self._lock.wait_for(lambda: runs <= self._ended, seconds):
                raise TimeoutError("queries have not ended, or their last events have not come")
        if self._failed:
            raise self._failed


def metrics_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS).parquet(path)
