"""Progress of running streams as rows.

``ProgressLog`` is a listener that notes every micro-batch of the queries it watches: rows read,
latency, rates, what waits in the sources, rows dropped as late, and the observed counts. Rows
are gathered on the driver and appended as JSON lines, ``ROWS`` at a time and when a query ends,
so that a long-running stream leaves few files and the listener holds a bounded number of rows.
Alerts are queries over what was written (``latency_alerts``).
"""

from __future__ import annotations

import json
import threading
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from eventide.sinks import fs

PROGRESS = ("source string, run string, name string, batch_id long, started_at timestamp, "
            "input_rows long, input_rows_per_sec double, processed_rows_per_sec double, "
            "latency_ms long, backlog long, late_rows_dropped long, state_rows long, "
            "state_bytes long, watermark timestamp, observed map<string, string>")
#: Rows of one file; rows older than SECONDS are written with the next one.
ROWS = 100
SECONDS = 10.0


def progress_row(p) -> dict:
    """One row of PROGRESS from a ``StreamingQueryProgress``."""
    from eventide.streaming.pipeline import source_backlog

    state = p.stateOperators or []
    observed = {f"{name}.{k}": str(v) for name, row in (p.observedMetrics or {}).items()
                for k, v in row.asDict().items() if v is not None}
    return {"source": str(p.id), "run": str(p.runId), "name": p.name, "batch_id": p.batchId,
            "started_at": p.timestamp, "input_rows": p.numInputRows,
            "input_rows_per_sec": p.inputRowsPerSecond,
            "processed_rows_per_sec": p.processedRowsPerSecond,
            "latency_ms": (p.durationMs or {}).get("triggerExecution", 0),
            "backlog": source_backlog(p),
            "late_rows_dropped": sum(s.numRowsDroppedByWatermark for s in state),
            "state_rows": sum(s.numRowsTotal for s in state),
            "state_bytes": sum(s.memoryUsedBytes for s in state),
            "watermark": (p.eventTime or {}).get("watermark"), "observed": observed}


class ProgressLog(StreamingQueryListener):
    """Writes the progress of all queries of a session (or of those with the given names) below
    ``path``. Add it with ``spark.streams.addListener(log)``; ``log.wait(query)`` returns when
    the rows of an ended query are written."""

    def __init__(self, spark: SparkSession, path: str, names: tuple[str, ...] | None = None):
        super().__init__()
        self.spark, self.path, self.names = spark, path, names
        self._rows: list[dict] = []
        self._since = time.monotonic()
        self._lock = threading.Lock()
        self._runs: set[str] = set()
        self._over: dict[str, threading.Event] = {}

    def _end(self, run: str) -> threading.Event:
        with self._lock:
            return self._over.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        if self.names is None or event.name in self.names:
            self._runs.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        if str(event.progress.runId) not in self._runs:
            return
        with self._lock:
            self._rows.append(progress_row(event.progress))
            full = len(self._rows) >= ROWS or time.monotonic() - self._since > SECONDS
        if full:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) in self._runs:
            self.flush()
            self._runs.discard(str(event.runId))
        self._end(str(event.runId)).set()

    def flush(self) -> None:
        """Write what was gathered as one file, which appears when it is complete."""
        with self._lock:
            rows, self._rows, self._since = self._rows, [], time.monotonic()
        if rows:
            name = f"{int(time.time() * 1000):013d}-{uuid.uuid4().hex[:8]}.json"
            fs.write_text(self.spark, f"{self.path}/{name}",
                          "\n".join(json.dumps(r) for r in rows) + "\n")

    def wait(self, query: StreamingQuery, timeout: float = 60.0) -> bool:
        """Listener events come behind the query: wait for the one that ends it."""
        return self._end(str(query.runId)).wait(timeout)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The written rows, one per batch of a source (a replayed batch: its last attempt)."""
    rows = spark.read.schema(PROGRESS).json(path)
    cols = [c for c in rows.columns if c not in ("source", "batch_id")]
    return (rows.groupBy("source", "batch_id")
            .agg(F.max_by(F.struct(*cols), "started_at").alias("_r"))
            .select("source", "batch_id", "_r.*"))


def latency_alerts(progress: DataFrame, latency_ms: int = 5000, backlog: int = 1000,
                   late_rows: int = 0) -> DataFrame:
    """Batches beyond a limit: slower than ``latency_ms``, with more than ``backlog`` records
    or files waiting, or with more than ``late_rows`` rows dropped as late; one row per batch and
    alert, with the batch's progress."""
    alerts = [("latency", F.col("latency_ms"), latency_ms), ("backlog", F.col("backlog"), backlog),
              ("late_rows", F.col("late_rows_dropped"), late_rows)]
    raised = F.array_compact(F.array(*[
        F.when(value > limit, F.struct(F.lit(name).alias("alert"), value.cast("long").alias(
            "value"), F.lit(int(limit)).cast("long").alias("limit")))
        for name, value, limit in alerts]))
    return progress.select("*", F.inline(raised))
