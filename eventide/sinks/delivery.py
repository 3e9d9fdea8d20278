"""External delivery of events (K6, K7, K8).

Each executor task sends the payloads of its partition with its own client (one client
per partition, created from a picklable factory), so delivery scales with the cluster
and nothing passes through the driver. The outcome of every event is returned as rows
and written next to the batch, which makes delivery statistics a plain aggregation.

Semantics of the source application:
* a response status in {200, 201, 202} is a success; any other status is one error and
  is not retried;
* an exception (connection error, timeout) is one error per attempt and is retried, up
  to ``attempts`` in total, with exponential back-off (``min_wait``..``max_wait`` s);
* batched mode posts ``{"events": [...], "batch_id": ..., "event_count": n}`` per chunk and
  falls back to single sends when the chunk is refused or fails.

Delivery is at-least-once: a replayed micro-batch sends again. ``event_id`` is in every
payload so the receiver can drop repeats.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.operators.projections import to_payload_json
from eventide.session import ship_code
from eventide.sinks import fs

OK_STATUS = (200, 201, 202)
RESULT_SCHEMA = "event_id long, delivered boolean, status int, failures int, error string"


class HttpClient:
    """POST JSON with the standard library (no extra dependency)."""

    def __init__(self, url: str, timeout: float = 30.0):
        self.url = url
        self.timeout = timeout

    def post(self, body: str, url: str | None = None) -> int:
        import urllib.error
        import urllib.request

        req = urllib.request.Request(url or self.url, data=body.encode(), method="POST",
                                     headers={"Content-Type": "application/json"})
        try:
            with urllib.request.urlopen(req, timeout=self.timeout) as resp:
                return int(resp.status)
        except urllib.error.HTTPError as e:  # a status, not a transport failure
            return int(e.code)


def _send_one(client, body: str, attempts: int, min_wait: float, max_wait: float):
    failures = 0
    for attempt in range(attempts):
        try:
            status = client.post(body)
        except Exception as e:  # noqa: BLE001 - every transport error is retried
            failures += 1
            if attempt + 1 == attempts:
                return False, None, failures, f"{type(e).__name__}: {e}"
            time.sleep(min(max(min_wait * 2 ** attempt, min_wait), max_wait))
            continue
        if status in OK_STATUS:
            return True, status, failures, None
        return False, status, failures + 1, f"status {status}"
    return False, None, failures, "no attempt"


def _deliver_fn(client_factory: Callable[[], object], attempts: int, min_wait: float,
                max_wait: float, chunk: int | None, batch_url: str | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = client_factory()
        for pdf in batches:
            out = []
            ids = pdf["event_id"].tolist()
            bodies = pdf["value"].tolist()
            pending = list(zip(ids, bodies))
            if chunk and batch_url:
                pending = []
                for i in range(0, len(ids), chunk):
                    part = list(zip(ids[i:i + chunk], bodies[i:i + chunk]))
                    env = ('{"events":[' + ",".join(b for _, b in part) + '],"batch_id":"batch_'
                           + uuid.uuid4().hex + '","event_count":' + str(len(part)) + "}")
                    try:
                        status = client.post(env, batch_url)
                    except Exception:  # noqa: BLE001 - fall back to single sends
                        status = None
                    if status in OK_STATUS:
                        out += [(eid, True, status, 0, None) for eid, _ in part]
                    else:
                        pending += part
            for eid, body in pending:
                ok, status, failures, err = _send_one(client, body, attempts, min_wait, max_wait)
                out.append((eid, ok, status, failures, err))
            yield pd.DataFrame(out, columns=["event_id", "delivered", "status", "failures", "error"]
                               ).astype({"status": "Int32", "failures": "int32"})
    return run


def deliver(enriched: DataFrame, client_factory: Callable[[], object], attempts: int = 3,
            min_wait: float = 4.0, max_wait: float = 10.0, chunk: int | None = None,
            batch_url: str | None = None) -> DataFrame:
    """K6/K7: send every enriched event; returns one result row per event (lazy)."""
    ship_code(enriched.sparkSession)
    payloads = to_payload_json(enriched).select("event_id", "value")
    fn = _deliver_fn(client_factory, attempts, min_wait, max_wait, chunk, batch_url)
    return payloads.mapInPandas(fn, RESULT_SCHEMA)


def delivery_stats(results: DataFrame) -> DataFrame:
    """K8: sent, errors, attempts and error rate ``errors / max(attempts, 1)``."""
    return (results.agg(F.count_if("delivered").alias("sent_count"),
                        F.coalesce(F.sum("failures"), F.lit(0)).cast("long").alias("error_count"))
            .withColumn("total_attempts", F.col("sent_count") + F.col("error_count"))
            .withColumn("error_rate", F.col("error_count")
                        / F.greatest(F.col("total_attempts"), F.lit(1))))


def write_results(results: DataFrame, path: str, batch_id: int, source: str = "stream") -> None:
    """Results of one batch under ``source=S/batch_id=N`` (a replay replaces the folder)."""
    results.write.mode("overwrite").parquet(fs.batch_folder(path, source, batch_id))
