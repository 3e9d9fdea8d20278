"""Structured Streaming pipeline: source -> dedup -> validate/enrich -> fan-out (S1-S3, ST1,
ST2, ST10-ST13, K1, K5, K6, K10, A16).

One ``foreachBatch`` call per micro-batch: the batch is tagged once (validation +
broadcast join with the content dimension), persisted, and written to every configured
sink with the micro-batch id, which each sink uses to stay idempotent. Offsets and state
live in the checkpoint folder under ``spark.checkpoint.dir``, so a restarted or
re-scheduled query resumes at the first uncommitted batch and replays it without double
counting. Backfill calls the same ``process_batch`` on a batch DataFrame.
"""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventide.operators import enrich as en
from eventide.operators.joins import fits_broadcast
from eventide.operators.validate import REASONS, with_canonical_ids
from eventide.schemas import ENRICHED_COLUMNS, EVENT
from eventide.session import checkpoint_dir
from eventide.sinks import fs

log = logging.getLogger(__name__)

#: Kinds of rows of a batch (``with_late_rows``): taken by the stream's stateful operator; too
#: late for it; seen at the source only to tell how many were copies.
KIND = "_kind"
TAKEN, LATE, SEEN = 0, 1, 2


@dataclass
class Sinks:
    """Where a micro-batch goes; every entry is optional."""
    warehouse: str | None = None          # fact table path (K1)
    quarantine: str | None = None         # rejected rows (K10)
    serving: object | None = None         # eventide.sinks.serving.ServingStore (K5)
    delivery_client: Callable[[], object] | None = None   # client factory (K6)
    delivery_results: str | None = None   # delivery outcome rows (K8)
    delivery_options: dict = field(default_factory=dict)
    metrics: str | None = None            # per-batch processing metrics (A16)


def _content(content) -> DataFrame:
    return content() if callable(content) else content


def _run_concurrently(tasks: list[Callable[[], None]], session: SparkSession | None = None
                      ) -> None:
    """Run independent sink writes as concurrent Spark jobs from driver threads.

    The batch is persisted, so the writers share one computation; wall time is the
    slowest sink instead of the sum. Local properties (job group, scheduler pool) are
    inherited by the threads. The first failure is raised, so the micro-batch fails and
    is replayed rather than half-written sinks being committed silently.
    """
    if len(tasks) <= 1:
        for t in tasks:
            t()
        return
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.util import inheritable_thread_target

    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        wrap = inheritable_thread_target(session) if session is not None else inheritable_thread_target
        futures = [pool.submit(wrap(t)) for t in tasks]
        errors = [f.exception() for f in futures]
    for e in errors:
        if e is not None:
            raise e


def process_batch(batch: DataFrame, batch_id: int, content, sinks: Sinks, strict: bool = True,
                  known_small: bool | None = None, source: str | None = None) -> dict:
    """Validate, enrich and fan out one batch; returns its metrics (also written).

    A batch whose rows carry a KIND (``with_late_rows``) has its late rows put aside with the
    reason ``late`` and its copies counted. ``source`` names where the batch id comes from; by default the id of the streaming query
    that runs the batch, so that a stream started with a fresh checkpoint is another source.
    """
    t0 = time.time()
    spark = batch.sparkSession
    source = source or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"
    if dict(batch.dtypes).get("event_ts") == "timestamp":
        batch = batch.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))
    batch = with_canonical_ids(batch)
    if KIND in batch.columns:  # what the stream took out is only counted: no values needed
        batch = batch.select(*[F.col(c) if c == KIND else F.when(F.col(KIND) != SEEN, F.col(c))
                               .alias(c) for c in batch.columns])
    tagged = en.tag(batch, _content(content), strict=strict, known_small=known_small)
    if "_parse_reasons" in batch.columns:  # raw JSON input: parse errors count too
        tagged = tagged.withColumn(REASONS, F.array_distinct(F.concat("_parse_reasons", REASONS)))
    if KIND in batch.columns:
        tagged = tagged.withColumn(REASONS, F.when(F.col(KIND) == LATE, F.array(F.lit("late")))
                                   .otherwise(F.col(REASONS)))
    else:
        tagged = tagged.withColumn(KIND, F.lit(TAKEN))
    tagged = tagged.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # one job: materialises the persisted batch and counts it
        good = (F.col(KIND) == TAKEN) & (F.size(REASONS) == 0)
        bad = (F.col(KIND) != SEEN) & (F.size(REASONS) > 0)
        wanted = [F.count_if(F.col(KIND) != SEEN).alias("n"), F.count_if(bad).alias("rejected"),
                  F.count_if(F.col(KIND) == LATE).alias("late"),
                  # a row that was read and neither taken nor late is a copy
                  (F.count_if(F.col(KIND) == SEEN) - F.count_if(F.col(KIND) == TAKEN))
                  .alias("copies"),
                  # what the sinks would else ask for in jobs of their own: a few days and
                  # bucket numbers
                  F.collect_set(F.when(good, F.to_date("event_ts"))).alias("days")]
        if hasattr(sinks.serving, "bucket_of"):
            wanted.append(F.collect_set(F.when(good, sinks.serving.bucket_of())).alias("buckets"))
        counts = tagged.agg(*wanted).first()
        n, rejected = int(counts["n"]), int(counts["rejected"])
        metrics = {"batch_id": int(batch_id), "input_rows": n, "rejected_rows": rejected,
                   "processed_rows": n - rejected, "late_rows": int(counts["late"]),
                   "duplicate_rows": max(int(counts["copies"]), 0), "duration_sec": 0.0, "prepare_sec": 0.0,
                   "quarantine_sec": 0.0, "warehouse_sec": 0.0, "serving_sec": 0.0,
                   "delivery_sec": 0.0}
        # every sink is written even when it gets no row: a replayed batch replaces all that an
        # earlier attempt wrote
        enriched = tagged.where(good).select(*ENRICHED_COLUMNS)
        # the document as it arrived, so that a rejected one can be repaired
        raw = [F.col("_raw").alias("raw_document")] if "_raw" in tagged.columns else []
        rejects = tagged.where(bad).select(*EVENT.fieldNames(), REASONS, *raw)
        tasks: dict[str, Callable[[], None]] = {}
        if sinks.quarantine:
            from eventide.sinks.quarantine import write_rejects
            tasks["quarantine"] = lambda: write_rejects(rejects, sinks.quarantine, batch_id,
                                                        source)
        if sinks.warehouse:
            from eventide.sinks.warehouse import write_fact
            tasks["warehouse"] = lambda: write_fact(enriched, sinks.warehouse, batch_id,
                                                    source=source, days=counts["days"])
        if sinks.serving is not None:
            known = {"touched": sorted(counts["buckets"])} if "buckets" in counts else {}
            tasks["serving"] = lambda: sinks.serving.write_batch(
                enriched, batch_id, batch_rows=n - rejected, source=source, **known)
        if sinks.delivery_client is not None and n > rejected:
            from eventide.sinks.delivery import deliver, write_results

            def delivery() -> None:
                results = deliver(enriched, sinks.delivery_client, **sinks.delivery_options)
                if sinks.delivery_results:
                    write_results(results, sinks.delivery_results, batch_id, source)
                else:
                    results.write.format("noop").mode("overwrite").save()
            tasks["delivery"] = delivery
        sink_seconds: dict[str, float] = {}

        def timed(name: str, fn: Callable[[], None]) -> Callable[[], None]:
            def run() -> None:
                t = time.time()
                fn()
                sink_seconds[name] = round(time.time() - t, 3)
            return run

        metrics["prepare_sec"] = round(time.time() - t0, 3)
        _run_concurrently([timed(k, f) for k, f in tasks.items()], spark)
        for k in ("quarantine", "warehouse", "serving", "delivery"):
            metrics[f"{k}_sec"] = sink_seconds.get(k, 0.0)
        metrics["duration_sec"] = round(time.time() - t0, 3)
        log.info("batch %s metrics %s", batch_id, metrics)
        if sinks.metrics:
            write_metrics(spark, metrics, sinks.metrics, batch_id, source)
        return metrics
    finally:
        tagged.unpersist()


def write_metrics(spark: SparkSession, metrics: dict, path: str, batch_id: int,
                  source: str = "stream") -> None:
    """The metrics row of one batch, with the time it ended, in the batch's own folder."""
    row = {k: v for k, v in metrics.items() if k != "batch_id"}
    (spark.createDataFrame([row]).withColumn("finished_at", F.current_timestamp()).coalesce(1)
     .write.mode("overwrite").parquet(fs.batch_folder(path, source, batch_id)))


def prepare_stream(stream: DataFrame, watermark: str = "10 minutes", dedup: bool = False
                   ) -> DataFrame:
    """ST10/ST11: event-time watermark and optional de-duplication of re-sent event ids.

    ``withWatermark`` needs TIMESTAMP (not NTZ). ``dropDuplicatesWithinWatermark`` keeps
    its state bounded by the watermark delay, but Spark drops rows older than the
    watermark in any stateful operator, so de-duplication is opt-in: enable it only with
    a delay that covers the source's disorder (dropped rows are reported as
    ``late_rows_dropped`` by ``progress_metrics``). Replays of a micro-batch never need it:
    every sink is idempotent per batch id.
    """
    s = stream.withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    s = s.withWatermark("event_ts", watermark)
    if not dedup:
        return s
    # an event without id or time cannot be matched with a copy: it gets a key of its own,
    # so that all such events reach the rules and the quarantine
    known = F.col("id").isNotNull() & F.col("event_ts").isNotNull()
    key = F.when(known, F.col("id").cast("string")).otherwise(F.expr("uuid()"))
    return s.withColumn("_key", key).dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def with_late_rows(stream: DataFrame, prepared: DataFrame) -> DataFrame:
    """ST11: the rows that the stateful operators of ``prepared`` let through, and beside them all
    rows of ``stream``, on a branch without an operator that could drop any (kind SEEN). The batch
    then tells the late ones from the others by the watermark that it ran with."""
    seen = stream.withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    return prepared.withColumn(KIND, F.lit(TAKEN)).unionByName(seen.withColumn(KIND, F.lit(SEEN)))


def late_watermark(spark: SparkSession, checkpoint: str, batch_id: int) -> int | None:
    """Milliseconds of the watermark by which batch ``batch_id`` drops late rows: the one its
    predecessor was planned with, from the query's offset log (a replay finds the same)."""
    log_file = f"{checkpoint}/offsets/{int(batch_id) - 1}"
    if batch_id <= 0 or not fs.exists(spark, log_file):
        return None
    return int(json.loads(fs.read_text(spark, log_file).splitlines()[1])["batchWatermarkMs"])


def run_stream(spark: SparkSession, stream: DataFrame, content, sinks: Sinks,
               checkpoint: str | None = None, trigger: dict | None = None,
               watermark: str = "10 minutes", dedup: bool = False, strict: bool = True,
               query_name: str | None = None, keep_late: bool = False) -> StreamingQuery:
    """Start the pipeline; ``trigger`` e.g. ``{"processingTime": "1 second"}`` (default)
    or ``{"availableNow": True}`` for catch-up/backfill runs.

    ``keep_late`` (with ``dedup``) puts rows that come behind the watermark into the quarantine
    with the reason ``late``, where they would otherwise only be counted, and writes the numbers
    of late rows and of copies with the batch's metrics: taken + late + copies = sent. It reads
    the source twice.
    """
    ckpt = checkpoint or f"{checkpoint_dir(spark)}/{query_name or 'engagement-pipeline'}"
    # one rule for catalogues of any size: a DataFrame is read again by every batch from the
    # files it was made of; a callable makes a new DataFrame for every batch, so it sees new
    # files. Only the size check of a fixed DataFrame is not repeated.
    small = None if callable(content) else fits_broadcast(content)

    keep_late = keep_late and dedup

    def fn(df: DataFrame, batch_id: int) -> None:
        if keep_late:
            behind = late_watermark(spark, ckpt, batch_id)
            late = F.lit(False) if behind is None else (
                F.col("event_ts") <= F.timestamp_millis(F.lit(behind)))
            df = df.withColumn(KIND, F.when((F.col(KIND) == SEEN) & late, LATE)
                               .otherwise(F.col(KIND)))
        process_batch(df, batch_id, content, sinks, strict=strict, known_small=small)

    observed = stream.observe(
        "ingest", F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("id").isNull()).alias("rows_without_id"),
        F.max("event_ts").alias("max_event_ts"))
    prepared = prepare_stream(observed, watermark, dedup)
    if keep_late:
        prepared = with_late_rows(stream, prepared)
    w = (prepared.writeStream
         .foreachBatch(fn)
         .option("checkpointLocation", ckpt)
         .trigger(**(trigger or {"processingTime": "1 second"})))
    if query_name:
        w = w.queryName(query_name)
    return w.start()


def file_events(spark: SparkSession, path: str, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """S1 stand-in: typed events arriving as files (schema declared, no inference)."""
    r = spark.readStream.schema(EVENT).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.load(path)


def raw_json_events(spark: SparkSession, path: str, max_files_per_trigger: int | None = None
                    ) -> DataFrame:
    """S1 stand-in for a message bus: one JSON document per line, parsed with V1 rules."""
    from eventide.operators.validate import parse_raw_events

    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return parse_raw_events(r.load(path), "value")


def processing_metrics(spark: SparkSession, path: str, last: int = 1000) -> DataFrame:
    """Lifetime totals and error rate ``errors / max(n, 1)`` over all batches of all
    sources, and the mean duration of the ``last`` batches by the time they ended."""
    m = spark.read.parquet(path)
    counters = ["processed_rows", "rejected_rows", "input_rows"]
    newest = m.orderBy(F.desc("finished_at"), F.desc("source"), F.desc("batch_id")).limit(last)
    both = m.select(*counters, F.lit(None).cast("double").alias("_d")).unionByName(
        newest.select(*[F.lit(0).cast("long").alias(c) for c in counters],
                      F.col("duration_sec").alias("_d")))
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(a)
            for c, a in zip(counters, ("processed", "errors", "_n"))]
    return both.agg(*sums, F.avg("_d").alias("avg_batch_seconds")).select(
        "processed", "errors", (F.col("errors") / F.greatest("_n", F.lit(1))).alias("error_rate"),
        "avg_batch_seconds")


def source_backlog(progress) -> int | None:
    """What the sources hold beyond the processed offsets: records for sources that report
    numeric offsets per topic and partition, else the backlog that a file source reports (files
    not yet read). None if no source tells."""
    total, told = 0, False
    for s in progress.sources:
        extra = dict(s.metrics or {})
        if "numFilesOutstanding" in extra:
            total, told = total + int(extra["numFilesOutstanding"]), True
            continue
        try:
            end, latest = json.loads(s.endOffset), json.loads(s.latestOffset)
            total += sum(int(n) - int(end.get(t, {}).get(p, 0))
                         for t, parts in latest.items() for p, n in parts.items())
            told = True
        except (TypeError, ValueError, AttributeError):
            continue
    return total if told else None


def progress_metrics(query: StreamingQuery, latency_limit_ms: int = 5000,
                     backlog_limit: int = 1000) -> dict:
    """A16/A17 from the last ``StreamingQueryProgress``: latency, rates, observed counts and
    threshold flags: batch latency above ``latency_limit_ms``, and more than ``backlog_limit``
    records (or files) waiting in the sources."""
    p = query.lastProgress
    if not p:
        return {}
    latency = p.durationMs.get("triggerExecution", 0)
    observed = (p.observedMetrics or {}).get("ingest")
    out = {
        "batch_id": p.batchId,
        "input_rows": p.numInputRows,
        "input_rows_per_sec": p.inputRowsPerSecond,
        "processed_rows_per_sec": p.processedRowsPerSecond,
        "latency_ms": latency,
        "watermark": (p.eventTime or {}).get("watermark"),
        "rows_without_id": observed["rows_without_id"] if observed else None,
        "late_rows_dropped": sum(op.numRowsDroppedByWatermark for op in p.stateOperators),
        "max_event_ts": observed["max_event_ts"] if observed else None,
    }
    out["latency_alert"] = latency > latency_limit_ms
    out["backlog"] = source_backlog(p)
    out["backlog_alert"] = (out["backlog"] or 0) > backlog_limit
    return out
