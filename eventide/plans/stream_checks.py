"""Registered queries that run the streaming path end to end.

The fixture events are replayed as a file stream (time-ordered appends, one time slice per
micro-batch) through ``run_stream`` into the sinks, or through a stateful stream operator;
the query then reads what the stream wrote. Each result must equal its batch twin, so the
same oracle SQL applies. Output lives under the session's ``spark.checkpoint.dir`` in a
fresh folder per run.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.time import ts_lit
from eventide.operators import windows
from eventide.operators.enrich import enrich
from eventide.operators.projections import to_change_row
from eventide.operators.validate import reasons_text, validate_raw
from eventide.plans import params as P
from eventide.session import checkpoint_dir, session_key
from eventide.sinks.delivery import deliver, delivery_stats
from eventide.sinks.quarantine import read_rejects
from eventide.sinks.serving import ServingStore
from eventide.sinks.warehouse import read_fact
from eventide.sources import fixtures as fx
from eventide.sources.change_feed import change_feed
from eventide.streaming import processors, progress, stateful
from eventide.streaming.backfill import backfill
from eventide.streaming.pipeline import (Sinks, file_events, prepare_stream, process_batch,
                                         processing_metrics, run_stream)

PARTS = 2
WRITTEN = ("source", "batch_id", "processed_timestamp")  # what the sinks add to a row
_runs: dict[tuple, str] = {}


def write_time_ordered(df: DataFrame, path: str, parts: int = PARTS, ts: str = "event_ts",
                       files_per_part: int | None = None) -> int:
    """Write ``parts`` appends in event-time order, as a producer would deliver them.

    Each append is a range of times, written as ``files_per_part`` files (default: the
    session's parallelism); rows without a time come with the first. The file stream source
    sees the appends in modification-time order, so the watermark never drops an on-time
    event. Returns ``files_per_part`` (use it as ``maxFilesPerTrigger`` for one slice per
    micro-batch).
    """
    k = files_per_part or df.sparkSession.sparkContext.defaultParallelism
    b = df.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).first()
    step = (b.hi - b.lo) / parts
    for i in range(parts):
        a = F.lit(b.lo + step * i).cast("timestamp_ntz")
        e = F.lit(b.lo + step * (i + 1)).cast("timestamp_ntz")
        later = F.col(ts) >= a if i else F.lit(True)
        sooner = F.col(ts) < e if i < parts - 1 else F.lit(True)
        part = later & sooner & F.col(ts).isNotNull()
        if not i:
            part = part | F.col(ts).isNull()
        df.where(part).repartition(k).write.mode("append").parquet(path)
    return k


def _root(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_dir(spark)}/eventide-{label}-{uuid.uuid4().hex[:12]}"


def pipeline_run(spark: SparkSession, sf_dir: str) -> str:
    """Run the full pipeline once per session and input folder; returns its output root."""
    key = (session_key(spark), sf_dir, "pipeline")
    if key in _runs:
        return _runs[key]
    root = _root(spark, "pipeline")
    sent = fx.with_defects(fx.load_events(spark, sf_dir), resent_after="0 SECOND")
    k = write_time_ordered(sent, f"{root}/source")
    sinks = Sinks(warehouse=f"{root}/fact", quarantine=f"{root}/quarantine",
                  serving=ServingStore(spark, f"{root}/serving", history=1000),
                  metrics=f"{root}/metrics")
    q = run_stream(spark, file_events(spark, f"{root}/source", max_files_per_trigger=k),
                   fx.load_content(spark, sf_dir), sinks, checkpoint=f"{root}/checkpoint",
                   trigger={"availableNow": True}, watermark="1 day", dedup=True)
    q.awaitTermination()
    _runs[key] = root
    return root


def _store(spark: SparkSession, sf_dir: str) -> ServingStore:
    return ServingStore(spark, f"{pipeline_run(spark, sf_dir)}/serving")


def q_stream_top_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _store(spark, sf_dir).top_content(20).select(
        "content_id", "score", "total_events", "unique_users", "total_engagement_seconds")


def q_stream_content_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _store(spark, sf_dir).content_stats().drop("score")


def q_stream_recent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _store(spark, sf_dir).recent_events(50)


def q_stream_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_fact(spark, f"{pipeline_run(spark, sf_dir)}/fact").drop(*WRITTEN)


def q_stream_restart_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1/ST2: two sources with equal batch numbers, one stopped and started again from its
    checkpoint, the other started after it with its own; then a replay of a batch of each.
    Every event is in the fact table once."""
    key = (session_key(spark), sf_dir, "restart")
    if key not in _runs:
        root = _root(spark, "restart")
        events, content = fx.load_events(spark, sf_dir), fx.load_content(spark, sf_dir)
        sinks = Sinks(warehouse=f"{root}/fact", quarantine=f"{root}/quarantine")
        thirds = [events.where(F.pmod("id", F.lit(3)) == i) for i in range(3)]

        def run(folder: str) -> None:
            run_stream(spark, file_events(spark, f"{root}/{folder}"), content, sinks,
                       checkpoint=f"{root}/checkpoint-{folder}", trigger={"availableNow": True}
                       ).awaitTermination()

        thirds[0].write.parquet(f"{root}/first")
        run("first")
        thirds[1].write.parquet(f"{root}/second")
        run("second")                                             # batch 0 of another source
        thirds[2].write.mode("append").parquet(f"{root}/first")
        run("first")                                              # restart: batch 1
        for part in ("first", "second"):                          # replays of batch 0 and 1
            source = json.loads(spark.read.text(f"{root}/checkpoint-{part}/metadata").first()[0])
            rows = thirds[2] if part == "first" else thirds[1]
            process_batch(rows, 1 if part == "first" else 0, content, sinks,
                          source=source["id"])
        _runs[key] = root
    return read_fact(spark, f"{_runs[key]}/fact").drop(*WRITTEN)


def q_stream_change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST14: rows appended to an event table come out of its change feed as JSON change rows, in
    batches of a few row groups, over a restart; parsed back they are the typed events."""
    key = (session_key(spark), sf_dir, "feed")
    if key not in _runs:
        root = _root(spark, "feed")
        events = fx.load_events(spark, sf_dir)

        def publish(df: DataFrame, batch_id: int) -> None:
            to_change_row(df).write.mode("overwrite").parquet(f"{root}/feed/batch_id={batch_id}")

        for part in (events.where("id % 2 = 0"), events.where("id % 2 = 1")):
            part.write.option("parquet.block.size", 1 << 20).mode("append").parquet(f"{root}/table")
            q = (change_feed(spark, f"{root}/table", checkpoint=f"{root}/checkpoint",
                             row_groups_per_trigger=8, settle_seconds=0.0)
                 .writeStream.option("checkpointLocation", f"{root}/checkpoint")
                 .foreachBatch(publish).trigger(processingTime="0 seconds").start())
            try:
                q.processAllAvailable()
            finally:
                q.stop()
        _runs[key] = root
    return validate_raw(spark.read.parquet(f"{_runs[key]}/feed").select("key", "value"),
                        "value")[0]


def q_stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = read_rejects(spark, f"{pipeline_run(spark, sf_dir)}/quarantine")
    return q.withColumn("reasons", reasons_text()).drop("source", "batch_id", "rejected_at")


def _grain_run(spark: SparkSession, sf_dir: str, label: str, build, keys: list[str]
               ) -> DataFrame:
    """Dense enriched events as a stream -> bounded grain -> its rows as last updated.

    The stream keeps one constant-size state row per (content, pane or cell, user) until the
    watermark passes and writes the rows that a micro-batch changed into that batch's own
    folder; the newest row of a key counts. Windows and sessions are computed from the grain
    when they are read.
    """
    key = (session_key(spark), sf_dir, label)
    if key not in _runs:
        root = _root(spark, label)
        k = write_time_ordered(fx.load_dense_events(spark, sf_dir), f"{root}/source")
        events = file_events(spark, f"{root}/source", max_files_per_trigger=k)
        enriched = enrich(events, fx.load_content(spark, sf_dir))[0]
        grain = build(prepare_stream(enriched, "1 hour", dedup=False))
        stateful.run_grain(grain, f"{root}/out", f"{root}/checkpoint",
                           trigger={"availableNow": True}).awaitTermination()
        _runs[key] = f"{root}/out"
    return stateful.read_grain(spark, _runs[key], keys)


def q_stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    grain = _grain_run(spark, sf_dir, "sessions", lambda s: stateful.session_cells(s, 15),
                       ["content_id", "_cell", "user_id"])
    return windows.sessions_from_grain(grain, 15)


def q_stream_sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    grain = _grain_run(spark, sf_dir, "sliding", lambda s: stateful.user_panes(s, 1),
                       ["content_id", "pane", "user_id"])
    return windows.sliding_from_grain(grain, 10, 1)


def q_stream_backfill_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST13: live batch, backfill, live batch, and a replay of each: every event counts once."""
    key = (session_key(spark), sf_dir, "backfill")
    if key not in _runs:
        root = _root(spark, "backfill")
        events, content = fx.load_events(spark, sf_dir), fx.load_content(spark, sf_dir)
        sinks = Sinks(warehouse=f"{root}/fact", quarantine=f"{root}/quarantine",
                      serving=ServingStore(spark, f"{root}/serving"))
        cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
        old, new = events.where(F.col("event_ts") < cut), events.where(F.col("event_ts") >= cut)
        seen = old.where("id % 2 = 0")  # half of the past was streamed, the rest is missing
        live = [seen, new]
        process_batch(live[0], 0, content, sinks, source="live")
        for _ in range(2):
            backfill(events, content, "2024-01-01 00:00:00", "2024-01-15 00:00:00", sinks, 7)
        for _ in range(2):
            process_batch(live[1], 1, content, sinks, source="live")
        backfill(events, content, "2024-01-01 00:00:00", "2024-01-15 00:00:00", sinks, 7)
        process_batch(live[0], 0, content, sinks, source="live")
        _runs[key] = root
    return ServingStore(spark, f"{_runs[key]}/serving").content_stats().drop("score")


def q_stream_event_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST7 through the serving store."""
    return _store(spark, sf_dir).cached_events(P.AS_OF, P.CACHE_HOURS)


def q_stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the batches' metrics add up to."""
    m = processing_metrics(spark, f"{pipeline_run(spark, sf_dir)}/metrics")
    return m.select("processed", "errors", "error_rate")


def q_stream_recent_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST6: the newest events per content as stream state, with a stop and a restart between the
    two halves of the events."""
    key = (session_key(spark), sf_dir, "recent-state")
    if key not in _runs:
        root = _root(spark, "recent-state")
        events, content = fx.load_events(spark, sf_dir), fx.load_content(spark, sf_dir)
        cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
        for half in (F.col("event_ts") < cut, F.col("event_ts") >= cut):
            events.where(half).write.mode("append").parquet(f"{root}/source")
            enriched = enrich(file_events(spark, f"{root}/source"), content)[0]
            with processors.rocksdb_state(spark):
                # longer than the events' time span: nothing of a replay expires
                history = processors.recent_history(
                    prepare_stream(enriched, "1 day"), emit=P.RECENT_N, ttl_minutes=90 * 24 * 60)
                q = stateful.run_grain(history, f"{root}/out", f"{root}/checkpoint",
                                       trigger={"availableNow": True})
            q.awaitTermination()
        _runs[key] = f"{root}/out"
    return processors.read_history(spark, _runs[key])


def q_stream_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST8: contents whose activity expired, up to an hour before the last event (later ends are
    behind the watermark's reach)."""
    key = (session_key(spark), sf_dir, "expiry")
    if key not in _runs:
        root = _root(spark, "expiry")
        dense = fx.load_dense_events(spark, sf_dir)
        k = write_time_ordered(dense, f"{root}/source")
        events = file_events(spark, f"{root}/source", max_files_per_trigger=k)
        enriched = enrich(events, fx.load_content(spark, sf_dir))[0]
        with processors.rocksdb_state(spark):
            swept = processors.expiry_sweep(prepare_stream(enriched, "10 minutes"),
                                            P.SESSION_GAP_MINUTES * 60)
            q = stateful.run_grain(swept, f"{root}/out", f"{root}/checkpoint",
                                   trigger={"availableNow": True}, mode="append")
        q.awaitTermination()
        _runs[key] = f"{root}/out"
    end = F.lit(P.EXPIRY_UNTIL).cast("timestamp_ntz")
    return spark.read.parquet(_runs[key]).drop("batch_id").where(F.col("session_end") < end)


def late_run(spark: SparkSession, sf_dir: str) -> str:
    """Three time slices with exact copies; some events of the first come with the last, more
    than the watermark's delay behind. Late rows are kept, progress is logged."""
    key = (session_key(spark), sf_dir, "late")
    if key not in _runs:
        root = _root(spark, "late")
        events, content = fx.load_events(spark, sf_dir), fx.load_content(spark, sf_dir)
        k = spark.sparkContext.defaultParallelism
        held = (F.col("id") % 17 == 0) & (F.col("event_ts") < ts_lit(P.LATE_BEFORE))
        bounds = [F.lit(True), *[F.col("event_ts") >= ts_lit(c) for c in P.LATE_CUTS]]
        ends = [*[F.col("event_ts") < ts_lit(c) for c in P.LATE_CUTS], F.lit(True)]
        for i, (lo, hi) in enumerate(zip(bounds, ends)):
            slice_ = events.where(lo & hi & ~held)
            sent = slice_.unionByName(slice_.where("id % 41 = 0"))
            if i == len(P.LATE_CUTS):
                sent = sent.unionByName(events.where(held))
            sent.repartition(k).write.mode("append").parquet(f"{root}/source")
        sinks = Sinks(warehouse=f"{root}/fact", quarantine=f"{root}/quarantine",
                      metrics=f"{root}/metrics")
        name = f"late-{uuid.uuid4().hex[:8]}"
        listener = progress.ProgressLog(spark, f"{root}/progress", (name,))
        spark.streams.addListener(listener)
        try:
            q = run_stream(spark, file_events(spark, f"{root}/source", max_files_per_trigger=k),
                           content, sinks, checkpoint=f"{root}/checkpoint", query_name=name,
                           trigger={"availableNow": True}, watermark="1 day", dedup=True,
                           keep_late=True)
            q.awaitTermination()
            listener.wait(q)
        finally:
            spark.streams.removeListener(listener)
        _runs[key] = root
    return _runs[key]


def q_stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST11: where the sent rows are: accepted, rejected, late or copies."""
    root = late_run(spark, sf_dir)
    late = F.array_contains("reasons", "late")
    rejects = read_rejects(spark, f"{root}/quarantine")
    copies = spark.read.parquet(f"{root}/metrics").agg(F.sum("duplicate_rows").alias("events"))
    return (read_fact(spark, f"{root}/fact").agg(F.count(F.lit(1)).alias("events"))
            .select(F.lit("accepted").alias("outcome"), "events")
            .unionByName(rejects.groupBy(F.when(late, "late").otherwise("rejected")
                                         .alias("outcome"))
                         .agg(F.count(F.lit(1)).alias("events")))
            .unionByName(copies.select(F.lit("duplicate").alias("outcome"), "events")))


def q_stream_latency_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts over the written progress; every batch exceeds the latency limit of this
    check, one has rows dropped as late."""
    rows = progress.read_progress(spark, f"{late_run(spark, sf_dir)}/progress")
    rows = rows.withColumn("sent", F.col("observed")["ingest.rows"].cast("long"))
    alerts = progress.latency_alerts(rows.where("sent > 0"), latency_ms=-1)
    return alerts.groupBy("alert").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("sent").alias("sent_rows"),
        F.sum("late_rows_dropped").alias("late_rows"))


class CheckClient:
    """Delivery client of the registered check: refuses some events, fails on others."""

    def post(self, body: str, url: str | None = None) -> int:
        event = json.loads(body)["event_id"]
        if event % 11 == 0:
            raise ConnectionError("no answer")
        return 500 if event % 7 == 0 else 200


def q_stream_delivery_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6/K8: what delivery of all enriched events adds up to."""
    enriched = enrich(fx.load_events(spark, sf_dir), fx.load_content(spark, sf_dir))[0]
    results = deliver(enriched, CheckClient, min_wait=0, max_wait=0)
    return delivery_stats(results)


def q_stream_top_content_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5 through the serving store."""
    return _store(spark, sf_dir).top_content(P.TOP_K).select(
        "content_id", "score", "slug", "title", "content_type", "total_events", "unique_users",
        "total_engagement_seconds", "last_updated")


STREAM_QUERIES = {name[2:]: fn for name, fn in sorted(globals().items())
                  if name.startswith("q_stream_") and callable(fn)}
# the batch twin whose oracle SQL each stream query must match, and whether the stream carries
# the defects of F7 (lost ids and times, exact copies)
ORACLE_TWIN = {
    "stream_top_content": ("top_content", True),
    "stream_content_stats": ("content_stats", True),
    "stream_recent_events": ("recent_events", True),
    "stream_recent_state": ("recent_events", False),
    "stream_event_cache": ("event_cache", True),
    "stream_top_content_meta": ("top_content_meta", True),
    "stream_backfill_stats": ("content_stats", False),
    "stream_sessions": ("sessions", False),
    "stream_sliding_counts": ("sliding_counts", False),
    "stream_change_feed": ("raw_json_valid", False),
}
