"""Stateful streaming operators on enriched event streams (ST3, ST4, ST5, ST9, ST10).

All take a streaming (or batch) DataFrame with TIMESTAMP ``event_ts`` and a watermark
already applied (``pipeline.prepare_stream``) and return a DataFrame for ``writeStream``.
State is keyed by (content_id, window/session) and bounded by the watermark.

Exact distinct counting is not supported by streaming aggregation (``count_distinct``
is refused); ``distinct="exact"`` uses ``size(collect_set(user_id))`` (state grows with
the distinct users of one window), ``"approx"`` uses ``approx_count_distinct`` (HLL,
bounded state).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions import engagement as fx


def _users(distinct: str) -> Column:
    if distinct == "approx":
        return F.approx_count_distinct("user_id").alias("unique_users")
    return F.size(F.collect_set("user_id")).cast("long").alias("unique_users")


def sliding_window_counts(stream: DataFrame, size: str = "10 minutes", slide: str = "1 minute",
                          distinct: str = "exact") -> DataFrame:
    """ST3: per content and sliding event-time window (append/update/complete)."""
    return (stream.groupBy("content_id", F.window("event_ts", size, slide).alias("w"))
            .agg(F.count(F.lit(1)).alias("total_events"), _users(distinct),
                 F.sum(fx.content_score()).cast("double").alias("score"))
            .select("content_id", F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"),
                    "total_events", "unique_users", "score"))


def session_stats(stream: DataFrame, gap: str = "15 minutes", distinct: str = "exact"
                  ) -> DataFrame:
    """ST4/D9: per-content inactivity sessions (append or complete mode)."""
    s = F.session_window("event_ts", gap).alias("s")
    return (stream.groupBy("content_id", s)
            .agg(F.count(F.lit(1)).alias("total_events"), _users(distinct),
                 F.coalesce(F.sum("engagement_seconds").cast("double"), F.lit(0.0))
                 .alias("total_engagement_seconds"))
            .select("content_id", F.col("s.start").cast("timestamp_ntz").alias("session_start"),
                    F.col("s.end").cast("timestamp_ntz").alias("session_end"),
                    "total_events", "unique_users", "total_engagement_seconds"))


def user_panes(stream: DataFrame, slide_minutes: int = 1) -> DataFrame:
    """ST3 state: the pane grain of ``operators.windows`` as a streaming aggregation. A state
    row is a few numbers, a hot content is spread over its users."""
    return _timed(stream, slide_minutes, "pane", lambda us: [
        F.count(F.lit(1)).alias("n"), F.sum(fx.content_score()).alias("score")])


def session_cells(stream: DataFrame, gap_minutes: int = 15) -> DataFrame:
    """ST4 state: the session grain of ``operators.windows`` as a streaming aggregation."""
    return _timed(stream, gap_minutes, "_cell", lambda us: [
        F.min(us).alias("_first"), F.max(us).alias("_last"), F.count(F.lit(1)).alias("_n"),
        F.sum("engagement_seconds").alias("_es")])


def _timed(stream: DataFrame, minutes: int, name: str, measures) -> DataFrame:
    """Tumbling windows as cells counted since the epoch, so that the watermark drops state."""
    us = F.unix_micros(F.col("event_ts").cast("timestamp"))
    cell = (F.unix_micros("_w.start") / (int(minutes) * 60_000_000)).cast("long")
    rows = stream.groupBy("content_id", F.window("event_ts", f"{int(minutes)} minutes").alias("_w"),
                          "user_id").agg(*measures(us))
    others = [c for c in rows.columns if c not in ("content_id", "_w", "user_id")]
    return rows.select("content_id", cell.alias(name), "user_id", *others)


def run_grain(grain: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
              mode: str = "update"):
    """Write the rows that each micro-batch changed (update mode) or closed (append mode) to
    ``<path>/batch_id=N``; a replayed batch overwrites its folder."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch_id={int(batch_id)}")

    return (grain.writeStream.outputMode(mode).foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "1 minute"})).start())


def read_grain(spark, path: str, keys: list[str]) -> DataFrame:
    """The grain as last updated: of each key the row of its newest batch."""
    rows = spark.read.parquet(path)
    others = [c for c in rows.columns if c not in (*keys, "batch_id")]
    return (rows.groupBy(*keys).agg(F.max_by(F.struct(*others), "batch_id").alias("_r"))
            .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others]))


def live_scores(stream: DataFrame) -> DataFrame:
    """ST9 input: cumulative exact score per content (update or complete mode)."""
    return (stream.groupBy("content_id")
            .agg(F.sum(fx.content_score()).alias("_score"), F.count(F.lit(1)).alias("total_events"))
            .select("content_id", F.col("_score").cast("double").alias("score"), "total_events"))


def live_top_content(stream: DataFrame, k: int = 10) -> DataFrame:
    """ST9: top-k content; sorting a streaming aggregate needs complete output mode."""
    return (live_scores(stream).where(F.col("score") > 0)
            .orderBy(F.desc("score"), F.desc("content_id")).limit(k))
