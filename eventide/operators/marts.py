"""Analytic marts over the fact table.

Each mart is one filter (pushed to the parquet scan, and to ``event_date`` partitions
when reading the written fact table) and one hash aggregation with partial aggregation.
Averages are ``double(sum(decimal)) / count`` so they do not depend on summation order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions.time import dates_between, since, ts_lit


def _avg(col: str) -> Column:
    return F.try_divide(F.sum(col).cast("double"), F.count(col))


def _completions() -> Column:
    return F.sum(F.when(F.col("event_type") == "finish", 1).otherwise(0)).cast("bigint")


def engagement_stats(fact: DataFrame, start_date, end_date, limit: int = 100) -> DataFrame:
    """A3 + T2: per content between two dates (closed), most events first."""
    return (fact.where(dates_between("event_date", start_date, end_date))
            .groupBy("content_type", "content_slug", "content_title")
            .agg(F.count(F.lit(1)).alias("total_events"),
                 F.count_distinct("user_id").alias("unique_users"),
                 _avg("engagement_seconds").alias("avg_engagement_seconds"),
                 _avg("engagement_pct").alias("avg_engagement_pct"),
                 _completions().alias("completion_count"))
            .orderBy(F.desc("total_events"), F.asc("content_slug"))
            .limit(limit))


def top_content_lookback(fact: DataFrame, as_of, hours: int = 24, limit: int = 10) -> DataFrame:
    """A4 + T2: top content over the last ``hours`` before ``as_of``."""
    return (fact.where(since("event_timestamp", as_of, hours, "HOUR")
                       & (F.col("event_date") >= F.to_date(ts_lit(as_of) - F.expr(
                           f"INTERVAL {int(hours)} HOUR"))))
            .groupBy("content_id", "content_slug", "content_title", "content_type")
            .agg(F.count(F.lit(1)).alias("total_events"),
                 F.count_distinct("user_id").alias("unique_users"),
                 _avg("engagement_pct").alias("avg_engagement_pct"),
                 F.coalesce(F.sum("engagement_seconds").cast("double"), F.lit(0.0))
                 .alias("total_engagement_seconds"),
                 _completions().alias("completions"))
            .orderBy(F.desc("total_events"), F.desc_nulls_last("avg_engagement_pct"),
                     F.asc("content_id"))
            .limit(limit))


def daily_summary(fact: DataFrame) -> DataFrame:
    """A5: per day and content type (``ordered_daily`` serves it)."""
    return (fact.groupBy("event_date", "content_type")
            .agg(F.count(F.lit(1)).alias("total_events"),
                 F.count_distinct("user_id").alias("unique_users"),
                 F.count_distinct("content_id").alias("unique_content"),
                 _avg("engagement_seconds").alias("avg_engagement_seconds"),
                 _avg("engagement_pct").alias("avg_engagement_pct"),
                 _completions().alias("total_completions")))


def ordered_daily(summary: DataFrame) -> DataFrame:
    """T5: the daily mart as it is served, newest day first, then content type."""
    return summary.orderBy(F.desc("event_date"), "content_type")


def ordered_hourly(trends: DataFrame) -> DataFrame:
    """T5: the hourly mart as it is served, newest hour first, then content and event type."""
    return trends.orderBy(F.desc("hour_bucket"), "content_type", "event_type")


def daily_summary_recent(fact: DataFrame, as_of, days: int = 7) -> DataFrame:
    """The daily mart restricted to ``event_date >= date(as_of) - days``."""
    cutoff = F.date_sub(F.to_date(ts_lit(as_of)), days)
    return daily_summary(fact.where(F.col("event_date") >= cutoff))


def hourly_trends(fact: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Per hour, content type and event type over the last ``days`` (``ordered_hourly``
    serves it)."""
    start = ts_lit(as_of) - F.expr(f"INTERVAL {int(days)} DAY")
    return (fact.where(since("event_timestamp", as_of, days, "DAY")
                       & (F.col("event_date") >= F.to_date(start)))
            .groupBy(F.date_trunc("HOUR", "event_timestamp").cast("timestamp_ntz").alias("hour_bucket"),
                     "content_type", "event_type")
            .agg(F.count(F.lit(1)).alias("event_count"),
                 F.count_distinct("user_id").alias("unique_users"),
                 _avg("engagement_seconds").alias("avg_engagement_seconds")))


def window_stats(events: DataFrame, as_of, minutes: int = 60) -> DataFrame:
    """Global stats of raw events in the last ``minutes`` (one row)."""
    return (events.where(since("event_ts", as_of, minutes, "MINUTE"))
            .agg(F.count(F.lit(1)).alias("total_events"),
                 F.count_distinct("content_id").alias("unique_content"),
                 F.count_distinct("user_id").alias("unique_users"),
                 F.max("event_ts").alias("last_event")))


def freshness(events: DataFrame, as_of, minutes: int = 5) -> DataFrame:
    """Count and newest timestamp of raw events in the last ``minutes`` (one row)."""
    return (events.where(since("event_ts", as_of, minutes, "MINUTE"))
            .agg(F.count(F.lit(1)).alias("recent_events"), F.max("event_ts").alias("last_event")))


def today_count(fact: DataFrame, as_of) -> DataFrame:
    """Facts on the calendar day of ``as_of`` (partition-pruned on ``event_date``)."""
    return (fact.where(F.col("event_date") == F.to_date(ts_lit(as_of)))
            .agg(F.count(F.lit(1)).alias("today_events")))


def row_count(df: DataFrame, name: str = "total_rows") -> DataFrame:
    """``SELECT COUNT(*)`` as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias(name))


def overview(events: DataFrame, enriched: DataFrame, as_of, top_k: int = 5, show: int = 3
             ) -> DataFrame:
    """Last-hour stats and the first ``show`` of the top ``top_k`` content, as rows.

    Sections are stacked with ``unionByName`` (no join): one ``window_stats`` row and
    ``show`` ranked ``top_content`` rows.
    """
    from eventide.operators.realtime import top_content

    stats = window_stats(events, as_of, 60).select(
        F.lit("window_stats").alias("section"), F.lit(None).cast("int").alias("rank"),
        F.col("total_events").alias("events_last_hour"),
        F.col("unique_content").alias("unique_content_last_hour"),
        F.col("unique_users").alias("unique_users_last_hour"), "last_event")
    top = (top_content(enriched, top_k).orderBy(F.desc("score"), F.desc("content_id")).limit(show))
    # rank within the (at most top_k) rows; the window runs over a handful of rows only
    from pyspark.sql import Window
    top = top.select(F.lit("top_content").alias("section"),
                     F.row_number().over(Window.orderBy(F.desc("score"), F.desc("content_id")))
                     .cast("int").alias("rank"),
                     "content_id", "score", "total_events", "unique_users",
                     "total_engagement_seconds")
    return stats.unionByName(top, allowMissingColumns=True)


def error_rate_alerts(tagged: DataFrame, minutes: int = 5, threshold: float = 0.01) -> DataFrame:
    """Tumbling windows whose reject rate exceeds ``threshold``.

    ``tagged`` is the output of ``enrich.tag``: every raw event with its ``reasons``; one
    aggregation counts all events and the rejected ones together. Events without a time are
    counted in a window of their own whose bounds are NULL.
    """
    size = int(minutes) * 60_000_000
    us = F.unix_micros(F.col("event_ts").cast("timestamp"))
    rejected = F.when(F.size("reasons") > 0, 1).otherwise(0)
    return (tagged.groupBy((us - F.pmod(us, F.lit(size))).alias("w"))
            .agg(F.count(F.lit(1)).alias("total_events"),
                 F.sum(rejected).cast("bigint").alias("rejected_events"))
            .withColumn("error_rate", F.col("rejected_events") / F.col("total_events"))
            .where(F.col("error_rate") > threshold)
            .select(F.timestamp_micros("w").cast("timestamp_ntz").alias("window_start"),
                    F.timestamp_micros(F.col("w") + F.lit(size)).cast("timestamp_ntz")
                    .alias("window_end"),
                    "total_events", "rejected_events", "error_rate"))


def page(df: DataFrame, order_by: list[Column | str], size: int, number: int = 0) -> DataFrame:
    """One page of an ordered result (``ORDER BY ... LIMIT size OFFSET size*number``).

    The order must include a unique key for pages to be stable; for scans over a range use
    a filter (``half_open``) rather than deep offsets, which sort everything before them.
    """
    return df.orderBy(*order_by).offset(int(size) * int(number)).limit(int(size))
