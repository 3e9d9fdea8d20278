"""Real-time serving aggregates over enriched events (A1, A2, A10, A11, A14, P10, T1, T3, T6, ST7).

Aggregations are keyed by ``content_id`` and use only combinable aggregates (count, sum,
min/max, max_by, distinct counts), so Spark runs a partial aggregate before the shuffle:
a content id holding a third of all events still ships one partial row per map task.
Top-k uses ``orderBy().limit()`` (TakeOrderedAndProject: k rows per task) and last-N per
key uses ``row_number() <= n``, which Spark plans with a partial window group limit
before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions import engagement as fx
from eventide.functions.time import trailing, ts_lit
from eventide.operators import projections as proj


def _exact_avg(col: str):
    """AVG over DECIMAL values as ``double(sum)/count`` (NULL when nothing counts)."""
    return F.try_divide(F.sum(col).cast("double"), F.count(col))


def content_stats(enriched: DataFrame) -> DataFrame:
    """A1 + A14 + P10: the serving row per content.

    total_events, exact distinct users, total engagement seconds (zero counts as
    nothing), average engagement percent over non-zero values, latest metadata.
    """
    meta = F.max_by(F.struct("slug", "title", "content_type"), "event_ts")
    return (enriched.groupBy("content_id")
            .agg(meta.alias("_m"),
                 F.count(F.lit(1)).alias("total_events"),
                 F.count_distinct("user_id").alias("unique_users"),
                 F.coalesce(F.sum(fx.nullif_zero("engagement_seconds")).cast("double"),
                            F.lit(0.0)).alias("total_engagement_seconds"),
                 F.try_divide(F.sum(fx.nullif_zero("engagement_pct")).cast("double"),
                              F.count(fx.nullif_zero("engagement_pct"))).alias("avg_engagement_pct"),
                 F.max("event_ts").alias("last_updated"))
            .select("content_id", "_m.slug", "_m.title", "_m.content_type", "total_events",
                    "unique_users", "total_engagement_seconds", "avg_engagement_pct",
                    "last_updated"))


def content_scores(enriched: DataFrame) -> DataFrame:
    """A2: cumulative exact score per content (only positive totals are ranked)."""
    return (enriched.withColumn("score", fx.content_score())
            .groupBy("content_id")
            .agg(F.sum("score").cast("double").alias("score"))
            .where(F.col("score") > 0))


def top_content(enriched: DataFrame, k: int = 10, with_meta: bool = False) -> DataFrame:
    """T1 + J5: top-k content by cumulative score, ties by content id descending.

    Score, counts and metadata come from one aggregation (one shuffle), then
    TakeOrderedAndProject keeps k rows per task.
    """
    aggs = [F.sum(fx.content_score()).cast("double").alias("score"),
            F.count(F.lit(1)).alias("total_events"),
            F.count_distinct("user_id").alias("unique_users"),
            F.coalesce(F.sum("engagement_seconds").cast("double"), F.lit(0.0))
            .alias("total_engagement_seconds")]
    if with_meta:
        aggs += [F.max_by(F.struct("slug", "title", "content_type"), "event_ts").alias("_m"),
                 F.max("event_ts").alias("last_updated")]
    ranked = (enriched.groupBy("content_id").agg(*aggs)
              .where(F.col("score") > 0)
              .orderBy(F.desc("score"), F.desc("content_id")).limit(k))
    if with_meta:
        ranked = ranked.select("content_id", "score", "_m.slug", "_m.title", "_m.content_type",
                               "total_events", "unique_users", "total_engagement_seconds",
                               "last_updated")
    return ranked


def windowed_top_content(enriched: DataFrame, as_of, minutes: int = 10, k: int = 10) -> DataFrame:
    """D8 (claimed behaviour): top-k by score within ``(as_of - minutes, as_of]``."""
    recent = enriched.where(trailing("event_ts", as_of, minutes, "MINUTE"))
    return top_content(recent, k)


def windowed_counts(enriched: DataFrame, as_of, minutes: int = 10) -> DataFrame:
    """A10: distinct events per content in ``(as_of - minutes, as_of]``."""
    return (enriched.where(trailing("event_ts", as_of, minutes, "MINUTE"))
            .groupBy("content_id")
            .agg(F.count_distinct("id").alias("events_in_window")))


def stats_card(enriched: DataFrame, content: DataFrame, as_of, minutes: int = 10) -> DataFrame:
    """Stats card for every catalogue entry; absent activity gives zeros.

    Lifetime measures are one aggregation; the windowed count is another whose time filter
    reaches the scan (one aggregation with both distinct counts would expand every event).
    Both are joined to the catalogue on content_id.
    """
    agg = (enriched.groupBy("content_id")
           .agg(F.count(F.lit(1)).alias("total_events"),
                F.count_distinct("user_id").alias("unique_users"),
                F.sum(fx.nullif_zero("engagement_seconds")).cast("double").alias("_es")))
    recent = windowed_counts(enriched, as_of, minutes)
    return (content.select("content_id").join(agg, "content_id", "left")
            .join(recent, "content_id", "left")
            .select("content_id",
                    F.coalesce("total_events", F.lit(0)).cast("bigint").alias("total_events"),
                    F.coalesce("unique_users", F.lit(0)).cast("bigint").alias("unique_users"),
                    F.coalesce("_es", F.lit(0.0)).alias("total_engagement_seconds"),
                    F.coalesce("events_in_window", F.lit(0)).cast("bigint").alias("events_in_window"),
                    F.lit(minutes).alias("window_minutes")))


def recent_events(enriched: DataFrame, n: int = 50, as_of=None, ttl_minutes: int | None = None
                  ) -> DataFrame:
    """The ``n`` newest events per content (P7 record), newest first.

    With ``as_of`` and ``ttl_minutes`` only contents active within the TTL before
    ``as_of`` keep a history, like a per-key expiry refreshed by each event.
    """
    rec = proj.to_recent_event(enriched)
    if as_of is not None:
        rec = rec.where(F.col("event_ts") <= ts_lit(as_of))
    w = Window.partitionBy("content_id").orderBy(F.desc("event_ts"), F.desc("event_id"))
    ranked = rec.withColumn("position", F.row_number().over(w)).where(F.col("position") <= n)
    if as_of is not None and ttl_minutes is not None:
        live = (rec.groupBy("content_id").agg(F.max("event_ts").alias("_last"))
                .where(F.col("_last") > ts_lit(as_of) - F.expr(f"INTERVAL {int(ttl_minutes)} MINUTE"))
                .select("content_id"))
        ranked = ranked.join(live, "content_id", "left_semi")
    return ranked.drop("event_ts")


def latest_per_key(df: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """Last write wins per key (the newest row by ``order_cols``).

    Rows without a key are no copies of each other: all of them stay, and none of them is
    sent to the ranking.
    """
    w = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order_cols])
    known = df.where(F.col(key).isNotNull())
    newest = known.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
    return newest.unionByName(df.where(F.col(key).isNull()))


def content_meta(enriched: DataFrame) -> DataFrame:
    """P10: latest metadata per content and the time it was last seen."""
    return (enriched.groupBy("content_id")
            .agg(F.max_by(F.struct("slug", "title", "content_type"), "event_ts").alias("_m"),
                 F.max("event_ts").alias("last_updated"))
            .select("content_id", "_m.slug", "_m.title", "_m.content_type", "last_updated"))


def event_cache(enriched: DataFrame, as_of, hours: int = 24) -> DataFrame:
    """ST7 + P8: per-event records retained for ``hours`` before ``as_of``."""
    live = enriched.where(trailing("event_ts", as_of, hours, "HOUR"))
    return proj.to_event_record(live).drop("event_ts")
