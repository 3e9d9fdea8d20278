"""Event-time windows and inactivity sessions in batch (ST3, ST4/D9).

Sliding windows come from running sums over change points of a (content, pane, user) grain.

Sessions (gap ``g``: a new session starts when the gap to the previous event of the same
content exceeds ``g``) are computed without sorting all events of a content in one task,
which a hot content id would turn into one huge task:

1. Events are aggregated per (content_id, cell, user) with ``cell = floor(ts / g)`` (hash
   aggregation with partial aggregation: skew-proof); cell bounds fold from that grain.
   All events in one cell are less than ``g`` apart, so a cell never splits a session.
2. Cells per content are bounded by the time span / g (not by event volume); sessions are
   found over cells with ``lag`` + running sum (gaps and islands).
3. The grain is joined to the cell->session map and folded per session (counts, seconds,
   exact distinct users), again with partial aggregation.

The result equals Spark's streaming ``session_window`` semantics: events exactly ``g``
apart stay in one session; ``session_end = last event + g``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions import engagement as fx


def _micros(col: str):
    return F.unix_micros(F.col(col).cast("timestamp"))


def sliding_counts(enriched: DataFrame, size_minutes: int = 10, slide_minutes: int = 1,
                   key: str = "content_id", distinct: str = "exact") -> DataFrame:
    """ST3: events and distinct users per key and sliding event-time window.

    ``exact``: see ``sliding_from_grain``; events are aggregated per (key, pane, user) first and
    never multiplied. ``sketch``: one partial row per (key, slide-wide pane) with an HLL
    sketch of its users; panes are expanded into windows and sketches merged, so the
    shuffle grows with panes, not events (approximate distinct counts, exact totals).
    """
    if distinct == "sketch":
        if size_minutes % slide_minutes:
            raise ValueError("sketch mode needs a window size that is a multiple of the slide")
        slide = int(slide_minutes) * 60 * 1_000_000
        us = F.unix_micros(F.col("event_ts").cast("timestamp"))
        panes = (enriched.withColumn("_pane", us - F.pmod(us, F.lit(slide)))
                 .groupBy(key, "_pane")
                 .agg(F.count(F.lit(1)).alias("_n"), F.sum(fx.content_score()).alias("_s"),
                      F.hll_sketch_agg("user_id").alias("_u")))
        k = F.explode(F.sequence(F.lit(0), F.lit(size_minutes // slide_minutes - 1))).alias("_k")
        win = (panes.select(key, "_n", "_s", "_u", "_pane", k)
               .withColumn("_start", F.col("_pane") - F.col("_k") * F.lit(slide)))
        return (win.groupBy(key, "_start")
                .agg(F.sum("_n").alias("total_events"),
                     F.hll_sketch_estimate(F.hll_union_agg("_u")).alias("unique_users"),
                     F.sum("_s").cast("double").alias("score"))
                .select(key,
                        F.timestamp_micros("_start").cast("timestamp_ntz").alias("window_start"),
                        F.timestamp_micros(F.col("_start") + F.lit(size_minutes * 60_000_000))
                        .cast("timestamp_ntz").alias("window_end"),
                        "total_events", "unique_users", "score"))
    return sliding_from_grain(pane_grain(enriched, slide_minutes, key), size_minutes,
                              slide_minutes, key)


def pane_grain(enriched: DataFrame, slide_minutes: int = 1, key: str = "content_id"
               ) -> DataFrame:
    """(key, pane, user_id, n, score): events and score of a user in each slide-wide pane
    (``pane`` counts slides since the epoch). Works on streams too."""
    slide = int(slide_minutes) * 60_000_000
    us = _micros("event_ts")
    pane = ((us - F.pmod(us, F.lit(slide))) / slide).cast("long")
    return (enriched.groupBy(key, pane.alias("pane"), "user_id")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(fx.content_score()).alias("score")))


def sliding_from_grain(grain: DataFrame, size_minutes: int = 10, slide_minutes: int = 1,
                       key: str = "content_id") -> DataFrame:
    """Exact sliding windows from the pane grain.

    Window ``w`` holds the panes ``w .. w + k - 1``. A pane adds its totals to the windows
    ``pane - k + 1 .. pane``: plus at the first, minus after the last. A user adds one to the
    windows of a pane that the user's previous pane has not counted yet. Running sums over these
    change points give all windows; between two points nothing changes. Per key there are at
    most two points a pane, whatever the number of events.
    """
    if size_minutes % slide_minutes:
        raise ValueError("the window size must be a multiple of the slide")
    k = size_minutes // slide_minutes
    before = F.lag("pane").over(Window.partitionBy(key, "user_id").orderBy("pane"))
    first = F.col("pane") - (k - 1)
    one = F.when(F.col("user_id").isNotNull(), 1).otherwise(0).cast("long")
    none, zero = F.lit(0).cast("long"), F.lit(0).cast("decimal(18,5)")
    s = F.col("score").cast("decimal(38,5)")

    def point(at, n, score, users):
        return F.struct(at.alias("at"), n.alias("n"), score.cast("decimal(38,5)").alias("s"),
                        users.alias("u"))

    points = (grain.withColumn("_new", F.greatest(first, F.coalesce(before + 1, first)))
              .select(key, F.explode(F.array(
                  point(first, F.col("n"), s, none), point(F.col("_new"), none, zero, one),
                  point(F.col("pane") + 1, -F.col("n"), -s, -one))).alias("p"))
              .groupBy(key, F.col("p.at").alias("at"))
              .agg(F.sum("p.n").alias("n"), F.sum("p.s").alias("s"), F.sum("p.u").alias("u")))
    order = Window.partitionBy(key).orderBy("at")
    run = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steady = points.select(
        key, "at", F.lead("at").over(order).alias("next"), F.sum("n").over(run).alias("n"),
        F.sum("s").over(run).alias("s"), F.sum("u").over(run).alias("u")).where("n > 0")
    slide = int(slide_minutes) * 60_000_000
    start = F.col("w") * F.lit(slide)
    return (steady.withColumn("w", F.explode(F.sequence(F.col("at"), F.col("next") - 1)))
            .select(key, F.timestamp_micros(start).cast("timestamp_ntz").alias("window_start"),
                    F.timestamp_micros(start + F.lit(k * slide)).cast("timestamp_ntz")
                    .alias("window_end"),
                    F.col("n").cast("long").alias("total_events"),
                    F.col("u").cast("long").alias("unique_users"),
                    F.col("s").cast("double").alias("score")))


def sessions(enriched: DataFrame, gap_minutes: int = 15, key: str = "content_id",
             materialize: bool = False) -> DataFrame:
    """ST4/D9: inactivity sessions per key with counts, distinct users and seconds.

    The (key, cell, user) grain feeds two branches (cell bounds and the per-session fold).
    Spark plans each branch from the events, so they are read twice; ``materialize=True``
    writes the grain once with a reliable ``checkpoint()`` under ``spark.checkpoint.dir``
    (eager: one job when the frame is built) and both branches read it, so the events are
    scanned once. Prefer it when producing the events is expensive (large inputs,
    JSON extraction, enrichment joins).
    """
    # 1. the (key, cell, user) grain with partial aggregation before the shuffle, and the
    #    cell bounds folded from it
    grain = session_grain(enriched, gap_minutes, key)
    if materialize:
        from eventide.session import checkpoint_dir
        checkpoint_dir(enriched.sparkSession)  # the shared folder named by the session
        grain = grain.checkpoint(eager=True)
    return sessions_from_grain(grain, gap_minutes, key)


def session_grain(enriched: DataFrame, gap_minutes: int = 15, key: str = "content_id"
                  ) -> DataFrame:
    """(key, _cell, user_id, _first, _last, _n, _es): a user's events in each gap-wide cell.
    Works on streams too."""
    gap = int(gap_minutes) * 60 * 1_000_000
    us = _micros("event_ts")
    return (enriched.groupBy(key, ((us - F.pmod(us, F.lit(gap))) / gap).cast("long")
                             .alias("_cell"), "user_id")
            .agg(F.min(us).alias("_first"), F.max(us).alias("_last"),
                 F.count(F.lit(1)).alias("_n"), F.sum("engagement_seconds").alias("_es")))


def sessions_from_grain(grain: DataFrame, gap_minutes: int = 15, key: str = "content_id"
                        ) -> DataFrame:
    """Sessions from the (key, cell, user) grain."""
    gap = int(gap_minutes) * 60 * 1_000_000
    cells = (grain.groupBy(key, "_cell")
             .agg(F.min("_first").alias("_first"), F.max("_last").alias("_last")))

    # 2. gaps and islands over cells (bounded per key by time span / gap); one window spec,
    #    so one shuffle: a session starts at a cell whose gap to the previous cell exceeds g,
    #    and every cell carries the start of the latest session start at or before it
    w = Window.partitionBy(key).orderBy("_cell")
    prev_last = F.lag("_last").over(w)
    starts = F.when(prev_last.isNull() | (F.col("_first") - prev_last > gap), F.col("_first"))
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cell_map = (cells.withColumn("_s", starts)
                .select(key, "_cell", F.last("_s", ignorenulls=True).over(running).alias("_start")))

    # 3. all measures from the grain mapped to sessions: one join, one aggregation; the
    #    distinct user count needs no second pass over the events
    per_session = (grain.join(cell_map, [key, "_cell"], "inner")
                   .groupBy(key, "_start")
                   .agg(F.max("_last").alias("_end"), F.sum("_n").alias("total_events"),
                        F.count_distinct("user_id").alias("unique_users"),
                        F.sum("_es").alias("_es")))
    return (per_session
            .select(key,
                    F.timestamp_micros("_start").cast("timestamp_ntz").alias("session_start"),
                    F.timestamp_micros(F.col("_end") + F.lit(gap)).cast("timestamp_ntz")
                    .alias("session_end"),
                    F.col("total_events").cast("bigint").alias("total_events"),
                    "unique_users",
                    F.coalesce(F.col("_es").cast("double"), F.lit(0.0))
                    .alias("total_engagement_seconds")))
