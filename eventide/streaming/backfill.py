"""Backfill (S4, ST13): replay a time range through the same operators as the stream.

The range is half-open ``[start, end)`` and pushed to the scan as a filter (and to the
``event_date`` partitions of a date-partitioned source). No paging: one batch job over
the range, so there is no unstable LIMIT/OFFSET order and no per-page sleep.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.time import half_open, ts_lit
from eventide.operators import enrich as en
from eventide.sinks import fs


SOURCE = "backfill"


def backfill_frame(events: DataFrame, content: DataFrame, start, end, strict: bool = True,
                   known_small: bool | None = None, ordered: bool = False) -> DataFrame:
    """Enriched rows of ``[start, end)``.

    ``strict=False`` applies only the checks of the historical path (required fields and a
    content match), not the live event-type and duration rules.
    ``ordered=True`` (T4) sorts by (event_ts, id) — a range-partitioned global sort, only
    for consumers that need replay order; aggregations and sinks do not.
    """
    ranged = events.where(half_open("event_ts", start, end))
    out = en.enrich_valid(ranged, content, strict=strict, known_small=known_small)
    return out.orderBy("event_ts", "id") if ordered else out


def backfill(events: DataFrame, content: DataFrame, start, end, sinks, batch_id: int,
             strict: bool = True) -> None:
    """Write the range through the same sink fan-out as a stream micro-batch, next to a
    running stream.

    Events that the fact table already has (in the days of the range, so partitions are
    pruned) are left out: what was streamed is not counted again. ``batch_id`` identifies the
    replay: running a backfill again with its id leaves the sinks as they are. Its fact and
    quarantine partitions have the number ``-1 - batch_id``, apart from the stream's.
    """
    from eventide.sinks.warehouse import read_fact
    from eventide.streaming.pipeline import process_batch

    own = -1 - int(batch_id)
    ranged = events.where(half_open("event_ts", start, end))
    if sinks.warehouse and fs.exists(events.sparkSession, sinks.warehouse):
        days = F.col("event_date").between(F.to_date(ts_lit(start)), F.to_date(ts_lit(end)))
        known = (read_fact(events.sparkSession, sinks.warehouse)
                 .where(days & ~((F.col("source") == SOURCE) & (F.col("batch_id") == own)))
                 .select(F.col("event_id").alias("id")).distinct())
        ranged = ranged.join(known, "id", "left_anti").select(*events.columns)
    process_batch(ranged, own, content, sinks, strict=strict, source=SOURCE)
