"""Enrichment of events with the content dimension.

The content catalogue is a dimension: it is broadcast when its size bound is proven
(``maybe_broadcast``) so the event side is never shuffled for the join; otherwise it is a
shuffle join on ``content_id`` with AQE skew handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions import engagement as fx
from eventide.operators.joins import maybe_broadcast
from eventide.operators.validate import (R_CONTENT_NOT_FOUND, REASONS, event_rules,
                                         reasons_column, violated)
from eventide.schemas import ENRICHED_COLUMNS

DIM_COLUMNS = ["content_id", "slug", "title", "content_type", "length_seconds"]


def _dim(content: DataFrame, known_small: bool | None, extra: tuple[str, ...] = ()) -> DataFrame:
    return maybe_broadcast(content.select(*DIM_COLUMNS, *extra), known_small=known_small)


def with_engagement(df: DataFrame, rounding: str = fx.ROUNDING_STREAM) -> DataFrame:
    """Add ``engagement_seconds`` and ``engagement_pct`` (P1/P2 or P3)."""
    df = df.withColumn("engagement_seconds", fx.engagement_seconds("duration_ms", rounding))
    return df.withColumn("engagement_pct", fx.engagement_pct(rounding=rounding))


def enrich_valid(events: DataFrame, content: DataFrame, rounding: str = fx.ROUNDING_STREAM,
                 strict: bool = True, known_small: bool | None = None,
                 extra: tuple[str, ...] = ()) -> DataFrame:
    """The valid events joined with content, then engagement columns.

    For consumers that need no rejects: the rules filter plain event columns before an inner
    join, so invalid rows are dropped at the scan and are never joined. ``extra`` names further
    catalogue columns to keep.
    """
    valid = events.where(~violated(event_rules(strict)))
    joined = valid.join(_dim(content, known_small, extra), "content_id", "inner")
    return with_engagement(joined, rounding).select(*ENRICHED_COLUMNS, *extra)


def unmatched(events: DataFrame, content: DataFrame, known_small: bool | None = None) -> DataFrame:
    """Events whose content id has no dimension row, tagged ``content_not_found``."""
    keys = _dim(content, known_small).select("content_id")
    return (events.join(keys, "content_id", "left_anti")
            .withColumn(REASONS, F.array(F.lit(R_CONTENT_NOT_FOUND))))


def tag(events: DataFrame, content: DataFrame, rounding: str = fx.ROUNDING_STREAM,
        strict: bool = True, known_small: bool | None = None) -> DataFrame:
    """One left join of all events with content; ``reasons`` lists every failed rule.

    Validation reasons and ``content_not_found`` are reported together, so a quarantined
    row carries all its problems. Both outputs of ``enrich`` derive from this frame.
    """
    dim = _dim(content, known_small).withColumn("_matched", F.lit(True))
    joined = events.join(dim, "content_id", "left")
    rules = event_rules(strict) + [(R_CONTENT_NOT_FOUND, F.col("_matched").isNull())]
    return with_engagement(joined.withColumn(REASONS, reasons_column(rules)), rounding)


def enrich(events: DataFrame, content: DataFrame, rounding: str = fx.ROUNDING_STREAM,
           strict: bool = True, known_small: bool | None = None) -> tuple[DataFrame, DataFrame]:
    """Validate, join and compute engagement. Returns (enriched, quarantine).

    Either output alone is planned for itself (the enriched rows by ``enrich_valid``); a caller
    that writes both persists ``tag(...)``, as ``process_batch`` does.
    """
    matched = enrich_valid(events, content, rounding, strict, known_small)
    tagged = tag(events, content, rounding, strict, known_small)
    quarantine = tagged.where(F.size(REASONS) > 0).select(*events.columns, REASONS)
    return matched, quarantine


def enriched_view(events: DataFrame, content: DataFrame, known_small: bool | None = None
                  ) -> DataFrame:
    """The test view: left join, HALF_UP from unrounded values, no validation."""
    joined = events.join(_dim(content, known_small), "content_id", "left")
    es = fx.engagement_seconds("duration_ms", fx.ROUNDING_VIEW)
    pct = fx.engagement_pct(rounding=fx.ROUNDING_VIEW)
    return joined.select("id", "content_id", "slug", "title", "content_type", "length_seconds",
                         "user_id", "event_type", "event_ts", "duration_ms",
                         es.alias("engagement_seconds"), pct.alias("engagement_pct"),
                         "device", "raw_payload")


def with_score(enriched: DataFrame) -> DataFrame:
    """Per-event content score."""
    return enriched.withColumn("score", fx.content_score())
