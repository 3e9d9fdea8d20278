"""Record shapes derived from enriched events.

All are narrow ``select`` projections: no shuffle, whole-stage codegen, and Catalyst
prunes the scan to the columns each shape needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions import engagement as fx


def to_fact(enriched: DataFrame) -> DataFrame:
    """Warehouse fact row with warehouse column names and the ``event_date`` partition key.

    Engagement values stay exact DECIMAL(18,2); zero becomes NULL as in the warehouse
    record (D6), so averages over the fact table skip zeros like the source does.
    """
    return enriched.select(
        F.col("id").alias("event_id"), "content_id", "user_id", "event_type",
        F.col("event_ts").alias("event_timestamp"), "duration_ms",
        fx.nullif_zero("engagement_seconds").alias("engagement_seconds"),
        fx.nullif_zero("engagement_pct").alias("engagement_pct"),
        "device",
        F.col("slug").alias("content_slug"), F.col("title").alias("content_title"),
        "content_type", F.col("length_seconds").alias("content_length_seconds"),
        "raw_payload",
        F.to_date("event_ts").alias("event_date"),
    )


def to_warehouse_record(enriched: DataFrame, processed_ts: Column | None = None) -> DataFrame:
    """P5: the warehouse record: DOUBLE engagement values, zero as NULL, processing time."""
    return enriched.select(
        F.col("id").alias("event_id"), "content_id", "user_id", "event_type",
        F.col("event_ts").alias("event_timestamp"), "duration_ms",
        fx.nullif_zero("engagement_seconds").cast("double").alias("engagement_seconds"),
        fx.nullif_zero("engagement_pct").cast("double").alias("engagement_pct"),
        "device",
        F.col("slug").alias("content_slug"), F.col("title").alias("content_title"),
        "content_type", F.col("length_seconds").alias("content_length_seconds"),
        "raw_payload",
        (processed_ts if processed_ts is not None else F.current_timestamp())
        .alias("processed_timestamp"),
    )


def payload_metadata(enriched: DataFrame) -> Column:
    return F.struct(
        F.col("title").alias("content_title"), F.col("content_type").alias("content_type"),
        F.col("device").alias("device"),
        fx.nullif_zero("engagement_seconds").cast("double").alias("engagement_seconds"),
        fx.nullif_zero("engagement_pct").cast("double").alias("engagement_pct"),
        F.col("raw_payload").alias("raw_payload"),
    )


def to_payload(enriched: DataFrame) -> DataFrame:
    """External delivery payload with nested ``metadata`` and ISO ``timestamp``."""
    return enriched.select(
        F.col("id").alias("event_id"), "content_id", "user_id", "event_type",
        fx.iso_timestamp("event_ts").alias("timestamp"),
        payload_metadata(enriched).alias("metadata"),
    )


def to_payload_flat(enriched: DataFrame) -> DataFrame:
    """P6 flattened (one column per metadata field), for tabular checks."""
    return to_payload(enriched).select("event_id", "content_id", "user_id", "event_type",
                                       "timestamp", "metadata.*")


def to_payload_json(enriched: DataFrame) -> DataFrame:
    """P6 as a JSON document per event; NULL fields are kept as ``null``.

    ``raw_payload`` is embedded as a JSON value, not as a quoted string.
    """
    meta = F.struct(
        F.col("title").alias("content_title"), F.col("content_type").alias("content_type"),
        F.col("device").alias("device"),
        fx.nullif_zero("engagement_seconds").cast("double").alias("engagement_seconds"),
        fx.nullif_zero("engagement_pct").cast("double").alias("engagement_pct"),
        F.expr("try_parse_json(raw_payload)").alias("raw_payload"),
    )
    doc = F.struct(F.col("id").alias("event_id"), "content_id", "user_id", "event_type",
                   fx.iso_timestamp("event_ts").alias("timestamp"), meta.alias("metadata"))
    return enriched.select(F.col("id").alias("event_id"), F.col("content_id").alias("key"),
                           F.to_json(doc, {"ignoreNullFields": "false"}).alias("value"))


def to_recent_event(enriched: DataFrame) -> DataFrame:
    """The 7-field recent-event record (zero as NULL), keyed by content."""
    return enriched.select(
        "content_id", F.col("id").alias("event_id"), "user_id", "event_type",
        fx.iso_timestamp("event_ts").alias("timestamp"),
        fx.nullif_zero("engagement_seconds").cast("double").alias("engagement_seconds"),
        fx.nullif_zero("engagement_pct").cast("double").alias("engagement_pct"),
        "device", "event_ts",
    )


def to_event_record(enriched: DataFrame) -> DataFrame:
    """Per-event record with defaults: NULL becomes 0 or the empty string."""
    return enriched.select(
        F.col("id").alias("event_id"), "content_id", "user_id", "event_type",
        fx.iso_timestamp("event_ts").alias("timestamp"),
        F.coalesce("duration_ms", F.lit(0)).alias("duration_ms"),
        F.coalesce(F.col("engagement_seconds").cast("double"), F.lit(0.0)).alias("engagement_seconds"),
        F.coalesce(F.col("engagement_pct").cast("double"), F.lit(0.0)).alias("engagement_pct"),
        F.coalesce("device", F.lit("")).alias("device"),
        F.col("slug").alias("content_slug"), F.col("title").alias("content_title"),
        "content_type", "event_ts",
    )


# JSON timestamps keep microseconds (Spark's default JSON format stops at milliseconds).
JSON_TIME_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                     "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def to_change_row(events: DataFrame) -> DataFrame:
    """Change-feed record ``to_json(row)`` keyed by content id (for a Kafka sink)."""
    return events.select(F.col("content_id").cast("string").alias("key"),
                         F.to_json(F.struct(*events.columns), JSON_TIME_OPTIONS).alias("value"))


def with_payload_fields(df: DataFrame, payload: str = "raw_payload") -> DataFrame:
    """Client fields of the JSON payload as columns."""
    return df.select("*", *fx.payload_fields(payload))
