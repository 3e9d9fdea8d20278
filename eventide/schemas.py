"""Declared schemas of the content dimension, raw events, enriched events and outputs."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the event model (must equal the source application's domain).
EVENT_TYPES = ("play", "pause", "finish", "click")
CONTENT_TYPES = ("podcast", "newsletter", "video")
# Event types whose duration is required.
DURATION_REQUIRED = ("play", "pause", "finish")
# Base score per event type; engagement boosts it by up to 100 %.
BASE_SCORES = {"play": "1.0", "pause": "0.5", "finish": "3.0", "click": "0.3"}
# Keys the clients put in raw_payload.
PAYLOAD_KEYS = ("session_id", "ip_address", "user_agent", "referrer", "screen_resolution")

UUID_PATTERN = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"

CONTENT = T.StructType([
    T.StructField("content_id", T.StringType(), False),
    T.StructField("slug", T.StringType(), False),
    T.StructField("title", T.StringType(), False),
    T.StructField("content_type", T.StringType(), True),
    T.StructField("length_seconds", T.IntegerType(), True),
    T.StructField("publish_ts", T.TimestampNTZType(), True),
])

EVENT = T.StructType([
    T.StructField("id", T.LongType(), True),
    T.StructField("content_id", T.StringType(), True),
    T.StructField("user_id", T.StringType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("event_ts", T.TimestampNTZType(), True),
    T.StructField("duration_ms", T.IntegerType(), True),
    T.StructField("device", T.StringType(), True),
    T.StructField("raw_payload", T.StringType(), True),
])

# Raw JSON as it arrives on the wire: every field a string, so that type errors become
# quarantine reasons instead of silent NULLs.
RAW_EVENT_JSON = T.StructType([
    T.StructField(f.name, T.StringType(), True) for f in EVENT.fields
])

MONEY = T.DecimalType(18, 2)
SCORE = T.DecimalType(18, 5)

ENRICHED_COLUMNS = [
    "id", "content_id", "user_id", "event_type", "event_ts", "duration_ms", "device", "raw_payload",
    "slug", "title", "content_type", "length_seconds", "engagement_seconds", "engagement_pct",
]

# The fact table as it is stored (exact engagement values, partition columns last).
FACT = T.StructType([
    T.StructField("event_id", T.LongType(), True),
    T.StructField("content_id", T.StringType(), True),
    T.StructField("user_id", T.StringType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("event_timestamp", T.TimestampNTZType(), True),
    T.StructField("duration_ms", T.IntegerType(), True),
    T.StructField("engagement_seconds", MONEY, True),
    T.StructField("engagement_pct", MONEY, True),
    T.StructField("device", T.StringType(), True),
    T.StructField("content_slug", T.StringType(), True),
    T.StructField("content_title", T.StringType(), True),
    T.StructField("content_type", T.StringType(), True),
    T.StructField("content_length_seconds", T.IntegerType(), True),
    T.StructField("raw_payload", T.StringType(), True),
    T.StructField("processed_timestamp", T.TimestampType(), True),
    T.StructField("event_date", T.DateType(), True),
    T.StructField("source", T.StringType(), True),
    T.StructField("batch_id", T.LongType(), True),
])

WAREHOUSE = T.StructType([
    T.StructField("event_id", T.LongType(), False),
    T.StructField("content_id", T.StringType(), False),
    T.StructField("user_id", T.StringType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("event_timestamp", T.TimestampNTZType(), False),
    T.StructField("duration_ms", T.IntegerType(), True),
    T.StructField("engagement_seconds", T.DoubleType(), True),
    T.StructField("engagement_pct", T.DoubleType(), True),
    T.StructField("device", T.StringType(), True),
    T.StructField("content_slug", T.StringType(), False),
    T.StructField("content_title", T.StringType(), False),
    T.StructField("content_type", T.StringType(), False),
    T.StructField("content_length_seconds", T.IntegerType(), True),
    T.StructField("raw_payload", T.StringType(), True),
    T.StructField("processed_timestamp", T.TimestampType(), False),
])
