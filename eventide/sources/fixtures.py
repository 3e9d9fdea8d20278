"""Adapter from the driver tables (``part``, ``events``) to the engagement data model.

The same derivation exists as SQL for the DuckDB oracle (``eventide.plans.oracle``); both
are a plain projection over a full scan, so they scale with the tables and keep
Catalyst's column pruning and predicate pushdown.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture mapping (FIXTURES.md F1/F2).
CONTENT_ID_PREFIX = "00000000-0000-4000-8000-"
USER_ID_PREFIX = "00000000-0000-4000-9000-"
UNKNOWN_KEY = 900_000_000_000  # far above any part key: content that is not in the catalogue
# Start of the fixture's time; the dense variant (F4) compresses time 100x from here.
DENSE_BASE_MICROS = 1704067200000000
EVENT_TYPE_MAP = {"view": "play", "signup": "pause", "purchase": "finish", "click": "click"}
DEVICES = ("phone-a", "phone-b", "tablet", "desktop", "television", "speaker")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _padded_uuid(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(key.cast("string"), 12, "0"))


def content_from_part(part: DataFrame) -> DataFrame:
    """content dimension derived from all rows of ``part``."""
    k = F.col("p_partkey")
    ctype = (F.when(k % 3 == 0, "video").when(k % 3 == 1, "podcast").otherwise("newsletter"))
    length = (F.when(k % 3 == 2, F.lit(None).cast("int"))
              .when(k % 30 == 0, F.lit(0))
              .otherwise(F.col("p_size") * 10))
    publish = F.timestamp_micros(F.lit(DENSE_BASE_MICROS) + (k % 50) * F.lit(86_400_000_000))
    return part.select(_padded_uuid(CONTENT_ID_PREFIX, k).alias("content_id"),
                       F.concat(F.replace(F.lower("p_name"), F.lit(" "), F.lit("-")), F.lit("-"),
                                k.cast("string")).alias("slug"),
                       F.col("p_name").alias("title"),
                       ctype.alias("content_type"),
                       length.cast("int").alias("length_seconds"),
                       publish.cast("timestamp_ntz").alias("publish_ts"))


def events_from_raw(events: DataFrame, n_content: int) -> DataFrame:
    """engagement events derived from the driver ``events`` table.

    ``n_content`` (rows of ``part``) spreads two thirds of the events over the whole
    catalogue; the others stay on its first hundred entries (hot content). Every 19th event
    names content that the catalogue lacks. Every second payload carries the client fields.
    """
    eid = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("bigint")
    key = (F.when(eid % 19 == 0, k + F.lit(UNKNOWN_KEY))
           .when(eid % 3 == 0, k % F.lit(n_content))
           .otherwise((eid * F.lit(7919) + k) % F.lit(n_content)))
    user = F.col("user_id").cast("string")
    payload = F.when(eid % 2 == 0, F.col("props")).otherwise(F.concat(
        F.lit('{"k": '), k.cast("string"), F.lit(', "session_id": "s-'), user,
        F.lit('", "ip_address": "10.0.0.'), (F.col("user_id") % 250).cast("string"),
        F.lit('", "user_agent": "client/'), (eid % 7).cast("string"),
        F.lit('", "referrer": null, "screen_resolution": "'), (eid % 5 + 1).cast("string"),
        F.lit('00x600"}')))
    etype = F.col("event_type")
    mapped = F.lit("error")
    for src, dst in reversed(list(EVENT_TYPE_MAP.items())):
        mapped = F.when(etype == src, dst).otherwise(mapped)
    duration = (F.when((etype == "click") | (eid % 97 == 0), F.lit(None).cast("int"))
                .when(eid % 89 == 0, F.lit(0))
                .otherwise(F.round(F.col("value") * 1000).cast("int") + (eid % 10).cast("int")))
    dev = F.lit(None).cast("string")
    for i, name in reversed(list(enumerate(DEVICES))):
        dev = F.when((F.col("user_id") % 6).cast("int") == i, name).otherwise(dev)
    device = F.when(eid % 53 == 0, F.lit(None).cast("string")).otherwise(dev)
    return events.select(
        eid.alias("id"),
        _padded_uuid(CONTENT_ID_PREFIX, key).alias("content_id"),
        _padded_uuid(USER_ID_PREFIX, F.col("user_id")).alias("user_id"),
        mapped.alias("event_type"),
        F.col("ts").alias("event_ts"),
        duration.cast("int").alias("duration_ms"),
        device.alias("device"),
        payload.alias("raw_payload"),
    )


def with_defects(events: DataFrame, resent_after: str = "1 SECOND") -> DataFrame:
    """the defects that a bus delivers: events without id, without time, and events sent
    again (a copy ``resent_after`` later, or an exact copy for ``0 SECOND``)."""
    again = events.where("id % 41 = 0").withColumn(
        "event_ts", F.expr(f"event_ts + INTERVAL {resent_after}"))
    lost = events.withColumn("event_ts", F.when(F.col("id") % 103 != 0, F.col("event_ts")))
    lost = lost.withColumn("id", F.when(F.col("id") % 101 != 0, F.col("id")))
    return lost.unionByName(again)


def resent_batches(events: DataFrame, cuts: tuple[str, ...]) -> DataFrame:
    """F7 as batches: events with a ``batch`` by their time among ``cuts``; those that are sent
    again come a second time in the next batch. Some have lost their id."""
    batch = sum((F.when(F.col("event_ts") >= F.lit(c).cast("timestamp_ntz"), 1).otherwise(0)
                 for c in cuts), F.lit(0))
    dealt = events.withColumn("batch", batch)
    again = dealt.where("id % 41 = 0").withColumn("batch", F.col("batch") + 1)
    return dealt.withColumn("id", F.when(F.col("id") % 101 != 0, F.col("id"))).unionByName(again)


def content_with_defects(content: DataFrame) -> DataFrame:
    """F8: catalogue rows without slug or title, of an unknown type, or with a broken id."""
    k = F.substring("content_id", 25, 12).cast("bigint")
    return content.select(
        F.when(k % 23 == 0, F.concat(F.lit("x"), "content_id")).otherwise(F.col("content_id"))
        .alias("content_id"),
        F.when(k % 29 != 0, F.col("slug")).alias("slug"),
        F.when(k % 31 != 0, F.col("title")).alias("title"),
        F.when(k % 37 == 0, "film").otherwise(F.col("content_type")).alias("content_type"),
        "length_seconds", "publish_ts")


def documents_with_defects(docs: DataFrame) -> DataFrame:
    """JSON documents of events (column ``value``) of which some are cut short, carry a
    scalar payload, a fractional id, or ids without hyphens in upper case (which are valid)."""
    n = F.get_json_object("value", "$.id").cast("bigint")
    v = F.col("value")
    plain = F.regexp_replace(v, "00000000-0000-4000-9000-", "00000000000040009000")
    return docs.select(
        F.when(n % 43 == 0, F.substring(v, 1, 20))
        .when(n % 47 == 0, F.concat(F.lit('{"raw_payload": 5, '), F.regexp_replace(
            F.expr("substring(value, 2)"), '"raw_payload":', '"old_payload":')))
        .when(n % 53 == 0, F.regexp_replace(v, '^\\{"id":([0-9]+)', '{"id":$1.5'))
        .when(n % 59 == 0, plain).otherwise(v).alias("value"))


def load_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_from_part(table(spark, sf_dir, "part"))


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    n_content = table(spark, sf_dir, "part").count()  # from the file footers
    return events_from_raw(table(spark, sf_dir, "events"), n_content)


def densify(events: DataFrame, ts_col: str = "event_ts") -> DataFrame:
    base = DENSE_BASE_MICROS
    dense = F.expr(f"timestamp_micros({base} + (unix_micros(CAST(`{ts_col}` AS TIMESTAMP)) - {base}) div 100)")
    return events.withColumn(ts_col, dense.cast("timestamp_ntz"))


def load_dense_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return densify(load_events(spark, sf_dir))
