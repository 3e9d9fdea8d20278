"""Stateful operators: bounded history (ST6, ``transformWithState``) and expiry of inactive
contents (ST8, session windows).

State lives in RocksDB and is bounded by (contents) x (a fixed number of rows) and not by the
executors' heap. The history reads rows as an iterator and keeps no more of a content than the
state may hold: a content with a third of all events needs no more memory than another. State is part of the query's checkpoint: a restarted stream goes on
where it stopped.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from eventide.operators import projections as proj
from eventide.session import ship_code

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Streams started inside keep their state in RocksDB (a stream takes the session's settings
    when it starts); the session's own choice is put back."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


#: Groups of contents that share a state entry's timer and its calls to the state store.
HISTORY_BUCKETS = 4096


class RecentHistory(StatefulProcessor):
    """The newest ``keep`` events of each content, one per event id. A content's history ends when
    the watermark passes its newest event by ``ttl_ms``.
    (Event time, so that a replay expires what the live stream expired; Spark's own TTL counts
    processing time, and a stream with it never runs out of batches under ``availableNow``.)
    Sends the newest ``emit`` events, numbered, whenever a batch touches the content.

    The key is a bucket of contents, so that the calls to the state store (each a message to the
    JVM) do not grow with the catalogue. A bucket has one timer, for the first history to end."""

    def __init__(self, fields: list[str], state_schema, keep: int, emit: int, ttl_ms: int):
        self.fields, self.state_schema = fields, state_schema
        self.keep, self.emit, self.ttl_ms = keep, emit, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getListState("recent", self.state_schema)

    def _due(self, newest: tuple) -> int:
        return newest[0] // 1000 + 1 + self.ttl_ms

    def _newest(self, best: dict) -> list[tuple]:
        return sorted(best.values(), key=lambda v: (v[0], v[1]), reverse=True)[:self.keep]

    def _load(self) -> dict[str, list[tuple]]:
        """content -> its events, newest first, as they were put."""
        histories: dict = {}
        for value in self.kept.get():
            value = tuple(value)
            histories.setdefault(value[-1], []).append(value)
        return histories

    def _store(self, histories: dict[str, list[tuple]], due: int | None) -> None:
        """Put what is left; ``due`` is the time of the timer that is set, if one is."""
        if not histories:
            self.kept.clear()
        else:
            self.kept.put([v for values in histories.values() for v in values])
        first = min((self._due(values[0]) for values in histories.values()), default=None)
        if first != due:
            if due is not None:
                self.handle.deleteTimer(due)
            if first is not None:
                self.handle.registerTimer(first)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        kept = self._load()
        due = min((self._due(values[0]) for values in kept.values()), default=None)
        # rows come before timers: what the watermark has passed is gone for them, too
        watermark = timerValues.getCurrentWatermarkInMs()
        kept = {c: values for c, values in kept.items() if self._due(values[0]) > watermark}
        touched: dict[str, dict] = {}
        for row in rows:
            value = tuple(row[f] for f in ("_us", "event_id", *self.fields, "content_id"))
            best = touched.get(value[-1])
            if best is None:
                best = touched[value[-1]] = {v[1]: v for v in kept.get(value[-1], ())}
            old = best.get(value[1])
            if old is None or old[0] <= value[0]:
                best[value[1]] = value
            if len(best) > 2 * self.keep:  # never more than twice the bound
                touched[value[-1]] = {v[1]: v for v in self._newest(best)}
        for content, best in touched.items():
            kept[content] = self._newest(best)
        self._store(kept, due)
        record = Row("content_id", "position", "event_id", *self.fields)
        for content in touched:
            for i, value in enumerate(kept[content][:self.emit]):
                yield record(content, i + 1, *value[1:-1])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        self._store({c: values for c, values in self._load().items()
                     if self._due(values[0]) > watermark}, None)  # the timer that fired is gone
        return iter(())

    def close(self) -> None:
        pass


def recent_history(stream: DataFrame, keep: int = 1000, emit: int = 50, ttl_minutes: int = 60,
                   buckets: int = HISTORY_BUCKETS) -> DataFrame:
    """ST6: bounded history per content as stream state: for every content of a batch its newest
    ``emit`` events (the record of ``recent_events``, with ``position``). ``stream`` has a
    watermark. Update mode. A task holds the histories of one of ``buckets`` groups of contents;
    a checkpoint keeps the number that it began with."""
    ship_code(stream.sparkSession)
    rec = proj.to_recent_event(stream)
    rec = rec.withColumn("_us", F.unix_micros(F.col("event_ts").cast("timestamp")))
    kinds = {f.name: f.dataType for f in rec.schema.fields}
    fields = [c for c in rec.columns if c not in ("content_id", "event_id", "event_ts", "_us")]
    state = T.StructType([T.StructField(c, kinds[c], True)
                          for c in ("_us", "event_id", *fields, "content_id")])
    rec = rec.withColumn("_bucket", F.pmod(F.xxhash64("content_id"), F.lit(int(buckets))))
    out = T.StructType([T.StructField("content_id", T.StringType()),
                        T.StructField("position", T.IntegerType()),
                        *[T.StructField(c, kinds[c]) for c in ("event_id", *fields)]])
    return rec.groupBy("_bucket").transformWithState(
        RecentHistory(fields, state, int(keep), int(emit), int(ttl_minutes) * 60_000), out,
        "update", "eventTime")


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The history of every content as its newest batch wrote it (``stateful.run_grain``)."""
    rows = spark.read.parquet(path)
    newest = Window.partitionBy("content_id")
    return (rows.withColumn("_newest", F.max("batch_id").over(newest))
            .where(F.col("batch_id") == F.col("_newest")).drop("_newest", "batch_id"))


def expiry_sweep(stream: DataFrame, inactive_seconds: int = 900) -> DataFrame:
    """ST8: one row per content and span of activity, sent when ``inactive_seconds`` have passed
    in event time without another event; ``stream`` has a watermark. Append mode.

    Events no further apart than that are one span (Spark's session window); events that come late
    but within the watermark join or bridge spans. The watermark closes a span: its row is sent
    and its state dropped, so state is the open spans only.
    """
    cents = (F.col("engagement_seconds") * 100).cast("long")
    span = F.session_window("event_ts", f"{int(inactive_seconds)} seconds").alias("_s")
    swept = stream.groupBy("content_id", span).agg(
        F.count(F.lit(1)).alias("total_events"), F.sum(cents).alias("cents"))
    return swept.select(
        "content_id", F.col("_s.start").cast("timestamp_ntz").alias("session_start"),
        F.col("_s.end").cast("timestamp_ntz").alias("session_end"), "total_events",
        (F.coalesce("cents", F.lit(0)).cast("decimal(20,0)") / 100).cast("double")
        .alias("total_engagement_seconds"))
