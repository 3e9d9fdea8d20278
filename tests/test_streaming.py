"""Batch = stream equivalence, replay idempotence and sink behaviour."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from eventide.operators import realtime, windows
from eventide.operators.enrich import enrich
from eventide.sinks.serving import ServingStore
from eventide.sinks.warehouse import read_fact
from eventide.sources import fixtures as fx
from eventide.streaming import stateful
from eventide.streaming.pipeline import Sinks, file_events, process_batch, run_stream

SF = "/root/testdata/sf0.001"


def _rows(df, cols=None):
    cols = cols or sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*cols).collect()),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


def _write_time_ordered(df, path, parts, ts="event_ts"):
    """Write ``parts`` files in event-time order (one append each), as a producer would."""
    bounds = df.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).first()
    lo, hi = bounds.lo, bounds.hi + dt.timedelta(microseconds=1)
    step = (hi - lo) / parts
    for i in range(parts):
        a, b = lo + step * i, lo + step * (i + 1)
        (df.where((F.col(ts) >= F.lit(a)) & (F.col(ts) < F.lit(b))).coalesce(1)
         .write.mode("append").parquet(path))


@pytest.fixture(scope="module")
def data(spark):
    content = fx.load_content(spark, SF)
    events = fx.load_events(spark, SF)
    enriched, quarantine = enrich(events, content)
    return content, events, enriched, quarantine


@pytest.fixture(scope="module")
def streamed(spark, data, tmp_path_factory):
    content, events, _, _ = data
    root = str(tmp_path_factory.mktemp("pipeline"))
    _write_time_ordered(events, f"{root}/source", 4)
    sinks = Sinks(warehouse=f"{root}/fact", quarantine=f"{root}/quarantine",
                  serving=ServingStore(spark, f"{root}/serving"), metrics=f"{root}/metrics")
    q = run_stream(spark, file_events(spark, f"{root}/source", max_files_per_trigger=1), content,
                   sinks, checkpoint=f"{root}/ckpt", trigger={"availableNow": True},
                   watermark="1 day")
    q.awaitTermination()
    return root, sinks


def test_stream_fact_equals_batch(spark, data, streamed):
    root, _ = streamed
    _, events, enriched, quarantine = data
    from eventide.operators.projections import to_fact
    fact = read_fact(spark, f"{root}/fact").drop("source", "batch_id", "processed_timestamp")
    expected = to_fact(enriched)
    assert _rows(fact, sorted(expected.columns)) == _rows(expected)
    q = spark.read.parquet(f"{root}/quarantine")
    assert q.count() == quarantine.count()
    m = spark.read.parquet(f"{root}/metrics")
    assert m.agg(F.sum("input_rows")).first()[0] == events.count()
    assert m.count() >= 4  # one metrics row per micro-batch


def test_serving_equals_batch(spark, data, streamed):
    _, sinks = streamed
    _, _, enriched, _ = data
    store = sinks.serving
    cols = ["content_id", "slug", "title", "content_type", "total_events", "unique_users",
            "total_engagement_seconds", "avg_engagement_pct", "last_updated"]
    assert _rows(store.content_stats(), cols) == _rows(realtime.content_stats(enriched), cols)
    top_cols = ["content_id", "score", "total_events", "unique_users", "total_engagement_seconds"]
    assert (_rows(store.top_content(20), top_cols)
            == _rows(realtime.top_content(enriched, 20), top_cols))
    assert _rows(store.recent_events(50)) == _rows(realtime.recent_events(enriched, 50))


def test_replay_is_idempotent(spark, data, tmp_path):
    content, events, enriched, _ = data
    root = str(tmp_path)
    store = ServingStore(spark, f"{root}/serving")
    sinks = Sinks(warehouse=f"{root}/fact", quarantine=f"{root}/q", serving=store)
    first = events.where(F.col("event_ts") < F.lit("2024-01-15"))
    second = events.where(F.col("event_ts") >= F.lit("2024-01-15"))
    process_batch(first, 0, content, sinks)
    process_batch(second, 1, content, sinks)
    stats_once = _rows(store.content_stats())
    fact_once = read_fact(spark, f"{root}/fact").count()
    process_batch(second, 1, content, sinks)  # replay of the last batch
    assert _rows(store.content_stats()) == stats_once
    assert read_fact(spark, f"{root}/fact").count() == fact_once == enriched.count()
    cols = ["content_id", "total_events", "unique_users"]
    assert _rows(store.content_stats(), cols) == _rows(realtime.content_stats(enriched), cols)


def test_sketch_mode_close_to_exact(spark, data, tmp_path):
    content, events, enriched, _ = data
    store = ServingStore(spark, str(tmp_path / "serving"), distinct="sketch")
    process_batch(events, 0, content, Sinks(serving=store))
    got = {r.content_id: r.unique_users for r in store.content_stats().collect()}
    exp = {r.content_id: r.unique_users for r in realtime.content_stats(enriched).collect()}
    assert got.keys() == exp.keys()
    assert all(abs(got[k] - exp[k]) <= max(2, 0.05 * exp[k]) for k in exp)


def _stream_of(spark, df, path):
    df.write.mode("overwrite").parquet(path)
    s = spark.readStream.schema(df.schema).parquet(path)
    return s.withColumn("event_ts", F.col("event_ts").cast("timestamp")).withWatermark(
        "event_ts", "1 day")


def _run_complete(stream_df, name):
    q = (stream_df.writeStream.outputMode("complete").format("memory").queryName(name)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return stream_df.sparkSession.table(name)


def test_stream_windows_equal_batch(spark, tmp_path):
    content = fx.load_content(spark, SF)
    dense, _ = enrich(fx.load_dense_events(spark, SF), content)
    s = _stream_of(spark, dense, str(tmp_path / "dense"))
    got = _run_complete(stateful.sliding_window_counts(s, "10 minutes", "1 minute"), "sw")
    assert _rows(got) == _rows(windows.sliding_counts(dense, 10, 1))


def test_stream_sessions_equal_batch(spark, tmp_path):
    content = fx.load_content(spark, SF)
    dense, _ = enrich(fx.load_dense_events(spark, SF), content)
    s = _stream_of(spark, dense, str(tmp_path / "dense"))
    got = _run_complete(stateful.session_stats(s, "15 minutes"), "sess")
    assert _rows(got) == _rows(windows.sessions(dense, 15))


def test_live_top_content_equals_batch(spark, data, tmp_path):
    _, _, enriched, _ = data
    s = _stream_of(spark, enriched, str(tmp_path / "enriched"))
    got = _run_complete(stateful.live_top_content(s, 10), "top")
    exp = realtime.top_content(enriched, 10)
    assert _rows(got, ["content_id", "score", "total_events"]) == _rows(
        exp, ["content_id", "score", "total_events"])


def test_sessions_split_exactly_above_gap(spark):
    """Gap equal to 15 min stays one session; 1 us more splits."""
    base = dt.datetime(2024, 1, 1, 0, 0, 0)
    cid = "11111111-1111-4111-8111-000000000001"
    rows = [(cid, "u1", base, None), (cid, "u2", base + dt.timedelta(minutes=15), None),
            (cid, "u1", base + dt.timedelta(minutes=30, microseconds=1), None)]
    df = spark.createDataFrame(rows, "content_id string, user_id string, event_ts timestamp_ntz, "
                                     "engagement_seconds decimal(18,2)")
    got = windows.sessions(df, 15).orderBy("session_start").collect()
    assert [(r.total_events, r.unique_users) for r in got] == [(2, 2), (1, 1)]
    assert got[0].session_end == base + dt.timedelta(minutes=30)


def test_sessions_brute_force_random(spark):
    """Cell-based sessions equal a direct sort-and-scan over random events."""
    import random
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for k in range(3):
        t = base
        for _ in range(300):
            t += dt.timedelta(seconds=rnd.choice([1, 60, 600, 899, 900, 901, 1800, 3600]))
            rows.append((f"c{k}", f"u{rnd.randint(0, 20)}", t, None))
    df = spark.createDataFrame(rows, "content_id string, user_id string, event_ts timestamp_ntz, "
                                     "engagement_seconds decimal(18,2)")
    exp = []
    for k in sorted({r[0] for r in rows}):
        evs = sorted((r for r in rows if r[0] == k), key=lambda r: r[2])
        cur = [evs[0]]
        for e in evs[1:]:
            if e[2] - cur[-1][2] > dt.timedelta(minutes=15):
                exp.append((k, cur[0][2], len(cur), len({x[1] for x in cur})))
                cur = []
            cur.append(e)
        exp.append((k, cur[0][2], len(cur), len({x[1] for x in cur})))
    for materialize in (False, True):
        got = sorted((r.content_id, r.session_start, r.total_events, r.unique_users)
                     for r in windows.sessions(df, 15, materialize=materialize).collect())
        assert got == sorted(exp)


def test_delivery_with_recording_client(spark, data, tmp_path):
    from clients import FileClient

    from eventide.sinks.delivery import deliver, delivery_stats
    _, _, enriched, _ = data
    out = str(tmp_path / "sent")
    ids = [r.id for r in enriched.select("id").limit(3).collect()]
    results = deliver(enriched, lambda: FileClient(out, fail_ids=tuple(ids)), min_wait=0, max_wait=0)
    results = results.cache()
    n = enriched.count()
    stats = delivery_stats(results).first()
    assert stats.sent_count == n - 3
    assert stats.error_count == 9  # three attempts for each failing event
    assert stats.total_attempts == n - 3 + 9
    lines = [json.loads(x) for f in os.listdir(out) for x in open(os.path.join(out, f))]
    assert len(lines) == n - 3
    doc = lines[0]
    assert set(doc) == {"event_id", "content_id", "user_id", "event_type", "timestamp", "metadata"}
    assert set(doc["metadata"]) == {"content_title", "content_type", "device",
                                    "engagement_seconds", "engagement_pct", "raw_payload"}


def test_delivery_non_2xx_not_retried(spark, data, tmp_path):
    from clients import FileClient

    from eventide.sinks.delivery import deliver, delivery_stats
    _, _, enriched, _ = data
    small = enriched.limit(5)
    res = deliver(small, lambda: FileClient(str(tmp_path / "s"), status=500), min_wait=0, max_wait=0)
    st = delivery_stats(res).first()
    assert (st.sent_count, st.error_count, st.error_rate) == (0, 5, 1.0)


def test_backfill_through_sinks(spark, data, tmp_path):
    from eventide.streaming.backfill import backfill, backfill_frame
    content, events, _, _ = data
    root = str(tmp_path)
    sinks = Sinks(warehouse=f"{root}/fact")
    backfill(events, content, "2024-01-10 00:00:00", "2024-01-17 00:00:00", sinks, batch_id=0)
    backfill(events, content, "2024-01-10 00:00:00", "2024-01-17 00:00:00", sinks, batch_id=0)
    exp = backfill_frame(events, content, "2024-01-10 00:00:00", "2024-01-17 00:00:00")
    fact = read_fact(spark, f"{root}/fact")
    assert fact.count() == exp.count()
    assert _rows(fact.select("event_id")) == _rows(exp.select(F.col("id").alias("event_id")))


def test_sliding_sketch_mode_matches_exact_totals(spark):
    content = fx.load_content(spark, SF)
    dense, _ = enrich(fx.load_dense_events(spark, SF), content)
    exact = {(r.content_id, r.window_start): r for r in windows.sliding_counts(dense).collect()}
    sketch = {(r.content_id, r.window_start): r
              for r in windows.sliding_counts(dense, distinct="sketch").collect()}
    assert exact.keys() == sketch.keys()
    for k, e in exact.items():
        s = sketch[k]
        assert (s.total_events, s.score, s.window_end) == (e.total_events, e.score, e.window_end)
        assert abs(s.unique_users - e.unique_users) <= max(1, 0.05 * e.unique_users)


def test_hot_key_results_whole(spark):
    """One content holds a third of all events: operators stay exact (no capping)."""
    import random
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    hot = "11111111-1111-4111-8111-000000000001"
    rows = []
    for i in range(3000):
        cid = hot if i % 3 == 0 else f"11111111-1111-4111-8111-{rnd.randint(2, 60):012d}"
        ts = base + dt.timedelta(seconds=rnd.randint(0, 6 * 3600))
        rows.append((i, cid, f"u{rnd.randint(0, 300)}", rnd.choice(["play", "pause", "finish"]), ts,
                     rnd.randint(0, 60000)))
    df = spark.createDataFrame(rows, "id long, content_id string, user_id string, event_type string, "
                                     "event_ts timestamp_ntz, duration_ms int")
    df = (df.withColumn("engagement_seconds", (F.col("duration_ms") / 1000).cast("decimal(18,2)"))
          .withColumn("engagement_pct", F.lit(None).cast("decimal(18,2)")).withColumn("device", F.lit("ios"))
          .withColumn("slug", F.col("content_id")).withColumn("title", F.col("content_id"))
          .withColumn("content_type", F.lit("video")).withColumn("length_seconds", F.lit(None).cast("int"))
          .withColumn("raw_payload", F.lit(None).cast("string")))
    hot_rows = [r for r in rows if r[1] == hot]
    stats = {r.content_id: r for r in realtime.content_stats(df).collect()}
    assert stats[hot].total_events == len(hot_rows) == 1000
    assert stats[hot].unique_users == len({r[2] for r in hot_rows})
    recent = realtime.recent_events(df, 50).where(F.col("content_id") == hot).collect()
    newest = sorted(hot_rows, key=lambda r: (r[4], r[0]), reverse=True)[:50]
    assert [r.event_id for r in sorted(recent, key=lambda r: r.position)] == [r[0] for r in newest]
    sess = windows.sessions(df, 15).where(F.col("content_id") == hot).collect()
    assert sum(r.total_events for r in sess) == 1000


def test_serving_history_ttl(spark, data, streamed):
    _, sinks = streamed
    _, _, enriched, _ = data
    as_of, ttl = "2024-01-31 00:00:00", 3 * 24 * 60
    got = sinks.serving.recent_events(50, as_of=as_of, ttl_minutes=ttl)
    exp = realtime.recent_events(enriched, 50, as_of=as_of, ttl_minutes=ttl)
    assert 0 < got.count() < sinks.serving.recent_events(50).count()
    assert _rows(got) == _rows(exp)


def test_pair_compaction_keeps_counts(spark, data, tmp_path, monkeypatch):
    from eventide.sinks import serving
    monkeypatch.setattr(serving, "COMPACT_AFTER", 2)
    content, events, enriched, _ = data
    store = ServingStore(spark, str(tmp_path / "serving"), buckets=4)
    for i in range(5):
        process_batch(events.where(F.col("id") % 5 == i), i, content, Sinks(serving=store))
    held = store._manifest(store.latest())["pairs"]
    assert held and all(len(v) <= 3 for v in held.values())
    cols = ["content_id", "total_events", "unique_users"]
    assert _rows(store.content_stats(), cols) == _rows(realtime.content_stats(enriched), cols)


def test_restart_resumes_from_checkpoint(spark, data, tmp_path):
    """ST2: a restarted query processes only new input; sinks end equal to one batch run."""
    content, events, enriched, _ = data
    root = str(tmp_path)
    src = f"{root}/src"
    early = events.where(F.col("event_ts") < F.lit("2024-01-15"))
    late = events.where(F.col("event_ts") >= F.lit("2024-01-15"))
    store = ServingStore(spark, f"{root}/serving")
    sinks = Sinks(warehouse=f"{root}/fact", serving=store, metrics=f"{root}/m")

    def run():
        q = run_stream(spark, file_events(spark, src), content, sinks, checkpoint=f"{root}/ck",
                       trigger={"availableNow": True}, watermark="1 day")
        q.awaitTermination()

    early.coalesce(1).write.mode("append").parquet(src)
    run()
    late.coalesce(1).write.mode("append").parquet(src)
    run()  # new query object, same checkpoint
    m = spark.read.parquet(f"{root}/m")
    assert m.agg(F.sum("input_rows")).first()[0] == events.count()  # nothing read twice
    assert read_fact(spark, f"{root}/fact").count() == enriched.count()
    cols = ["content_id", "total_events", "unique_users", "total_engagement_seconds"]
    assert _rows(store.content_stats(), cols) == _rows(realtime.content_stats(enriched), cols)


def test_failed_batch_is_replayed_without_double_counting(spark, data, tmp_path):
    """A sink fails after others wrote: the query stops, the restart replays the batch and
    every sink ends exactly as after one clean run."""
    content, events, enriched, _ = data
    root = str(tmp_path)
    src = f"{root}/src"
    events.coalesce(1).write.parquet(src)
    store = ServingStore(spark, f"{root}/serving")

    class FailOnce:
        failed = False

        def write_batch(self, df, batch_id, batch_rows=None, source="stream"):
            store.write_batch(df, batch_id, batch_rows, source)
            if not FailOnce.failed:
                FailOnce.failed = True
                raise RuntimeError("simulated failure after the serving write")

    sinks = Sinks(warehouse=f"{root}/fact", quarantine=f"{root}/q", serving=FailOnce())

    def run():
        q = run_stream(spark, file_events(spark, src), content, sinks, checkpoint=f"{root}/ck",
                       trigger={"availableNow": True}, watermark="1 day")
        q.awaitTermination()

    with pytest.raises(Exception):
        run()
    run()
    assert read_fact(spark, f"{root}/fact").count() == enriched.count()
    cols = ["content_id", "total_events", "unique_users", "total_engagement_seconds"]
    assert _rows(store.content_stats(), cols) == _rows(realtime.content_stats(enriched), cols)


def _small(spark, n, first=0, ts="2024-01-01 10:00:00"):
    """A few enriched events of one content."""
    return spark.range(first, first + n).select(
        "id", F.lit("c1").alias("content_id"), F.concat(F.lit("u"), F.col("id")).alias("user_id"),
        F.lit("play").alias("event_type"), F.lit(ts).cast("timestamp_ntz").alias("event_ts"),
        F.lit(1000).alias("duration_ms"), F.lit(None).cast("string").alias("device"),
        F.lit(None).cast("string").alias("raw_payload"), F.lit("s").alias("slug"),
        F.lit("t").alias("title"), F.lit("video").alias("content_type"),
        F.lit(100).alias("length_seconds"),
        F.lit("1.00").cast("decimal(18,2)").alias("engagement_seconds"),
        F.lit("1.00").cast("decimal(18,2)").alias("engagement_pct"))


def test_commits_apply_in_order_of_arrival(spark, tmp_path):
    """Batch ids of a backfill or of a restarted stream do not hide other batches."""
    store = ServingStore(spark, str(tmp_path / "s"))
    total = lambda: store.content_stats().first().total_events
    store.write_batch(_small(spark, 2), 0, source="live")
    store.write_batch(_small(spark, 3, 10), 1_000_000, source="backfill")
    store.write_batch(_small(spark, 4, 20), 1, source="live")
    assert total() == 9
    store.write_batch(_small(spark, 4, 20), 1, source="live")  # replay of the newest
    store.write_batch(_small(spark, 3, 10), 1_000_000, source="backfill")  # and of an older one
    assert total() == 9
    store.write_batch(_small(spark, 5, 30), 0, source="fresh checkpoint")
    assert total() == 14
    store.write_batch(_small(spark, 1, 30), 0, source="fresh checkpoint")  # replay with less
    assert total() == 10


def test_cost_of_a_batch_does_not_grow(spark, tmp_path, monkeypatch):
    """Files that a batch leaves behind and commits that are kept stay the same."""
    from eventide.sinks import serving
    monkeypatch.setattr(serving, "COMPACT_AFTER", 4)
    store = ServingStore(spark, str(tmp_path / "s"), buckets=2, keep=3, history=5,
                         event_cache=False)
    seen = []
    for i in range(24):
        store.write_batch(_small(spark, 2, 2 * i), i)
        files = sum(len(f) for _, _, f in os.walk(tmp_path / "s"))
        seen.append((files, len(store.committed())))
    assert max(f for f, _ in seen[12:]) <= max(f for f, _ in seen[6:12])
    assert max(c for _, c in seen) <= 4
    assert store.content_stats().first().unique_users == 48


def test_resent_event_is_once_in_history(spark, tmp_path):
    store = ServingStore(spark, str(tmp_path / "s"))
    store.write_batch(_small(spark, 3), 0)
    store.write_batch(_small(spark, 1, ts="2024-01-01 11:00:00"), 1)  # event 0 again, later
    got = store.recent_events(10).collect()
    assert sorted(r.event_id for r in got) == [0, 1, 2]
    assert [r.event_id for r in got if r.position == 1] == [0]
    assert sorted(r.event_id for r in store.cached_events("2024-01-01 12:00:00", 3).collect()) == [
        0, 1, 2]


def test_expired_event_records_are_dropped(spark, tmp_path):
    store = ServingStore(spark, str(tmp_path / "s"), keep=2)
    store.write_batch(_small(spark, 3), 0)
    store.write_batch(_small(spark, 2, 5, ts="2024-01-03 10:00:00"), 1)
    assert store.expire_events("2024-01-03 12:00:00", 24) == [1]
    got = store.cached_events("2024-01-03 12:00:00", 24).collect()
    assert sorted(r.event_id for r in got) == [5, 6]
    assert store.content_stats().first().total_events == 5  # counters stay


def test_replay_leaves_nothing_of_an_earlier_attempt(spark, data, tmp_path):
    content, events, _, _ = data
    root = str(tmp_path)
    sinks = Sinks(warehouse=f"{root}/fact", quarantine=f"{root}/q")
    first = events.where((F.col("event_ts") < F.lit("2024-01-04")) | (F.col("id") % 19 == 0))
    process_batch(first, 0, content, sinks)
    fewer = events.where((F.col("event_ts") < F.lit("2024-01-03")) & (F.col("id") % 19 != 0))
    process_batch(fewer, 0, content, sinks)
    good, bad = enrich(fewer, content)
    fact = read_fact(spark, f"{root}/fact")
    assert _rows(fact.select("event_id")) == _rows(good.select("id"), ["id"])
    assert spark.read.parquet(f"{root}/q").count() == bad.count()
    process_batch(events.limit(0), 0, content, sinks)
    assert read_fact(spark, f"{root}/fact").count() == 0
    assert spark.read.parquet(f"{root}/q").count() == 0


def test_events_without_id_all_reach_the_quarantine(spark, data, tmp_path):
    content, events, _, _ = data
    root = str(tmp_path)
    three = events.limit(3).withColumn("id", F.lit(None).cast("long"))
    three.unionByName(three.limit(1).withColumn("event_ts", F.lit(None).cast("timestamp_ntz"))
                      ).coalesce(1).write.parquet(f"{root}/src")
    sinks = Sinks(quarantine=f"{root}/q")
    run_stream(spark, file_events(spark, f"{root}/src"), content, sinks, checkpoint=f"{root}/ck",
               trigger={"availableNow": True}, watermark="1 day", dedup=True).awaitTermination()
    assert spark.read.parquet(f"{root}/q").count() == 4


def test_alerts_count_events_without_time(spark, data):
    from eventide.operators import marts
    from eventide.operators.enrich import tag
    content, events, _, _ = data
    lost = events.limit(3).withColumn("event_ts", F.lit(None).cast("timestamp_ntz"))
    got = marts.error_rate_alerts(tag(lost, content)).collect()
    assert [(r.window_start, r.total_events, r.rejected_events) for r in got] == [(None, 3, 3)]
