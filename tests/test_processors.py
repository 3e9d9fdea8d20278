"""Stateful processors: bounded state, expiry in event time, late rows, progress as rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from eventide.schemas import ENRICHED_COLUMNS
from eventide.sinks.quarantine import read_rejects
from eventide.streaming import processors as pr
from eventide.streaming import progress, stateful
from eventide.streaming.pipeline import prepare_stream

T0 = dt.datetime(2024, 1, 1)
SCHEMA = ("id long, content_id string, user_id string, event_type string, event_ts timestamp_ntz, "
          "duration_ms int, device string, raw_payload string, slug string, title string, "
          "content_type string, length_seconds int, engagement_seconds decimal(18,2), "
          "engagement_pct decimal(18,2)")


def _event(i, content, minutes):
    return (i, content, f"u{i % 3}", "play", T0 + dt.timedelta(minutes=minutes), 1000, None, None,
            "s", "t", "video", 10, None if i % 4 == 0 else Decimal("1"), None)


def _send(spark, root, events):
    """One append: one micro-batch of the enriched stream."""
    rows = [_event(*e) for e in events]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/src")


def _enriched(spark, root, delay):
    stream = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
              .parquet(f"{root}/src").select(*ENRICHED_COLUMNS))
    return prepare_stream(stream, delay)


def _run(spark, root, build, mode, delay="10 minutes"):
    with pr.rocksdb_state(spark):
        q = stateful.run_grain(build(_enriched(spark, root, delay)), f"{root}/out", f"{root}/ck",
                               trigger={"availableNow": True}, mode=mode)
    assert q.awaitTermination(120)
    return q


def test_history_is_bounded_expires_and_survives_a_restart(spark, tmp_path):
    root = str(tmp_path)

    def build(s):
        return pr.recent_history(s, keep=5, emit=4, ttl_minutes=60)

    # a hot content with many events, sent again in part, and a quiet one
    _send(spark, root, [(i, "hot", i * 0.01) for i in range(400)] + [(1000, "quiet", 0)])
    _send(spark, root, [(i, "hot", i * 0.01) for i in range(390, 410)])
    q = _run(spark, root, build, "update")
    assert pr._PROVIDER not in {r.key for r in spark.sql("SET").collect()
                                if r.value == pr.ROCKSDB}
    got = {(r.content_id, r.position): r.event_id for r in pr.read_history(spark, f"{root}/out")
           .collect()}
    assert got == {**{("hot", p): 410 - p for p in (1, 2, 3, 4)}, ("quiet", 1): 1000}
    # 6 list entries, 2 timers and their bookkeeping, however many events came
    rows = q.recentProgress[-1].stateOperators[0].numRowsTotal
    assert rows <= 20
    # started again: the state of the first run is there; after an hour of silence it is not
    _send(spark, root, [(2000, "hot", 30)])
    _run(spark, root, build, "update")
    got = {r.position: r.event_id for r in pr.read_history(spark, f"{root}/out")
           .where("content_id = 'hot'").collect()}
    assert got == {1: 2000, 2: 409, 3: 408, 4: 407}
    _send(spark, root, [(3000, "other", 200)])       # moves the watermark past both contents
    _send(spark, root, [(4000, "hot", 201), (4001, "quiet", 201)])
    _run(spark, root, build, "update")
    got = sorted((r.content_id, r.event_id) for r in pr.read_history(spark, f"{root}/out")
                 .collect())
    assert got == [("hot", 4000), ("other", 3000), ("quiet", 4001)]


def test_expiry_rows_are_the_closed_spans(spark, tmp_path):
    root = str(tmp_path)
    _send(spark, root, [(1, "a", 0), (2, "a", 15), (3, "a", 31), (4, "b", 40)])
    # late but within the delay: bridges the spans of a that ended at 15 and began at 31
    _send(spark, root, [(5, "a", 29.5), (6, "b", 41)])
    _send(spark, root, [(7, "c", 300), (8, "b", 295)])
    _run(spark, root, lambda s: pr.expiry_sweep(s, 900), "append", "30 minutes")

    def at(minutes):
        return T0 + dt.timedelta(minutes=minutes)

    got = sorted((r.content_id, r.session_start, r.session_end, r.total_events,
                  r.total_engagement_seconds) for r in spark.read.parquet(f"{root}/out").collect())
    assert got == [("a", at(0), at(46), 4, 4.0), ("b", at(40), at(56), 2, 1.0)]


def test_histories_of_one_bucket_end_apart(spark, tmp_path):
    """Contents that share a bucket have their own bounds and ends."""
    root = str(tmp_path)

    def build(s):
        return pr.recent_history(s, keep=3, emit=2, ttl_minutes=60, buckets=1)

    _send(spark, root, [(10 * c + i, f"c{c}", c * 10 + i) for c in range(5) for i in range(4)])
    _send(spark, root, [(1000, "far", 85)])    # watermark 75: c0 (3 + 60) and c1 (13 + 60) are over
    _send(spark, root, [(2000 + c, f"c{c}", 86) for c in range(5)])
    q = _run(spark, root, build, "update")
    got = sorted((r.content_id, r.position, r.event_id)
                 for r in pr.read_history(spark, f"{root}/out").collect())
    want = [("far", 1, 1000)] + [(f"c{c}", 1, 2000 + c) for c in range(5)] + [
        (f"c{c}", 2, 10 * c + 3) for c in range(2, 5)]
    assert got == sorted(want)
    # 1 + 2 x 1 + 3 x 3 events, one timer and the lists' bookkeeping
    assert q.recentProgress[-1].stateOperators[0].numRowsTotal <= 16


def test_expiry_runs_without_calls_per_content(spark, tmp_path):
    root = str(tmp_path)
    _send(spark, root, [(1, "a", 0)])
    swept = pr.expiry_sweep(_enriched(spark, root, "10 minutes"))
    plan = swept._jdf.queryExecution().analyzed().toString()
    assert "session_window" in plan.lower() and "TransformWithState" not in plan


@pytest.mark.parametrize("check", ["late", "progress"])
def test_late_rows_and_progress(spark, check):
    from eventide.plans import stream_checks as sc
    sf = "/root/testdata/sf0.001"
    root = sc.late_run(spark, sf)
    metrics = spark.read.parquet(f"{root}/metrics")
    total = metrics.agg(*[F.sum(c).alias(c) for c in (
        "input_rows", "processed_rows", "rejected_rows", "late_rows", "duplicate_rows")]).first()
    sent = spark.read.parquet(f"{root}/source").count()
    log = progress.read_progress(spark, f"{root}/progress")
    if check == "late":
        assert total.late_rows > 0 and total.duplicate_rows > 0
        assert total.processed_rows + total.rejected_rows + total.duplicate_rows == sent
        rejects = read_rejects(spark, f"{root}/quarantine")
        late = rejects.where(F.array_contains("reasons", "late"))
        assert late.count() == total.late_rows and rejects.count() == total.rejected_rows
        # the whole row is kept, and nothing else is called late
        assert late.where(f"event_ts >= '{sc.P.LATE_BEFORE}' OR id % 17 <> 0").count() == 0
        assert late.where("content_id IS NULL OR raw_payload IS NULL").count() == 0
        assert {tuple(r.reasons) for r in late.collect()} == {("late",)}
    else:
        rows = log.collect()
        assert sum(int(r.observed.get("ingest.rows", 0)) for r in rows) == sent
        assert sum(r.late_rows_dropped for r in rows) == total.late_rows
        assert all(r.latency_ms > 0 for r in rows if r.input_rows)
        slow = progress.latency_alerts(log, latency_ms=10 ** 9, late_rows=10 ** 9)
        assert slow.count() == 0


def test_progress_rows_of_other_queries_are_left_out(spark, tmp_path):
    log = progress.ProgressLog(spark, str(tmp_path / "p"), names=("wanted",))
    _send(spark, str(tmp_path), [(1, "a", 0)])
    spark.streams.addListener(log)
    try:
        for name in ("wanted", "other"):
            src = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "src"))
            q = (src.writeStream.format("noop").queryName(name)
                 .option("checkpointLocation", str(tmp_path / name))
                 .trigger(availableNow=True).start())
            q.awaitTermination(60)
            assert log.wait(q)
    finally:
        spark.streams.removeListener(log)
    assert {r.name for r in progress.read_progress(spark, str(tmp_path / "p")).collect()} == {
        "wanted"}
