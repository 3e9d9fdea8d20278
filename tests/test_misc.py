"""Views, content validation, change feed, paging, metrics, raw-JSON stream, batched delivery."""

import json

from pyspark.sql import functions as F

from eventide.operators import marts
from eventide.operators.enrich import enrich
from eventide.operators.projections import to_change_row
from eventide.operators.validate import validate_content
from eventide.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def test_content_validation(spark, content_seed):
    bad_rows = spark.createDataFrame(
        [("x", "s", "t", "video", 1, None),
         ("11111111-1111-4111-8111-0000000000ab", "s2", "t2", "movie", 1, None)],
        content_seed.schema)
    good, bad = validate_content(content_seed.unionByName(bad_rows))
    assert good.count() == content_seed.count()
    assert sorted(tuple(r.reasons) for r in bad.collect()) == [
        ("invalid_content_id",), ("invalid_content_type",)]


def test_views_over_fact(spark, tmp_path):
    from eventide.sinks.warehouse import register_views, write_fact
    enriched, _ = enrich(fx.load_events(spark, SF), fx.load_content(spark, SF))
    path = str(tmp_path / "fact")
    write_fact(enriched, path, 0)
    register_views(spark, path, "2024-01-31 00:00:00")
    n = spark.sql("SELECT sum(total_events) FROM daily_engagement_summary").first()[0]
    assert n == enriched.count()
    assert spark.sql("SELECT count(*) FROM hourly_engagement_trends").first()[0] > 0


def test_change_row_json(spark):
    ev = fx.load_events(spark, SF).limit(3)
    rows = to_change_row(ev).collect()
    doc = json.loads(rows[0].value)
    assert rows[0].key == doc["content_id"]
    assert set(doc) >= {"id", "content_id", "user_id", "event_type", "event_ts"}


def test_paging_is_stable(spark):
    ev = fx.load_events(spark, SF)
    pages = [marts.page(ev.select("id"), ["id"], 100, i).collect() for i in range(3)]
    ids = [r.id for p in pages for r in p]
    assert ids == sorted(r.id for r in ev.select("id").orderBy("id").limit(300).collect())


def test_processing_metrics_and_raw_json_stream(spark, tmp_path):
    from eventide.streaming.pipeline import Sinks, processing_metrics, raw_json_events, run_stream
    ev = fx.load_events(spark, SF)
    src = str(tmp_path / "raw")
    ev.select(F.to_json(F.struct(*ev.columns)).alias("value")).coalesce(2).write.text(src)
    # one malformed document
    spark.createDataFrame([("{not json",)], "value string").write.mode("append").text(src)
    sinks = Sinks(quarantine=str(tmp_path / "q"), metrics=str(tmp_path / "m"))
    q = run_stream(spark, raw_json_events(spark, src), fx.load_content(spark, SF), sinks,
                   checkpoint=str(tmp_path / "ck"), trigger={"availableNow": True},
                   watermark="3650 days", dedup=False)
    q.awaitTermination()
    m = processing_metrics(spark, str(tmp_path / "m")).first()
    _, bad = enrich(ev, fx.load_content(spark, SF))
    assert m.processed + m.errors == ev.count() + 1
    assert m.errors == bad.count() + 1
    assert abs(m.error_rate - m.errors / (ev.count() + 1)) < 1e-12


def test_batched_delivery_falls_back(spark, tmp_path):
    from clients import FileClient

    from eventide.sinks.delivery import deliver, delivery_stats
    enriched, _ = enrich(fx.load_events(spark, SF), fx.load_content(spark, SF))
    small = enriched.limit(7)

    class Refusing(FileClient):
        def post(self, body, url=None):
            if url == "http://x/batch":
                return 404
            return super().post(body, url)

    res = deliver(small, lambda: Refusing(str(tmp_path / "s")), chunk=3,
                  batch_url="http://x/batch", min_wait=0, max_wait=0)
    st = delivery_stats(res).first()
    assert (st.sent_count, st.error_count) == (7, 0)


def test_progress_metrics(spark, tmp_path):
    from eventide.streaming.pipeline import Sinks, file_events, progress_metrics, run_stream
    ev = fx.load_events(spark, SF)
    src = str(tmp_path / "src")
    ev.coalesce(1).write.parquet(src)
    q = run_stream(spark, file_events(spark, src), fx.load_content(spark, SF), Sinks(),
                   checkpoint=str(tmp_path / "ck"), trigger={"availableNow": True})
    q.awaitTermination()
    first = [p for p in q.recentProgress if p.numInputRows > 0][0]
    assert first.observedMetrics["ingest"]["rows"] == ev.count()
    m = progress_metrics(q)
    assert {"latency_ms", "latency_alert", "backlog_alert"} <= set(m)


def test_warehouse_record_schema(spark):
    from eventide.operators.projections import to_warehouse_record
    from eventide.schemas import WAREHOUSE
    enriched, _ = enrich(fx.load_events(spark, SF), fx.load_content(spark, SF))
    rec = to_warehouse_record(enriched)
    assert [(f.name, f.dataType) for f in rec.schema.fields] == [
        (f.name, f.dataType) for f in WAREHOUSE.fields]


def test_backfill_ordered(spark):
    from eventide.streaming.backfill import backfill_frame
    ev, content = fx.load_events(spark, SF), fx.load_content(spark, SF)
    rows = backfill_frame(ev, content, "2024-01-10", "2024-01-12", ordered=True).collect()
    keys = [(r.event_ts, r.id) for r in rows]
    assert keys == sorted(keys) and all(
        dt_ >= __import__("datetime").datetime(2024, 1, 10) for dt_, _ in keys)


def test_marts_are_served_in_order(spark):
    from eventide.operators.projections import to_fact
    enriched, _ = enrich(fx.load_events(spark, SF), fx.load_content(spark, SF))
    fact = to_fact(enriched)
    days = [(r.event_date, r.content_type) for r in
            marts.ordered_daily(marts.daily_summary(fact)).collect()]
    assert days == sorted(sorted(days, key=lambda d: d[1]), key=lambda d: d[0], reverse=True)
    hours = marts.ordered_hourly(marts.hourly_trends(fact, "2024-01-31 00:00:00")).collect()
    starts = [r.hour_bucket for r in hours]
    assert starts == sorted(starts, reverse=True) and len(set(starts)) > 1


def test_raw_documents_are_kept_and_ids_canonical(spark, tmp_path):
    from eventide.operators.validate import validate_raw
    from eventide.streaming.pipeline import Sinks, raw_json_events, run_stream
    one = fx.load_events(spark, SF).where("event_type = 'click' AND id % 19 <> 0").first()
    doc = {"id": one.id, "content_id": one.content_id.upper(), "user_id":
           one.user_id.replace("-", "").upper(), "event_type": "click",
           "event_ts": one.event_ts.isoformat()}
    rows = [json.dumps(doc), "{not json", json.dumps(doc | {"raw_payload": 5}),
            json.dumps(doc | {"raw_payload": {"a": 1}})]
    raw = spark.createDataFrame([(r,) for r in rows], "value string")
    good, bad = validate_raw(raw)
    assert {(r.content_id, r.user_id) for r in good.collect()} == {(one.content_id, one.user_id)}
    assert good.count() == 2
    reasons = {r["_raw"]: list(r.reasons) for r in bad.collect()}
    assert reasons["{not json"][0] == "malformed_json"
    assert reasons[rows[2]] == ["invalid_raw_payload"]
    src = str(tmp_path / "raw")
    raw.coalesce(1).write.text(src)
    run_stream(spark, raw_json_events(spark, src), fx.load_content(spark, SF),
               Sinks(quarantine=str(tmp_path / "q")), checkpoint=str(tmp_path / "ck"),
               trigger={"availableNow": True}, watermark="3650 days").awaitTermination()
    kept = {r.raw_document for r in spark.read.parquet(str(tmp_path / "q")).collect()}
    assert kept == {"{not json", rows[2]}


def test_launch_settings_and_session_settings_win(spark):
    from eventide.session import apply_defaults
    s = spark.newSession()
    apply_defaults(s)
    assert s.conf.get("spark.sql.session.timeZone") == "UTC"
    s.conf.set("spark.sql.parquet.compression.codec", "snappy")
    apply_defaults(s)
    assert s.conf.get("spark.sql.parquet.compression.codec") == "snappy"


def test_no_loopback_without_a_local_master(monkeypatch):
    """On a cluster only the library's SQL defaults are filled in, and only unset ones."""
    import eventide.session as S
    seen = {}

    class Builder:
        def appName(self, _):
            return self

        def master(self, _):
            return self

        def config(self, k, v):
            seen[k] = v
            return self

        def getOrCreate(self):
            raise KeyboardInterrupt

    class Session:
        builder = Builder()

        @staticmethod
        def getActiveSession():
            return None

    monkeypatch.setattr(S, "SparkSession", Session)
    for master in (None, "spark://host:7077", "yarn"):
        seen.clear()
        try:
            S.get_session(master)
        except KeyboardInterrupt:
            pass
        assert not {"spark.driver.host", "spark.driver.bindAddress", "spark.driver.memory",
                    "spark.sql.shuffle.partitions", "spark.checkpoint.dir"} & set(seen)


def test_broadcast_bound_is_in_bytes(spark):
    from eventide.operators.joins import fits_broadcast
    dim = spark.range(100).select("id", F.lit("x" * 100).alias("title"))
    assert fits_broadcast(dim, max_rows=100, max_bytes=20_000)
    assert not fits_broadcast(dim, max_rows=100, max_bytes=5_000)
    assert not fits_broadcast(dim, max_rows=99, max_bytes=1 << 30)


def test_catalogue_refresh_is_the_same_at_any_size(spark, tmp_path, monkeypatch):
    """A callable catalogue is read again by every batch, above and below the bound."""
    from eventide.operators import joins
    from eventide.sources.fixtures import load_content
    from eventide.streaming.pipeline import Sinks, process_batch
    events = fx.load_events(spark, SF).where("id % 19 <> 0")
    content = load_content(spark, SF)
    for rows in (joins.DEFAULT_BROADCAST_ROWS, 0):
        monkeypatch.setattr(joins.fits_broadcast, "__defaults__", (rows, 1 << 26))
        path = str(tmp_path / f"content-{rows}")
        content.limit(0).write.parquet(path)
        read = lambda: spark.read.schema(content.schema).parquet(path)
        assert process_batch(events, 0, read, Sinks())["processed_rows"] == 0
        content.write.mode("overwrite").parquet(path)
        assert process_batch(events, 1, read, Sinks())["processed_rows"] > 0


def test_broadcasts_are_small(spark):
    """A stream sends its dimension through the driver with every batch."""
    from eventide.operators.joins import fits_broadcast
    assert fits_broadcast(spark.range(50_000))
    assert not fits_broadcast(spark.range(150_000))
    assert not fits_broadcast(spark.range(20_000).selectExpr("id", "repeat('x', 500) AS v"))
