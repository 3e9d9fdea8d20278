"""Batches of several sources side by side; metrics over the whole life of a pipeline."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventide.operators.enrich import enrich
from eventide.sinks import fs
from eventide.sinks.quarantine import read_rejects
from eventide.sinks.warehouse import read_fact
from eventide.sources import fixtures as fx
from eventide.streaming.backfill import backfill
from eventide.streaming.pipeline import Sinks, process_batch, processing_metrics

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def data(spark):
    return fx.load_content(spark, SF), fx.load_events(spark, SF)


def _ids(df, col="event_id"):
    return sorted(r[0] for r in df.select(col).collect())


def test_equal_batch_numbers_of_two_sources(spark, data, tmp_path):
    content, events = data
    root = str(tmp_path)
    sinks = Sinks(warehouse=f"{root}/fact", quarantine=f"{root}/q", metrics=f"{root}/m")
    old, new = events.where("id % 2 = 0"), events.where("id % 2 = 1")
    good, bad = enrich(events, content)
    for _ in range(2):  # the second time: a replay of each, which changes nothing
        process_batch(old, 0, content, sinks, source="a")
        process_batch(new, 0, content, sinks, source="b/with other name")
        fact, rejects = read_fact(spark, sinks.warehouse), read_rejects(spark, sinks.quarantine)
        assert _ids(fact) == _ids(good, "id")
        assert rejects.count() == bad.count()
        assert {r[0] for r in fact.select("source").distinct().collect()} == {
            "a", fs.source_key("b/with other name")}
        assert processing_metrics(spark, sinks.metrics).first().processed == good.count()
    # the same events from a third source are more rows; one of each is left by dedup
    process_batch(old, 0, content, sinks, source="c")
    assert read_fact(spark, sinks.warehouse).count() > good.count()
    assert _ids(read_fact(spark, sinks.warehouse, dedup=True)) == _ids(good, "id")
    # a replay with fewer rows takes back only its own
    process_batch(old.where("id % 4 = 0"), 0, content, sinks, source="c")
    process_batch(old.limit(0), 0, content, sinks, source="a")
    left = enrich(new.unionByName(old.where("id % 4 = 0")), content)[0]
    assert _ids(read_fact(spark, sinks.warehouse)) == _ids(left, "id")


def test_source_names(spark):
    assert fs.source_key("a-1.b_2") == "a-1.b_2"
    assert fs.source_key("a/b") != fs.source_key("a:b") and "/" not in fs.source_key("a/b")
    assert fs.source_key("") != ""


def test_metrics_cover_every_batch_and_average_the_newest(spark, data, tmp_path):
    content, events = data
    path = str(tmp_path / "m")
    start = dt.datetime(2024, 1, 1)
    rows = [("stream", i, 9, 2, 7, 5.0 if i < 500 else 1.0, start + dt.timedelta(seconds=i))
            for i in range(1500)]
    (spark.createDataFrame(rows, "source string, batch_id long, input_rows long, "
                           "rejected_rows long, processed_rows long, duration_sec double, "
                           "finished_at timestamp").repartition(1)
     .write.partitionBy("source", "batch_id").parquet(path))
    m = processing_metrics(spark, path).first()
    assert (m.processed, m.errors, m.avg_batch_seconds) == (10_500, 3_000, 1.0)
    assert m.error_rate == 3_000 / 13_500
    # a backfill ends last, whatever its (negative) number: it is counted and among the newest
    sinks = Sinks(metrics=path)
    backfill(events, content, "2024-01-01", "2024-01-08", sinks, batch_id=3)
    good, bad = enrich(events.where("event_ts < '2024-01-08'"), content)
    m = processing_metrics(spark, path, last=1).first()
    assert (m.processed, m.errors) == (10_500 + good.count(), 3_000 + bad.count())
    assert m.avg_batch_seconds not in (1.0, 5.0)
