"""Mergeable states, seen ids and bloom look-ups against the plain operators."""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from eventide.operators import marts
from eventide.operators.enrich import enrich
from eventide.operators.projections import to_fact
from eventide.sinks import seen_ids, states, warehouse
from eventide.sources import fixtures as fx

SF = "/root/testdata/sf0.001"
AS_OF = "2024-01-31 00:00:00"


def _fact(spark):
    return to_fact(enrich(fx.load_events(spark, SF), fx.load_content(spark, SF))[0])


def _rows(df):
    return sorted(str(sorted(r.asDict().items())) for r in df.collect())


def test_marts_from_states_of_two_sources_and_a_replay(spark, tmp_path):
    fact, path = _fact(spark).cache(), str(tmp_path / "states")
    part = F.pmod(F.xxhash64("event_id"), F.lit(3))
    for source, batch, n in (("a", 0, 0), ("b", 0, 1), ("b", 1, 2), ("b", 0, 1)):
        states.write_states(fact.where(part == n), path, batch, source)
    daily = states.daily_from_states(states.read_states(spark, path, "marts"))
    assert _rows(daily) == _rows(marts.daily_summary(fact))
    hourly = states.hourly_from_states(states.read_states(spark, path, "marts"), AS_OF)
    assert _rows(hourly) == _rows(marts.hourly_trends(fact, AS_OF))
    # a replayed batch that has become empty takes its rows along
    states.write_states(fact.where("false"), path, 1, "b")
    left = states.daily_from_states(states.read_states(spark, path, "marts"))
    assert _rows(left) == _rows(marts.daily_summary(fact.where(part < 2)))
    top = states.top_from_states(states.read_states(spark, path, "top"), 5, whole_ties=True)
    counts = sorted((r["count"] for r in fact.where((part < 2) & F.col("content_id").isNotNull())
                     .groupBy("content_id").count().collect()), reverse=True)
    assert sorted((r.total_events for r in top.collect()), reverse=True) == [
        c for c in counts if c > counts[5]]
    fact.unpersist()


def test_distinct_numbers_stay_within_the_stated_error(spark):
    n = 200_000
    fact = spark.range(n).select(
        F.lit(dt.date(2024, 1, 1)).alias("event_date"),
        F.lit(dt.datetime(2024, 1, 1)).alias("event_timestamp"),
        F.lit("video").alias("content_type"), F.lit("play").alias("event_type"),
        F.lit(1).cast("decimal(18,2)").alias("engagement_seconds"),
        F.lit(None).cast("decimal(18,2)").alias("engagement_pct"),
        F.col("id").cast("string").alias("user_id"),
        F.when(F.col("id") > 9, F.lit("x")).alias("content_id"))
    row = states.daily_from_states(states.mart_states(fact)).first()
    assert (row.total_events, row.unique_content, row.avg_engagement_pct) == (n, 1, None)
    assert abs(row.unique_users - n) <= n * 3 / 2 ** (states.LG_ENTRIES / 2)


def test_ranking_recall_with_more_ids_than_a_sketch_tracks(spark):
    # 60,000 ids, id i about 40,000 / i times: far more than the 4 x 500 that are tracked
    ids = spark.range(1, 60_001).withColumn("n", F.greatest(
        F.floor(F.lit(40_000) / F.col("id")), F.lit(1)).cast("int"))
    fact = ids.select(F.col("id").cast("string").alias("content_id"),
                      F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i")).select(
        "content_id", F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("i") % 3).alias("event_date"))
    top = states.top_states(fact, buckets=4, track=500)
    got = {r.content_id: r.total_events for r in
           states.top_from_states(top, 20, track=500).collect()}
    assert len(got) == 20
    assert sum(str(i) in got for i in range(1, 21)) >= 19  # recall of at least 0.95
    events = fact.groupBy(F.pmod(F.xxhash64("content_id"), F.lit(4))).count().agg(
        F.max("count")).first()[0]
    bound = 3.5 * events / (4 / 3 * 500)
    assert all(abs(n - 40_000 // int(i)) <= bound for i, n in got.items())
    one_day = states.top_from_states(top, 3, "2024-01-02", "2024-01-02", track=500).collect()
    assert [r.content_id for r in one_day] == ["1", "2", "3"]
    assert abs(one_day[0].total_events - 40_000 / 3) <= bound


def test_states_of_nothing(spark):
    fact = _fact(spark).where("false")
    assert states.daily_from_states(states.mart_states(fact)).count() == 0
    assert states.top_from_states(states.top_states(fact), 5, whole_ties=True).count() == 0


def test_seen_ids_across_batches_sources_and_replays(spark, tmp_path):
    path = str(tmp_path / "ids")
    day = dt.datetime(2024, 1, 1)

    def batch(*ids):
        return spark.createDataFrame([(i, day if (i or 0) % 2 else None) for i in ids],
                                     "id bigint, event_ts timestamp_ntz")

    def again(rows, number, source="s"):
        tagged = seen_ids.tag_seen(rows, seen_ids.seen_before(spark, path, number, source))
        return sorted(r.id for r in tagged.where("seen").collect())

    edge = [0, 1, 32767, 32768, 32769, -1, -32768, -32769, 2 ** 62, -(2 ** 62)]
    first = batch(*edge, None, 5)
    assert again(first, 0) == []
    seen_ids.note_ids(first, path, 0, "s")
    # neighbours of what was seen are new; a null id is never a repeat
    second = batch(*edge, None, 2, 32766, 32770, -2, 2 ** 62 + 1)
    assert again(second, 1) == sorted(edge)
    seen_ids.note_ids(second, path, 1, "s")
    # a replay of the first batch is judged as before, another source sees all
    assert again(first, 0) == [] and again(second, 1) == sorted(edge)
    assert again(batch(2, 3), 0, "other") == [2]
    # days before the horizon are left out: only ids without a day stay
    kept = seen_ids.seen_before(spark, path, 2, "s", since_day="2024-02-01")
    odd = seen_ids.tag_seen(batch(1, 2, 5), kept).where("seen").collect()
    assert [r.id for r in odd] == [2]


def _scanned_rows(df):
    """Rows that the scan of a collected frame read."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    leaves = plan.collectLeaves()
    return leaves.apply(0).metrics().apply("numOutputRows").value()


def test_lookup_skips_row_groups_by_bloom_filter(spark, tmp_path):
    # ids without order in time: files are not told apart by minima and maxima
    enriched = enrich(fx.load_events(spark, SF), fx.load_content(spark, SF))[0].withColumn(
        "id", F.pmod(F.xxhash64("id"), F.lit(10 ** 12))).cache()
    n = enriched.count()
    with_filter, without = (f"{tmp_path}/{uuid.uuid4().hex}" for _ in range(2))
    # as in large files, whose many ids do not fit a dictionary
    spark.conf.set("parquet.enable.dictionary", "false")
    try:
        warehouse.write_fact(enriched, with_filter, 0, bloom=("event_id",))
        warehouse.write_fact(enriched, without, 0)
    finally:
        spark.conf.unset("parquet.enable.dictionary")
    ids = [r.id for r in enriched.orderBy("id").select("id").collect()]
    mid = ids[len(ids) // 2]
    found = warehouse.lookup(spark, with_filter, "event_id", [mid])
    assert [r.event_id for r in found.collect()] == [mid]
    read, plain = _scanned_rows(found), _scanned_rows(
        warehouse.lookup(spark, without, "event_id", [mid]))
    assert 0 < read < n / 5 and plain > n / 2
    assert warehouse.lookup(spark, with_filter, "event_id", [max(ids) + 1]).count() == 0
    day = enriched.where(F.col("id") == mid).first().event_ts.date()
    assert warehouse.lookup(spark, with_filter, "event_id", [mid], (day, day)).count() == 1
    other = day + dt.timedelta(days=1)
    assert warehouse.lookup(spark, with_filter, "event_id", [mid], (other, other)).count() == 0
    assert warehouse.lookup(spark, with_filter, "event_id", ids[:50]).count() == 50
    enriched.unpersist()


def test_registered_states_derive_facts_once(spark):
    from eventide.plans import catalog
    sf = "/root/testdata/sf0.001"
    path = catalog._states(spark, sf)
    facts = spark.read.parquet(f"{path}/facts")
    assert facts.count() == catalog._fact(spark, sf).count()
    files = facts.select(F.input_file_name().alias("f")).distinct().count()
    assert files == spark.sparkContext.defaultParallelism  # though one row group holds the events
