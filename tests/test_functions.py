"""Golden rows (FIXTURES.md F5) and property tests of the engagement expressions."""

import datetime as dt
from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from eventide.functions import engagement as fx
from eventide.schemas import EVENT

CID = "11111111-1111-4111-8111-000000000001"  # video, 2400 s
USER = "22222222-2222-4222-8222-000000000001"


def _event(i, etype, dur, cid=CID, ts="2024-01-01 10:00:00"):
    return (i, cid, USER, etype, dt.datetime.fromisoformat(ts), dur, "ios", '{"session_id": "s1"}')


def _enrich(spark, content, rows):
    from eventide.operators.enrich import enrich, with_score
    ev = spark.createDataFrame(rows, EVENT)
    good, bad = enrich(ev, content)
    return with_score(good), bad


def test_worked_example(spark):
    content = spark.createDataFrame(
        [("11111111-1111-4111-8111-0000000000aa", "v", "V", "video", 1800)],
        "content_id string, slug string, title string, content_type string, length_seconds int")
    good, _ = _enrich(spark, content, [_event(1, "pause", 900000, "11111111-1111-4111-8111-0000000000aa")])
    r = good.first()
    assert r.engagement_seconds == Decimal("900.00")
    assert r.engagement_pct == Decimal("50.00")
    assert r.score == Decimal("0.75000")


def test_rounding_ties(spark):
    df = spark.createDataFrame([(1005,), (1015,), (1025,)], "duration_ms int")
    got = df.select(fx.engagement_seconds("duration_ms").alias("s"),
                    fx.engagement_seconds("duration_ms", fx.ROUNDING_VIEW).alias("v")).collect()
    assert [r.s for r in got] == [Decimal("1.00"), Decimal("1.02"), Decimal("1.02")]
    assert [r.v for r in got] == [Decimal("1.01"), Decimal("1.02"), Decimal("1.03")]


def test_golden_cases(spark, content_seed):
    newsletter = "11111111-1111-4111-8111-000000000002"
    rows = [_event(1, "click", None, newsletter),
            _event(2, "finish", 50000, "11111111-1111-4111-8111-000000000009"),
            _event(3, "play", 0)]
    extra = spark.createDataFrame(
        [("11111111-1111-4111-8111-000000000009", "short", "Short", "video", 10, None),
         ("11111111-1111-4111-8111-000000000010", "zero", "Zero", "video", 0, None)],
        content_seed.schema)
    content = content_seed.unionByName(extra)
    rows.append(_event(4, "play", 5000, "11111111-1111-4111-8111-000000000010"))
    good, bad = _enrich(spark, content, rows)
    got = {r.id: r for r in good.collect()}
    assert bad.count() == 0
    assert got[1].engagement_seconds is None and got[1].engagement_pct is None
    assert got[1].score == Decimal("0.30000")
    assert got[2].engagement_pct == Decimal("500.00") and got[2].score == Decimal("6.00000")
    assert got[3].engagement_seconds == Decimal("0.00") and got[3].engagement_pct == Decimal("0.00")
    assert got[3].score == Decimal("1.00000")
    assert got[4].engagement_pct is None and got[4].score == Decimal("1.00000")
    # zero becomes NULL in the warehouse record
    from eventide.operators.projections import to_warehouse_record
    w = {r.event_id: r for r in to_warehouse_record(good).collect()}
    assert w[3].engagement_seconds is None and w[3].engagement_pct is None


def test_quarantine_reasons(spark, content_seed):
    rows = [_event(1, "seek", 1000), _event(2, "play", None),
            _event(3, "play", 1000, "11111111-1111-4111-8111-00000000ffff"),
            _event(4, "play", 1000, "not-a-uuid"), _event(5, "play", 1000)]
    good, bad = _enrich(spark, content_seed, rows)
    reasons = {r.id: list(r.reasons) for r in bad.collect()}
    assert reasons[1] == ["invalid_event_type"]
    assert reasons[2] == ["missing_duration"]
    assert reasons[3] == ["content_not_found"]
    assert reasons[4] == ["invalid_content_id", "content_not_found"]
    assert [r.id for r in good.collect()] == [5]


def test_raw_json_parsing(spark):
    from eventide.operators.validate import validate_raw
    docs = [
        '{"id": "12", "content_id": "%s", "user_id": "%s", "event_type": "play", '
        '"event_ts": "2024-01-01T10:00:00", "duration_ms": 1000}' % (CID, USER),
        '{"id": 12.5, "content_id": "%s", "user_id": "%s", "event_type": "play", '
        '"event_ts": "2024-01-01T10:00:00", "duration_ms": 1000}' % (CID, USER),
        '{"id": 13, "content_id": "%s", "user_id": "%s", "event_type": "play", '
        '"event_ts": "yesterday", "duration_ms": "x"}' % (CID, USER),
    ]
    raw = spark.createDataFrame([(d,) for d in docs], "value string")
    good, bad = validate_raw(raw)
    g = good.collect()
    assert [r.id for r in g] == [12]
    reasons = [set(r.reasons) for r in bad.collect()]
    assert {"invalid_id", "missing_id"} in reasons
    assert {"invalid_event_ts", "invalid_duration_ms", "missing_duration"} in reasons


def test_iso_timestamp(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 7, 179575),),
                                (dt.datetime(2024, 1, 1, 0, 0, 7),)], "t timestamp_ntz")
    got = [r.s for r in df.select(fx.iso_timestamp("t").alias("s")).collect()]
    assert got == ["2024-01-01T00:00:07.179575", "2024-01-01T00:00:07"]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10_000_000), st.integers(1, 20_000)), min_size=1,
                max_size=30))
def test_property_rounding_matches_decimal(spark, pairs):
    df = spark.createDataFrame(pairs, "duration_ms int, length_seconds int")
    out = df.select(
        "duration_ms", "length_seconds",
        fx.engagement_seconds("duration_ms").alias("engagement_seconds"),
    ).withColumn("pct", fx.engagement_pct()).withColumn(
        "vpct", fx.engagement_pct(rounding=fx.ROUNDING_VIEW)).withColumn(
        "ves", fx.engagement_seconds("duration_ms", fx.ROUNDING_VIEW)).collect()
    q = Decimal("0.01")
    for r in out:
        es = (Decimal(r.duration_ms) / 1000).quantize(q, ROUND_HALF_EVEN)
        assert r.engagement_seconds == es
        assert r.pct == ((es / Decimal(r.length_seconds)) * 100).quantize(q, ROUND_HALF_EVEN)
        assert r.ves == (Decimal(r.duration_ms) / 1000).quantize(q, ROUND_HALF_UP)
        exact = Decimal(r.duration_ms) / Decimal(10 * r.length_seconds)
        assert r.vpct == exact.quantize(q, ROUND_HALF_UP)


def test_score_least_skips_null(spark):
    df = spark.createDataFrame([("play", None), ("play", Decimal("250.00")), ("pause", Decimal("40.00"))],
                               "event_type string, engagement_pct decimal(18,2)")
    got = [r.s for r in df.select(fx.content_score().alias("s")).collect()]
    assert got == [Decimal("1.00000"), Decimal("2.00000"), Decimal("0.70000")]


def test_payload_fields(spark):
    df = spark.createDataFrame([('{"session_id": "a", "referrer": null}',)], "raw_payload string")
    r = df.select(*fx.payload_fields()).first()
    assert r.session_id == "a" and r.referrer is None and r.ip_address is None


def test_payload_variant(spark):
    df = spark.createDataFrame([('{"k": 69, "session_id": "s"}',), ("{broken",)], "raw_payload string")
    got = df.select(fx.payload_variant_field("k", "int").alias("k"),
                    fx.payload_variant_field("session_id").alias("s")).collect()
    assert [(r.k, r.s) for r in got] == [(69, "s"), (None, None)]
