"""The fact table bucketed by content: same rows, no exchange of events."""

from pyspark.sql import functions as F

from eventide.operators.enrich import enrich
from eventide.operators.projections import to_fact
from eventide.sinks.warehouse import write_bucketed
from eventide.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_fact_needs_no_exchange(spark, tmp_path):
    content, events = fx.load_content(spark, SF), fx.load_events(spark, SF)
    fact = to_fact(enrich(events, content)[0])
    table = write_bucketed(fact, "fact_by_content", str(tmp_path / "fact"), 4)
    try:
        assert sorted(map(str, table.collect())) == sorted(
            map(str, fact.select(*table.columns).collect()))
        stats = table.groupBy("content_id").agg(F.count(F.lit(1)).alias("n"),
                                                F.sum("engagement_seconds").alias("s"))
        assert "Exchange" not in _plan(stats) and "Exchange" in _plan(
            fact.groupBy("content_id").count())
        # a grouping that contains the key, and the shuffle form of the join with the catalogue
        assert "Exchange" not in _plan(table.groupBy("content_id", "content_slug").count())
        joined = table.hint("merge").join(content.select("content_id", "slug"), "content_id")
        assert _plan(joined).count("Exchange hashpartitioning") == 1
        assert joined.count() == fact.count()
        # a replay replaces the table
        again = write_bucketed(fact, "fact_by_content", str(tmp_path / "fact"), 4)
        assert again.count() == fact.count()
    finally:
        spark.sql("DROP TABLE fact_by_content")
