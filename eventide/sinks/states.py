"""Mergeable partial states of a batch, from which marts and rankings are served (A4-A6, T1, ST9).

A batch of facts leaves two small tables under ``<path>/marts`` and ``<path>/top``:

* marts: one row per (event_date, hour_bucket, content_type, event_type) with exact counts and
  decimal sums, and theta sketches of users and content. The daily and the hourly mart are
  unions of these rows, so a new batch costs its own facts only, never a rescan of old ones.
* top: per (event_date, bucket) a frequent-items sketch of content ids. Ids are dealt over the
  buckets by hash, so a bucket's sketches hold its ids alone, and the ranking of all ids is the
  ranking of the buckets' first ones.

Counts, sums and averages are exact. Distinct numbers are exact up to ``2^LG_ENTRIES`` values
in a group and beyond that within ``3 / sqrt(2^LG_ENTRIES)`` (2.3 %) at three standard errors.
Counts of a ranking are exact while a bucket has at most ``track`` ids; beyond that a count is
off by at most ``3.5 * events of the bucket / (4/3 * track)``, an absolute error that heavy items
do not feel.

A batch writes its own ``source=S/batch_id=N`` folder, whole, so a replay replaces it and neither
other sources nor other batches are touched. Events must be unique among batches, as facts
are after de-duplication: sketches do not notice a repeated event in the counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.time import since, ts_lit
from eventide.sinks import fs

#: log2 of the entries of a theta sketch: at most 128 KB a sketch, 8 bytes a value below that.
LG_ENTRIES = 14
#: Buckets of content ids, and ids that a bucket's sketch tracks.
BUCKETS, TRACK = 16, 10_000

GRAIN = ("event_date", "hour_bucket", "content_type", "event_type")


def mart_states(fact: DataFrame) -> DataFrame:
    """The marts' partial rows of some facts."""
    hour = F.date_trunc("HOUR", "event_timestamp").cast("timestamp_ntz")
    return (fact.withColumn("hour_bucket", hour).groupBy(*GRAIN)
            .agg(F.count(F.lit(1)).alias("events"),
                 F.sum("engagement_seconds").alias("seconds"),
                 F.count("engagement_seconds").alias("n_seconds"),
                 F.sum("engagement_pct").alias("pct"), F.count("engagement_pct").alias("n_pct"),
                 F.theta_sketch_agg("user_id", LG_ENTRIES).alias("users"),
                 F.theta_sketch_agg("content_id", LG_ENTRIES).alias("content")))


def top_states(fact: DataFrame, buckets: int = BUCKETS, track: int = TRACK) -> DataFrame:
    """(event_date, bucket, top): sketches of the events per content id."""
    bucket = F.pmod(F.xxhash64("content_id"), F.lit(int(buckets))).cast("int")
    return (fact.where(F.col("content_id").isNotNull())
            .groupBy("event_date", bucket.alias("bucket"))
            .agg(F.expr(f"approx_top_k_accumulate(content_id, {int(track)})").alias("top")))


def write_states(fact: DataFrame, path: str, batch_id: int, source: str = "stream",
                 buckets: int = BUCKETS, track: int = TRACK) -> None:
    """Write both state tables of a batch; a replay replaces them. ``buckets`` and ``track`` must
    be the same for all batches of a path."""
    for name, states in (("marts", mart_states(fact)), ("top", top_states(fact, buckets, track))):
        states.write.mode("overwrite").parquet(
            fs.batch_folder(f"{path}/{name}", source, batch_id))


def read_states(spark: SparkSession, path: str, name: str) -> DataFrame:
    """All batches' states: ``marts`` or ``top``."""
    return spark.read.option("basePath", f"{path}/{name}").parquet(f"{path}/{name}")


def _distinct(sketch: str) -> Column:
    return F.theta_sketch_estimate(F.theta_union_agg(sketch, LG_ENTRIES))


def _avg(total: str, n: str) -> Column:
    return F.try_divide(F.sum(total).cast("double"), F.sum(n))


def daily_from_states(marts: DataFrame) -> DataFrame:
    """A5 from states: the columns of ``marts.daily_summary``."""
    finished = F.when(F.col("event_type") == "finish", F.col("events")).otherwise(0)
    return (marts.groupBy("event_date", "content_type")
            .agg(F.sum("events").alias("total_events"),
                 _distinct("users").alias("unique_users"),
                 _distinct("content").alias("unique_content"),
                 _avg("seconds", "n_seconds").alias("avg_engagement_seconds"),
                 _avg("pct", "n_pct").alias("avg_engagement_pct"),
                 F.sum(finished).cast("bigint").alias("total_completions")))


def hourly_from_states(marts: DataFrame, as_of, days: int = 7) -> DataFrame:
    """A6 from states: the columns of ``marts.hourly_trends``, from the first whole hour of the
    look-back on (states do not split an hour)."""
    start = ts_lit(as_of) - F.expr(f"INTERVAL {int(days)} DAY")
    return (marts.where(since("hour_bucket", as_of, days, "DAY")
                        & (F.col("event_date") >= F.to_date(start)))
            .groupBy("hour_bucket", "content_type", "event_type")
            .agg(F.sum("events").alias("event_count"), _distinct("users").alias("unique_users"),
                 _avg("seconds", "n_seconds").alias("avg_engagement_seconds")))


def top_from_states(top: DataFrame, k: int, start_date=None, end_date=None, track: int = TRACK,
                    whole_ties: bool = False) -> DataFrame:
    """T1/A4 from states: (content_id, total_events), the ``k`` contents with most events between
    two dates (closed; None: no bound).

    Each bucket's sketches are united and give their first ``k + 1`` ids; what is ordered in the
    end are ``buckets * (k + 1)`` rows. Ties at the end are cut by content id among the ids that the
    sketches give; with ``whole_ties`` ids that tie with the first one beyond ``k`` are left out
    instead, so the result does not depend on how a sketch orders equal counts.
    """
    if start_date is not None:
        top = top.where(F.col("event_date") >= F.lit(str(start_date)).cast("date"))
    if end_date is not None:
        top = top.where(F.col("event_date") <= F.lit(str(end_date)).cast("date"))
    best = F.expr("approx_top_k_estimate(approx_top_k_combine(top, "
                  f"{int(track)}), {int(k) + 1})")
    ranked = (top.groupBy("bucket").agg(best.alias("best"))
              .select(F.inline("best").alias("content_id", "total_events")))
    first = ranked.orderBy(F.desc("total_events"), F.desc("content_id")).limit(int(k) + 1)
    if not whole_ties:
        return first.orderBy(F.desc("total_events"), F.desc("content_id")).limit(int(k))
    n = F.transform("best", lambda c: c["total_events"])
    border = F.when(F.size("best") > int(k), F.array_min(n)).otherwise(0)
    return (first.agg(F.collect_list(F.struct("content_id", "total_events")).alias("best"))
            .withColumn("border", border)  # one row of at most k + 1 contents
            .select(F.inline(F.filter("best", lambda c: c["total_events"] > F.col("border")))))
