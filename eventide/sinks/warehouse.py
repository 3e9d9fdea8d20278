"""Warehouse fact table (K1-K4): date-partitioned parquet, idempotent per source and batch.

Layout: ``<path>/event_date=YYYY-MM-DD/source=S/batch_id=N/part-*.parquet``, rows sorted within
files by (content_type, event_type, content_id) like the source's clustering, so parquet
row-group statistics skip data for those keys.

Idempotence: batch numbers belong to a source (a streaming query with its checkpoint, or a
backfill), so two sources, or a stream started again with a fresh checkpoint, never touch each
other's rows. A batch only ever writes its own ``source=S/batch_id=N`` partitions, with dynamic
partition overwrite, and notes their dates under ``<path>/_dates/S/N`` before it writes.
Replaying batch N of S (after a failure, or a backfill run again with the same id) replaces its
partitions and removes those of dates that it no longer has. Readers filter on ``event_date``
for partition pruning; ``read_fact(..., dedup=True)`` additionally keeps one row per
``event_id`` should the same event have arrived more than once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.operators.projections import to_fact
from eventide.schemas import FACT
from eventide.sinks import fs

CLUSTER_BY = ("content_type", "event_type", "content_id")


def write_fact(enriched: DataFrame, path: str, batch_id: int,
               records_per_file: int = 1_000_000, source: str = "stream",
               days: list | None = None, bloom: tuple[str, ...] = ()) -> None:
    """Append (idempotently) one batch of enriched events to the fact table.

    ``days`` are the calendar days of the batch, if the caller knows them (saves a job).
    ``bloom`` names columns that get Parquet bloom filters (see ``lookup``), sized by the values of
    each row group.
    """
    own, key = int(batch_id), fs.source_key(source)
    fact = (to_fact(enriched)
            .withColumn("source", F.lit(key))
            .withColumn("batch_id", F.lit(own).cast("long"))
            .withColumn("processed_timestamp", F.current_timestamp()))
    spark = enriched.sparkSession
    notes = f"{path}/_dates/{key}/{own}"
    before = set(fs.list_names(spark, notes))
    if days is None:  # calendar days of the batch: a handful of values
        days = [r["event_date"] for r in fact.select("event_date").distinct().collect()]
    now = {str(d) for d in days}
    for day in now - before:
        fs.touch(spark, f"{notes}/{day}")
    # REBALANCE on the partition column: few files per date, while AQE splits a hot date
    # over several tasks instead of sending a whole day to one writer
    (fact.hint("rebalance", "event_date")
     .sortWithinPartitions("event_date", *CLUSTER_BY)
     .write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", records_per_file)
     .options(**bloom_options(bloom))
     .partitionBy("event_date", "source", "batch_id")
     .parquet(path))
    for day in before - now:
        fs.delete(spark, f"{path}/event_date={day}/source={key}/batch_id={own}")
        fs.delete(spark, f"{notes}/{day}")


def bloom_options(columns: tuple[str, ...], max_bytes: int = 2 << 20) -> dict[str, str]:
    """Parquet writer options: an adaptive bloom filter of at most ``max_bytes`` for each column."""
    if not columns:
        return {}
    each = {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}
    return each | {"parquet.bloom.filter.adaptive.enabled": "true",
                   "parquet.bloom.filter.max.bytes": str(int(max_bytes))}


def lookup(spark: SparkSession, path: str, column: str, values: list, dates: tuple | None = None
           ) -> DataFrame:
    """S3: facts whose ``column`` is one of ``values``; ``dates`` (first, last) prunes partitions.

    Event ids are spread over all files, so minima and maxima exclude none; a bloom filter on
    the column lets a reader skip every row group that does not hold the value (up to about one
    in a hundred). The values are a predicate of the scan, so they should be few: join for many.
    """
    fact = read_fact(spark, path)
    if dates is not None:
        fact = fact.where(F.col("event_date").between(*[F.lit(str(d)).cast("date")
                                                        for d in dates]))
    return fact.where(F.col(column).isin(list(values)))


def read_fact(spark: SparkSession, path: str, dedup: bool = False) -> DataFrame:
    """The fact table; ``dedup`` keeps the latest write per ``event_id``."""
    fact = spark.read.schema(FACT).option("basePath", path).parquet(path)
    if not dedup:
        return fact
    w = Window.partitionBy("event_id").orderBy(F.desc("processed_timestamp"), F.desc("source"),
                                               F.desc("batch_id"))
    return fact.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def write_bucketed(fact: DataFrame, table: str, path: str, buckets: int = 64) -> DataFrame:
    """K3: a copy of the fact table dealt over ``buckets`` by content id and sorted in each, as a
    catalog table over ``path``; returns it.

    One shuffle when it is written (a task writes one bucket, so a bucket is one file); what
    groups or joins by content id afterwards needs none on this side. A bucket is read by one
    task: for contents with a large share of all events use the date-partitioned table, whose
    aggregations combine before they shuffle.
    """
    (fact.repartition(int(buckets), "content_id").write.format("parquet").mode("overwrite")
     .bucketBy(int(buckets), "content_id").sortBy("content_id", "event_timestamp")
     .option("path", path).saveAsTable(table))
    return fact.sparkSession.table(table)


def register_views(spark: SparkSession, path: str, as_of) -> None:
    """K4: the two analytic views as temp views over the fact table."""
    from eventide.operators import marts

    fact = read_fact(spark, path)
    marts.daily_summary(fact).createOrReplaceTempView("daily_engagement_summary")
    marts.hourly_trends(fact, as_of).createOrReplaceTempView("hourly_engagement_trends")
