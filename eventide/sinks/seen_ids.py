"""Uniqueness of event ids across batches (V8): bitmaps of the ids seen, per day.

Event ids are serial numbers, so 32,768 neighbouring ids are one row of 4 KB with a bit for each:
exact, no false positives, and one hundredth of the ids' own size when they are dense. A batch
writes the bitmaps of its ids under ``<path>/source=S/batch_id=N`` by event day (a null day for
events without time), so that old days can be left out or dropped.

A batch is compared with the batches before it of its own source and with all batches of other
sources; a replay therefore finds the same rows as the first run, whatever came later from
its own source. Repeats within a batch are ``operators.validate.duplicate_keys``'s matter. Rows
without id are never taken for repeats.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.operators.joins import maybe_broadcast
from eventide.sinks import fs

_SCHEMA = ("event_date date, id_bucket bigint, bits binary, source string, batch_id bigint")


def id_bitmaps(events: DataFrame, id_col: str = "id", ts_col: str = "event_ts") -> DataFrame:
    """(event_date, id_bucket, bits) of the ids; bitmaps are combined before they are shuffled."""
    return (events.where(F.col(id_col).isNotNull())
            .groupBy(F.to_date(ts_col).alias("event_date"),
                     F.bitmap_bucket_number(id_col).alias("id_bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(id_col)).alias("bits")))


def note_ids(events: DataFrame, path: str, batch_id: int, source: str = "stream",
             id_col: str = "id", ts_col: str = "event_ts") -> None:
    """Write the bitmaps of a batch; a replay replaces them."""
    (id_bitmaps(events, id_col, ts_col).write.mode("overwrite")
     .parquet(fs.batch_folder(path, source, batch_id)))


def seen_before(spark: SparkSession, path: str, batch_id: int, source: str = "stream",
                since_day=None) -> DataFrame:
    """(id_bucket, bits): the ids of all batches that count as earlier; ``since_day`` leaves out
    event days before it (never those without a day)."""
    if not fs.exists(spark, path):
        return spark.createDataFrame([], "id_bucket bigint, bits binary")
    seen = spark.read.schema(_SCHEMA).option("basePath", path).parquet(path)
    own = F.col("source") == fs.source_key(source)
    seen = seen.where(~own | (F.col("batch_id") < int(batch_id)))
    if since_day is not None:
        seen = seen.where(F.col("event_date").isNull()
                          | (F.col("event_date") >= F.lit(str(since_day)).cast("date")))
    return seen.groupBy("id_bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def tag_seen(events: DataFrame, seen: DataFrame, id_col: str = "id") -> DataFrame:
    """``events`` with a boolean ``seen``: whether the id is in the bitmaps.

    The bitmaps are broadcast behind a check of their rows and bytes (64 MB hold half a billion
    dense ids); beyond it both sides are shuffled by bucket, whose events have at most 32,768
    different ids.
    """
    bucket = F.bitmap_bucket_number(id_col)
    at = F.bitmap_bit_position(id_col)
    side = maybe_broadcast(seen.select(F.col("id_bucket").alias("__id_bucket"),
                                       F.col("bits").alias("__bits")))
    byte = F.conv(F.hex(F.substring("__bits", F.floor(at / 8).cast("int") + 1, F.lit(1))),
                  16, 10).cast("int")
    hit = F.getbit(byte, (at % 8).cast("int")) == 1
    return (events.join(side, bucket == F.col("__id_bucket"), "left")
            .withColumn("seen", F.coalesce(hit, F.lit(False))).drop("__id_bucket", "__bits"))
