"""Quarantine / dead-letter output (K10, V6): rejected rows with their reasons.

Layout ``<path>/source=S/batch_id=N/``: a batch of a source overwrites its own folder as a
whole, also when it has no rejects, so a replay leaves nothing of an earlier attempt and
batches of other sources with the same number are untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.sinks import fs


def write_rejects(rejects: DataFrame, path: str, batch_id: int, source: str = "stream") -> None:
    (rejects.withColumn("rejected_at", F.current_timestamp())
     .write.mode("overwrite").parquet(fs.batch_folder(path, source, batch_id)))


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.option("basePath", path).parquet(path)
            .withColumn("source", F.col("source").cast("string")))


def reject_summary(rejects: DataFrame) -> DataFrame:
    """Rejected rows per reason (a row with two reasons counts for both)."""
    return (rejects.select(F.explode("reasons").alias("reason"))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("rejected_events")))
