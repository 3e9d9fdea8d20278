"""Kafka publication (K9, P14) and consumption (S1) as thin Spark options.

The Kafka connector jar is not on this image's classpath, so these functions are not
exercised by the tests; they only assemble the documented Spark options.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.operators.projections import to_change_row


def kafka_events(spark: SparkSession, servers: str, topic: str,
                 starting_offsets: str = "earliest", max_offsets_per_trigger: int | None = None,
                 fail_on_data_loss: bool = True) -> DataFrame:
    """The topic as a stream of JSON strings in ``value`` (key = content id). Offsets that the
    topic no longer holds fail the query unless ``fail_on_data_loss`` is off."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets)
              .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", int(max_offsets_per_trigger))
    return reader.load().select(F.col("key").cast("string").alias("key"),
                                F.col("value").cast("string").alias("value"))


def publish_events(events: DataFrame, servers: str, topic: str) -> None:
    """K9/ST14: batch publish, one JSON message per event, keyed by content id."""
    (to_change_row(events).write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())
