"""Shared Spark helpers of the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.session import apply_defaults, checkpoint_dir, ship_code

#: Bits of the presence bitmap: 2^25 bits in rows of 4 KB are at most 4 MB, whatever the
#: number of keys, so broadcasting it is safe at any input size.
PRESENCE_BITS = 1 << 25
_ROW_BITS = 32768  # bits of one bitmap row of Spark's bitmap functions


def prepare(spark: SparkSession) -> None:
    """What every operator needs of its session: defaults for unset keys, code on workers."""
    apply_defaults(spark)
    ship_code(spark)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the cluster's shared checkpoint folder and read it back.

    Cuts the lineage: later stages reread files that survive the loss of an executor.
    """
    spark = df.sparkSession
    prepare(spark)
    path = f"{checkpoint_dir(spark)}/eventide-llm-{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) only, null text read as empty: names of other columns cannot clash."""
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))


#: With doc_id it tells rows apart that share an id, or that have none.
ROW_KEY = "row_key"


def row_key(text: Column) -> Column:
    """128-bit hash of a row's text (null as empty)."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, text) is not in ``dropped`` (doc_id, row_key)."""
    gone = dropped.select(F.col("doc_id").alias("__doc_id"),
                          F.col(ROW_KEY).alias("__row_key")).distinct()
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col("__doc_id"))
                     & (row_key(F.col("text")) == F.col("__row_key")), "left_anti")


def fold_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _position(hash_col: Column) -> Column:
    return F.pmod(hash_col, F.lit(PRESENCE_BITS))


def presence_bitmap(keys: DataFrame, hash_col: str) -> DataFrame:
    """One-hash Bloom filter of the 64-bit ``hash_col``: at most PRESENCE_BITS / 32768 rows
    (``__slot``, ``__bits``) of 4 KB."""
    pos = _position(F.col(hash_col))
    return (keys.groupBy(F.floor(pos / _ROW_BITS).cast("int").alias("__slot"))
            .agg(F.bitmap_construct_agg((pos % _ROW_BITS).cast("long")).alias("__bits")))


def keep_maybe_present(df: DataFrame, hash_col: str, bitmap: DataFrame,
                       absent: bool = False) -> DataFrame:
    """Rows of ``df`` whose ``hash_col`` may be in the bitmap's key set (no false negatives);
    with ``absent`` the rows that surely are not in it. No shuffle: the bitmap is broadcast,
    its size is bounded by PRESENCE_BITS."""
    pos = _position(F.col(hash_col))
    probe = df.withColumn("__pos", pos).withColumn(
        "__slot", F.floor(F.col("__pos") / _ROW_BITS).cast("int"))
    joined = probe.join(F.broadcast(bitmap), "__slot", "left")
    in_row = F.col("__pos") % _ROW_BITS
    byte = F.conv(F.hex(F.expr("substring(__bits, cast(__pos % 32768 div 8 as int) + 1, 1)")),
                  16, 10).cast("int")
    hit = F.coalesce(F.expr("1") == F.getbit(byte, (in_row % 8).cast("int")).cast("int"),
                     F.lit(False))
    return joined.where(~hit if absent else hit).drop("__pos", "__slot", "__bits")
