"""Global row numbers and seek paging.

``OFFSET n LIMIT k`` sorts everything before the page and ends in one task. Here a result is
range-partitioned and sorted once, written with the place of every row inside its partition,
and the rows of each partition are counted; running totals of these counts (one number a
partition) turn partition places into global positions. A page is then a range filter that
Parquet's statistics prune, whatever its depth: no task sees more than its own partition.

``number_rows`` is the general operation, ``OrderedTable`` adds pages.
"""

from __future__ import annotations

import uuid
from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.session import checkpoint_dir

_PLACE = "__place"           # partition number in the high bits, place in the partition below
_PLACE_BITS = 33             # as monotonically_increasing_id lays them out
POSITION = "position"


class OrderedTable:
    """A written, globally ordered result.

    ``parts`` holds, for every non-empty partition in order, its number and the position of
    its first row: the only thing the driver keeps, two integers a partition.
    """

    def __init__(self, spark: SparkSession, path: str, schema, parts: list[tuple[int, int]],
                 total: int):
        self.spark = spark
        self.path = path
        self.schema = schema
        self.parts = parts
        self.total = total

    def _table(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def _columns(self, name: str) -> list[Column]:
        return [F.col(f"`{c}`") for c in self.schema.fieldNames() if c not in (_PLACE, name)]

    def rows(self, name: str = POSITION) -> DataFrame:
        """All rows with their 0-based global position (an input column of that name is
        replaced). The running totals are joined as a broadcast of one row a partition."""
        starts = self.spark.createDataFrame([(p, s) for p, s in self.parts],
                                            "__part int, __start long")
        table = self._table().withColumn(
            "__part", F.shiftright(_PLACE, _PLACE_BITS).cast("int"))
        table = table.join(F.broadcast(starts), "__part")
        inside = F.col(_PLACE).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
        keep = self._columns(name)
        return table.select(*keep, (F.col("__start") + inside).alias(name))

    def slice(self, start: int, end: int, name: str = POSITION) -> DataFrame:
        """Rows with ``start <= position < end``, by a filter on the place of a row in its
        partition: only the row groups of the partitions concerned are read. Rows come with
        their position, in no order."""
        start, end = max(0, int(start)), min(int(end), self.total)
        keep = self._columns(name)
        ranges, number = F.lit(False), F.lit(None).cast("long")
        if start < end:
            firsts = [s for _, s in self.parts]
            i = bisect_right(firsts, start) - 1
            while i < len(self.parts) and firsts[i] < end:
                part, first = self.parts[i]
                last = firsts[i + 1] if i + 1 < len(firsts) else self.total
                lo = (part << _PLACE_BITS) + max(start - first, 0)
                hi = (part << _PLACE_BITS) + min(end, last) - first
                here = (F.col(_PLACE) >= lo) & (F.col(_PLACE) < hi)
                ranges = here if i == bisect_right(firsts, start) - 1 else ranges | here
                number = F.when(here, F.col(_PLACE) - F.lit((part << _PLACE_BITS) - first)
                                ).otherwise(number)
                i += 1
        return self._table().where(ranges).select(*keep, number.alias(name))

    def page(self, size: int, number: int = 0, name: str = POSITION) -> DataFrame:
        """Page ``number`` (from 0) of ``size`` rows, with positions; beyond the end: no row."""
        return self.slice(int(size) * int(number), int(size) * (int(number) + 1), name)


def ordered_table(df: DataFrame, order_by: list[Column | str], path: str | None = None,
                  partitions: int | None = None) -> OrderedTable:
    """Write ``df`` in its global order below ``path`` (default: a new folder of
    ``spark.checkpoint.dir``).

    One shuffle: Spark samples the order columns for range bounds, so that a hot value is
    split wherever a later column tells its rows apart (end the order with a unique key; rows
    that agree in all order columns stay together). ``partitions`` fixes the number of
    ranges; by default it is the session's number of shuffle partitions, joined where small.
    Partition numbers and places are written with the rows, so what is read later does not
    depend on the sampling, and a lost executor only repeats its own ranges.
    """
    spark = df.sparkSession
    path = path or f"{checkpoint_dir(spark)}/eventide-ordered-{uuid.uuid4().hex}"
    # placed first, so that the range shuffle and the sort cannot be pruned as unneeded
    if partitions:
        ordered = df.repartitionByRange(int(partitions), *order_by).sortWithinPartitions(*order_by)
    else:
        ordered = df.orderBy(*order_by)
    placed = ordered.withColumn(_PLACE, F.monotonically_increasing_id())
    placed.write.mode("overwrite").parquet(path)
    table = spark.read.schema(placed.schema).parquet(path)
    counts = (table.groupBy(F.shiftright(_PLACE, _PLACE_BITS).cast("int").alias("part"))
              .agg(F.count(F.lit(1)).alias("n")).collect())
    counts = sorted((r["part"], r["n"]) for r in counts)
    ends = list(accumulate(n for _, n in counts))
    parts = [(p, end - n) for (p, n), end in zip(counts, ends)]
    return OrderedTable(spark, path, placed.schema, parts, ends[-1] if ends else 0)


def number_rows(df: DataFrame, order_by: list[Column | str], name: str = POSITION,
                partitions: int | None = None) -> DataFrame:
    """``df`` with the 0-based number of every row in the global order: ``row_number() OVER
    (ORDER BY ...) - 1`` without a single-partition window."""
    return ordered_table(df, order_by, partitions=partitions).rows(name)
