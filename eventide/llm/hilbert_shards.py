"""Sharding along a Hilbert curve over document metadata.

Several metadata dimensions are quantised into cells of about equal numbers of documents, the
cells of a document name a point of a grid, and documents are put in the order of a Hilbert
curve through that grid. Neighbours on the curve are neighbours in every dimension, so the
shards, runs of the curve of equal length, have narrow ranges in all dimensions at once: a
filter on any of them leaves most shards, and most files in a shard, unread.

1. ``cell_bounds``: one pass over the metadata columns gives 2^bits - 1 quantiles of each
   dimension (``approx_percentile``: a fixed-size summary per task, merged).
2. ``curve_index``: cells by comparison with the bounds, curve index by bit operations on whole
   Arrow batches of the cells (texts never reach Python).
3. ``shard_documents``: the whole documents are ordered by (curve index, doc_id, text hash) in
   one range shuffle and numbered (``operators.paging``); position p of N goes to shard
   p * shards div N. Shard sizes differ by one row at most (law ``rows``).

Hot values: a source with a third of all rows fills several equal quantiles, that is, one
cell; its documents are spread along the other dimensions, and within a cell by doc_id, so the
range shuffle splits them. Rows that agree in curve index, doc_id and text are split by a hash
of the task's row number.

Defined results: a null in a dimension counts as smaller than every value (cell 0); a null
doc_id sorts first in its cell; a null text has no bytes; empty and very long texts are
ordinary rows (sizes play no part in the law); repeated rows are separate documents. An empty
table gives no rows. Extra columns are carried along; columns named ``shard``, ``slot`` or
``curve`` in the input are replaced. Fewer rows than shards leave some shards empty.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import prepare
from eventide.operators.paging import ordered_table
from eventide.session import checkpoint_dir

SHARDS = 16
BITS = 5                                   # 32 cells a dimension
DIMENSIONS = ("source", "lang", "n_chars")
ACCURACY = 20_000                          # of the quantiles: error of 1 / ACCURACY of the rows


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of the points ``cells`` (dimensions x points, each below
    2^bits). The highest bits decide first: at every level the orientation of the sub-cube is
    undone on all lower bits, then the bits are read through a Gray code."""
    x = [c.astype(np.int64) for c in cells]
    n = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(n):
            high = ((x[i] >> level) & 1).astype(bool)
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            if i:
                x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[n - 1] >> level) & 1, (1 << level) - 1, 0)
    index = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            index = (index << 1) | (((x[i] ^ turn) >> level) & 1)
    return index


def _ordinal(col: str, kind: T.DataType) -> Column:
    """A number that keeps the order of a column's values: numbers and times as they are, of
    anything else the first seven bytes of its text."""
    c = F.col(f"`{col}`")
    if isinstance(kind, T.BooleanType):
        return c.cast("int").cast("double")
    if isinstance(kind, (T.NumericType,)):
        return c.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    text = c.cast("string").cast("binary") if not isinstance(kind, T.BinaryType) else c
    head = F.rpad(F.hex(F.substring(text, 1, 7)), 14, "0")
    return F.conv(head, 16, 10).cast("long").cast("double")


def cell_bounds(docs: DataFrame, dimensions=DIMENSIONS, bits: int = BITS) -> list[list[float]]:
    """The 2^bits - 1 inner quantiles of each dimension, ascending. A frequent value is several
    quantiles: its cell is as far from its neighbours' as the rows it holds, so that a
    dimension of few values still spans the grid."""
    cells = 1 << bits
    wanted = F.array(*[F.lit(k / cells) for k in range(1, cells)])
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    row = docs.agg(*[F.percentile_approx(_ordinal(d, kinds[d]), wanted, F.lit(ACCURACY))
                     .alias(f"q{i}") for i, d in enumerate(dimensions)]).first()
    return [sorted(float(v) for v in (row[f"q{i}"] or []) if v == v)
            for i in range(len(dimensions))]


def curve_index(docs: DataFrame, bounds: list[list[float]], dimensions=DIMENSIONS,
                bits: int = BITS) -> Column:
    """The curve index of a row, from the cells of its dimensions."""
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    cells = []
    for d, b in zip(dimensions, bounds):
        value = _ordinal(d, kinds[d])
        # number of bounds that the value reaches
        cell = sum((F.when(value >= F.lit(v), b.count(v)).otherwise(0) for v in sorted(set(b))),
                   F.lit(0))
        cells.append(F.coalesce(cell, F.lit(0)).cast("int"))

    @F.pandas_udf("long")
    def index(point: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert_index(point.to_numpy().T, bits))

    return index(F.struct(*[c.alias(f"d{i}") for i, c in enumerate(cells)]))


def shard_documents(docs: DataFrame, shards: int = SHARDS, dimensions=DIMENSIONS,
                    bits: int = BITS, path: str | None = None) -> DataFrame:
    """Write ``docs`` in shards below ``path`` (default: a new folder of
    ``spark.checkpoint.dir``) and return what was written: the columns of ``docs``, ``curve``
    (index), ``slot`` (gapless from 0 in a shard, in curve order) and ``shard``.

    One shuffle moves the documents; the second write cuts the ordered files at the borders of
    shards without moving rows. Folders ``shard=K`` prune by shard, row-group statistics by
    the dimensions.
    """
    spark = docs.sparkSession
    prepare(spark)
    path = path or f"{checkpoint_dir(spark)}/eventide-shards-{uuid.uuid4().hex}"
    bounds = cell_bounds(docs, dimensions, bits)
    carried = [c for c in docs.columns if c not in ("shard", "slot", "curve")]
    ranked = docs.select(*[F.col(f"`{c}`") for c in carried],
                         curve_index(docs, bounds, dimensions, bits).alias("curve"),
                         F.xxhash64(F.coalesce("text", F.lit(""))).alias("__text"),
                         F.xxhash64(F.monotonically_increasing_id()).alias("__row"))
    table = ordered_table(ranked, ["curve", "doc_id", "__text", "__row"])
    total = max(table.total, 1)
    at = F.col("__at")
    shard = F.expr(f"__at * {int(shards)} div {total}")
    first = F.expr(f"(shard * {total} + {int(shards) - 1}) div {int(shards)}")
    cut = (table.rows("__at").withColumn("shard", shard)
           .select(*[F.col(f"`{c}`") for c in carried], "curve", (at - first).alias("slot"),
                   F.col("shard").cast("int").alias("shard")))
    cut.write.partitionBy("shard").option("compression", "zstd").parquet(path)
    return spark.read.schema(cut.schema).option("basePath", path).parquet(path)


def shard_boxes(sharded: DataFrame, dimensions=DIMENSIONS) -> DataFrame:
    """One row a shard: its rows and the least and greatest value of each dimension, what a
    reader needs to choose the shards of a filter."""
    bounds = [f(F.col(f"`{d}`")).alias(f"{name}_{d}") for d in dimensions
              for name, f in (("min", F.min), ("max", F.max))]
    return sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), *bounds)


def shard_digest(sharded: DataFrame) -> DataFrame:
    """The registered columns, from what was written."""
    text = F.coalesce("text", F.lit(""))
    return sharded.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard",
        "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")
