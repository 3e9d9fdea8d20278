"""Exact de-duplication with an extendible-hash index on shared files.

Texts are equal when they are identical after every run of ASCII white space became one
space. The key of a text is the 64-bit hash of that form. The index is an extendible hash
file: a directory addressed by the leading bits of the key, doubled until no bucket holds
more than ``capacity`` keys (or the directory has ``max_depth`` bits: what is still overfull
then is an overflow chain). Its entries are written to the shared folder in key order. A key that
occurs once needs no comparison. A row whose key occurs more often looks its bucket up in the
directory and goes to the bucket's owner: the task that reads the entries of that bucket from
the files and holds its whole key range. The owner puts the texts of an entry in byte order and
compares neighbours, so that copies unite and colliding texts become further links of the chain.
A row gets its group from the chain it was put in, and from nowhere else.

Only hashes travel for texts that are unique. Copies are aggregated before the owner gets them:
within each map task, then over ``SALTS`` shares of the rows, so a group with a third of all
rows reaches its owner as at most ``SALTS`` texts.

Defined cases: null text is the empty text. A row without doc_id takes part, but it stays
only if no row of its group has an id (then every such row reports keep_id null, kept true).
Repeated rows with one doc_id are copies of each other: all rows with the staying id are kept.
An empty table gives an empty result. Very long texts are compared whole, like any other. Extra
columns are ignored, so none can clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import keep_maybe_present, materialize, presence_bitmap

#: ASCII white space of the contract.
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
#: At most 2^20 directory cells (about 25 MB), the proven bound of its broadcast.
MAX_DEPTH = 20
#: Shares of a text's copies that are united before the bucket's owner compares them.
SALTS = 16


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


def _keyed(docs: DataFrame) -> DataFrame:
    norm = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       normalised(F.col("text")).alias("norm"))
    return norm.withColumn("key", F.xxhash64("norm"))


def directory(keys: DataFrame, capacity: int, max_depth: int = MAX_DEPTH
              ) -> tuple[DataFrame, Column]:
    """Directory of the index, (cell, bucket, depth) with one row per non-empty cell, and the
    cell of a key.

    ``keys`` has one row per distinct key. A bucket is a prefix of the key; a prefix with
    more than ``capacity`` keys is split by its next bit, which doubles the directory when
    the bucket was already at the global depth. The counts of all prefixes come from one
    aggregation over the cells of the largest directory considered: three doublings beyond
    what an even spread needs.
    """
    n_keys = keys.count()
    even = math.ceil(math.log2(max(1, n_keys / capacity)))
    bits = min(max_depth, even + 3)
    cell = F.shiftrightunsigned("key", 64 - bits) if bits else F.lit(0).cast("long")
    cells = keys.groupBy(cell.alias("cell")).agg(F.count("*").alias("n"))
    levels = cells.select("cell", "n", F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("depth"))
    prefix = F.expr(f"shiftright(cell, {bits} - depth)")
    sized = (levels.groupBy("depth", prefix.alias("bucket")).agg(F.sum("n").alias("n"))
             .where((F.col("n") <= capacity) | (F.col("depth") == bits)))
    fits = levels.select("cell", "depth", prefix.alias("bucket")).join(
        sized.select("depth", "bucket"), ["depth", "bucket"])
    cells = (fits.groupBy("cell").agg(F.min(F.struct("depth", "bucket")).alias("leaf"))
             .select("cell", "leaf.bucket", "leaf.depth"))
    return cells, cell


def build_index(keyed: DataFrame, capacity: int = 4096
                ) -> tuple[DataFrame, DataFrame, Column]:
    """Index on shared files: entries (bucket, depth, key, n) in bucket and key order, the
    directory (cell, bucket, depth) and the cell of a key."""
    counts = keyed.groupBy("key").agg(F.count("*").alias("n"))
    counts = materialize(counts, "keys")
    cells, cell = directory(counts, capacity)
    cells = materialize(cells, "directory")
    owned = (_in_bucket(counts, cells, cell)
             .repartitionByRange("bucket", "depth", "key")
             .sortWithinPartitions("bucket", "depth", "key"))
    return materialize(owned.select("bucket", "depth", "key", "n"), "index"), cells, cell


def _in_bucket(rows: DataFrame, cells: DataFrame, cell: Column) -> DataFrame:
    """Rows with the bucket of their key; the directory is broadcast, see MAX_DEPTH."""
    return rows.withColumn("cell", cell).join(F.broadcast(cells), "cell").drop("cell")


def chains(docs: DataFrame, index: DataFrame, cells: DataFrame, cell: Column) -> DataFrame:
    """(key, text_sha256, keep_id, group_size, link, overflow): every link of the chains of
    repeated keys, numbered from 1 in byte order of the texts. ``overflow``: rows of the key that
    the index counts, but the chain does not hold (0 unless index and texts disagree)."""
    entries = index.where("n > 1")
    texts = keep_maybe_present(_keyed(docs), "key", presence_bitmap(entries, "key"))
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    shares = (_in_bucket(texts, cells, cell)
              .groupBy("bucket", "depth", "key", "norm", salt.alias("salt"))
              .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("rows")))
    owned = entries.join(shares, ["bucket", "depth", "key"])
    entry = Window.partitionBy("bucket", "depth", "key")
    order = entry.orderBy("norm")
    new = F.when(F.col("norm") == F.lag("norm").over(order), 0).otherwise(1)
    # the rows of one link carry one text: it is hashed where the link starts
    linked = (owned.withColumn("new", new)
              .withColumn("link", F.sum("new").over(order.rowsBetween(
                  Window.unboundedPreceding, Window.currentRow)))
              .withColumn("sha", F.when(F.col("new") == 1, F.sha2("norm", 256))).drop("norm"))
    return (linked.groupBy("bucket", "depth", "key", "link")
            .agg(F.max("sha").alias("text_sha256"), F.min("keep_id").alias("keep_id"),
                 F.sum("rows").alias("group_size"), F.first("n").alias("n"))
            .withColumn("overflow", F.col("n") - F.sum("group_size").over(entry))
            .select("key", "text_sha256", "keep_id", "group_size", "link", "overflow"))


def exact_groups(docs: DataFrame, capacity: int = 4096) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per input row."""
    keyed = _keyed(docs)
    digests = materialize(keyed.select("doc_id", "key", F.sha2("norm", 256).alias("text_sha256")),
                          "digests")
    index, cells, cell = build_index(digests, capacity)
    # written, so that the join below may split a partition that a hot text skews
    found = materialize(chains(docs, index, cells, cell).select(
        "key", "text_sha256", "keep_id", "group_size"), "chains")
    linked = digests.join(found, ["key", "text_sha256"], "left")
    size = F.coalesce("group_size", F.lit(1).cast("long"))
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return linked.select("doc_id", keep.alias("keep_id"), size.alias("group_size"),
                         F.equal_null(F.col("doc_id"), keep).alias("kept"), "text_sha256")


def exact_dedup(docs: DataFrame, capacity: int = 4096) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Rows are told apart by doc_id and
    text, so a row that goes takes no other text of its id, or without one, along."""
    groups = exact_groups(docs, capacity)
    drop = groups.where(~F.col("kept")).select(
        F.col("doc_id").alias("__doc_id"), F.col("text_sha256").alias("__sha256")).distinct()
    return docs.join(drop, F.col("doc_id").eqNullSafe(F.col("__doc_id")) & (
        F.sha2(normalised(F.col("text")), 256) == F.col("__sha256")), "left_anti")


ORACLE_SQL = """
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS norm
  FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
"""
