"""Line de-duplication over overlapping windows of three consecutive lines.

A document's lines are its text split at \\n. Every three consecutive lines form a window;
windows overlap. A window is identified by the 128-bit hash of its three lines. Of all equal
windows in the corpus the first (smallest doc_id, then smallest line number) is the original;
the lines of every later one are covered, and covered lines are removed. Overlapping windows
merge by uniting their covered positions, also where they overlap the original.

Windows without a copy are dropped by a counting aggregation (partial in each task, so a
window that a third of all documents carries costs one row per task); only repeated windows
meet their original in a join. The originals are written before it, so that both sides of the
join are plain scans below their exchange: the shape whose skewed partitions Spark splits.

Defined cases: null text is the empty text (one empty line, no window); documents of fewer
than three lines have no window and lose nothing. Rows with a null doc_id come after all
others. Rows with one doc_id, or none, but different texts are documents of their own (equal
windows are in the order of line numbers, then of the texts' hashes). Repeated rows of one doc_id
and text are the same document: none is a later occurrence of the other. Very long texts are one
row each; their work grows with their lines. Columns other than doc_id and text are ignored, so
none can clash. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import ROW_KEY, keep_maybe_present, materialize, presence_bitmap, texts

WINDOW = 3
_LAST = (1 << 63) - 1


def _lines(docs: DataFrame) -> DataFrame:
    base = texts(docs)
    return base.select("doc_id", F.coalesce("doc_id", F.lit(_LAST)).alias("ord"),
                       F.xxhash64("text").alias(ROW_KEY), "text")


def windows(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """(ord, row_key, line, key): every window with its first line's number."""
    arr = F.split("text", "\n")
    lines = _lines(docs).withColumn("lines", arr).where(F.size("lines") >= width)
    starts = F.sequence(F.lit(1), F.size("lines") - (width - 1))
    keys = F.transform(starts, lambda i: F.struct(
        (i - 1).alias("line"),
        F.unhex(F.md5(F.array_join(F.slice("lines", i, width), "\n"))).alias("key")))
    return lines.select("ord", ROW_KEY, F.explode(keys).alias("w")).select(
        "ord", ROW_KEY, "w.line", "w.key")


def covered_lines(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """(ord, row_key, covered): sorted numbers of the lines that later occurrences cover."""
    found = materialize(windows(docs, width), "windows")
    first = (found.groupBy("key")
             .agg(F.min(F.struct("ord", "line", ROW_KEY)).alias("first"), F.count("*").alias("n"))
             .where("n > 1").select("key", "first"))
    first = materialize(first, "originals")
    later = found.join(first, "key").where(F.struct("ord", "line", ROW_KEY) != F.col("first"))
    spans = F.explode(F.sequence(F.col("line"), F.col("line") + (width - 1)))
    return (later.select("ord", ROW_KEY, spans.alias("line"))
            .groupBy("ord", ROW_KEY).agg(F.sort_array(F.collect_set("line")).alias("covered")))


def line_dedup(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """doc_id, n_lines, n_removed, text (what is left, joined by \\n); one row per input row.

    Documents that lose lines are found with a presence bitmap, so the texts of all others
    are not shuffled.
    """
    covered = materialize(covered_lines(docs, width), "covered").withColumn(
        "key", F.xxhash64("ord", ROW_KEY))
    hit = presence_bitmap(covered, "key")
    base = _lines(docs).withColumn("key", F.xxhash64("ord", ROW_KEY))
    lines = F.split("text", "\n")
    n_lines = F.size(lines).cast("long")
    clean = keep_maybe_present(base, "key", hit, absent=True).select(
        "doc_id", n_lines.alias("n_lines"), F.lit(0).cast("long").alias("n_removed"), "text")
    touched = (keep_maybe_present(base, "key", hit)
               .join(covered.drop("key"), ["ord", ROW_KEY], "left")
               .withColumn("covered", F.coalesce("covered", F.array().cast("array<int>")))
               .withColumn("lines", lines))
    # array_except hashes the covered numbers: linear in the lines
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("covered"))
    left = F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n")
    cut = touched.select("doc_id", F.size("lines").cast("long").alias("n_lines"),
                         F.size("covered").cast("long").alias("n_removed"), left.alias("text"))
    return clean.unionByName(cut)


ORACLE_SQL = """
WITH l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents),
s AS (SELECT doc_id, a, unnest(range(0, greatest(len(a) - 2, 0))) AS i FROM l),
w AS (SELECT doc_id, i, a[i + 1] || chr(10) || a[i + 2] || chr(10) || a[i + 3] AS k FROM s),
later AS (SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM w) WHERE r > 1),
cov AS (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS i FROM later),
all_lines AS (SELECT doc_id, unnest(range(0, len(a))) AS i, unnest(a) AS line FROM l),
k AS (SELECT x.doc_id, count(*) AS n_lines, count(c.i) AS n_removed,
             sha256(coalesce(string_agg(x.line, chr(10) ORDER BY x.i) FILTER (c.i IS NULL), '')) AS kept_sha256
      FROM all_lines x LEFT JOIN cov c USING (doc_id, i) GROUP BY x.doc_id)
SELECT doc_id, n_lines, n_removed, kept_sha256 FROM k
"""
