"""Quality rules with an isolation forest on rule statistics.

Two fixed rules reject a document outright (too few words, too many words in repeated
three-word windows). All others are judged by an isolation forest: every tree splits a small
sample of documents at random values of random statistics, and a document that random splits
separate after a short path is an anomaly. The anomaly score is 2 ** (-mean path length /
expected path length of a binary search tree), as published for isolation forests.

Statistics cover all rows (one Arrow pass over the text, written to the shared folder). Trees
grow in tasks, each from ``sample`` random rows of a pool: the POOL documents labelled good
with the smallest hashes (the bound of what the forest learns from), so what no good document
looks like is isolated early. The
forest is trees x (2 * sample - 1) nodes at most, whatever the input: that bounds its
broadcast. The threshold is calibrated on all labelled rows that pass the fixed rules: a
histogram of their scores by label, from which the cut with the largest weighted gain is taken.

Defined cases: null text counts as empty (no words: rejected by rule). Labels may be missing
or null for any row; without both classes of labels no document is an anomaly and only the
rules decide. Repeated rows each get a row. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import ROW_KEY, materialize
from eventide.llm.doc_stats import COUNTS, FEATURES, document_stats, features

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
TREES = 96
#: Labelled rows that the forest is grown from, at most.
POOL = 8192
SAMPLE = 256
#: Losing a good document counts this many times as much as keeping a poor one.
KEEP_WEIGHT = 4.0
BINS = 1000
_NODE = "tree int, node int, feature int, cut double, left int, right int, path double"


def _expected_path(n):
    """Mean depth of an unsuccessful search in a binary search tree of n keys."""
    n = np.asarray(n, np.float64)
    h = np.log(np.maximum(n - 1, 1)) + 0.5772156649015329
    return np.where(n > 2, 2 * h - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def grow_tree(x: np.ndarray, tree: int, rng: np.random.Generator) -> pd.DataFrame:
    """Nodes of one isolation tree over the rows of ``x``, grown until rows are alone."""
    limit = int(np.ceil(np.log2(max(2, len(x)))))
    nodes = []  # feature, cut, left, right, path
    todo = [(np.arange(len(x)), 0, -1, 0)]
    while todo:
        rows, depth, parent, side = todo.pop()
        at = len(nodes)
        nodes.append([-1, 0.0, -1, -1, depth + float(_expected_path(len(rows)))])
        if parent >= 0:
            nodes[parent][2 + side] = at
        if len(rows) < 2 or depth >= limit:
            continue
        lo, hi = x[rows].min(axis=0), x[rows].max(axis=0)
        open_ = np.flatnonzero(hi > lo)
        if not len(open_):
            continue
        f = int(rng.choice(open_))
        cut = float(rng.uniform(lo[f], hi[f]))
        nodes[at][0], nodes[at][1] = f, cut
        below = x[rows, f] < cut
        todo += [(rows[~below], depth + 1, at, 1), (rows[below], depth + 1, at, 0)]
    out = pd.DataFrame(nodes, columns=["feature", "cut", "left", "right", "path"])
    out.insert(0, "node", np.arange(len(out)))
    out.insert(0, "tree", tree)
    return out


def path_lengths(x: np.ndarray, forest: list[dict[str, np.ndarray]]) -> np.ndarray:
    """Mean path length of every row over the trees."""
    total = np.zeros(len(x))
    rows = np.arange(len(x))
    for t in forest:
        at = np.zeros(len(x), np.int64)
        while True:
            f = t["feature"][at]
            inner = f >= 0
            if not inner.any():
                break
            below = x[rows, np.maximum(f, 0)] < t["cut"][at]
            at = np.where(inner, np.where(below, t["left"][at], t["right"][at]), at)
        total += t["path"][at]
    return total / max(1, len(forest))


def as_trees(nodes: pd.DataFrame) -> list[dict[str, np.ndarray]]:
    nodes = nodes.sort_values(["tree", "node"])
    return [{c: g[c].to_numpy() for c in ("feature", "cut", "left", "right", "path")}
            for _, g in nodes.groupby("tree")]


def anomaly_score(x: np.ndarray, forest: list[dict[str, np.ndarray]], sample: int) -> np.ndarray:
    if not forest:
        return np.zeros(len(x))
    return 2.0 ** (-path_lengths(x, forest) / max(float(_expected_path(sample)), 1e-9))


def _marks(labels: DataFrame) -> DataFrame:
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
            .where("doc_id IS NOT NULL AND quality IS NOT NULL").distinct())


def fit_forest(stats: DataFrame, labels: DataFrame, trees: int = TREES, sample: int = SAMPLE,
               seed: int = 7) -> tuple[pd.DataFrame, int]:
    """Nodes of the forest (at most trees x (2 * sample - 1) rows) and the rows of a tree's
    sample; the trees are grown in tasks."""
    known = stats.join(_marks(labels).where("quality = 1"), "doc_id")
    pool = (known.withColumn("h", F.xxhash64("doc_id", F.lit(seed)))
            .orderBy("h", "doc_id").limit(POOL).toPandas())
    x = features(pool[COUNTS].to_numpy())
    sample = min(sample, len(x))
    spark = stats.sparkSession
    shared = spark.sparkContext.broadcast(x)

    def grow(batches):
        for batch in batches:
            for tree in batch["id"]:
                rng = np.random.default_rng([seed, int(tree)])
                rows = rng.choice(len(shared.value), sample, replace=False)
                yield grow_tree(shared.value[rows], int(tree), rng)

    if not sample:
        return pd.DataFrame(columns=["tree", "node"]), 0
    nodes = spark.range(0, trees, 1, min(trees, 16)).mapInPandas(grow, _NODE)
    return nodes.toPandas(), sample


def score_rows(stats: DataFrame, nodes: pd.DataFrame, sample: int) -> DataFrame:
    """stats with the anomaly score of every row (the small forest travels with the task)."""
    forest = stats.sparkSession.sparkContext.broadcast(as_trees(nodes) if len(nodes) else [])
    names = stats.columns

    def run(batches):
        for batch in batches:
            x = features(np.stack([batch.column(names.index(c)).to_numpy(zero_copy_only=False)
                                   for c in COUNTS], axis=1))
            s = anomaly_score(x, forest.value, sample)
            yield pa.RecordBatch.from_arrays(list(batch.columns) + [pa.array(s)],
                                             names=names + ["anomaly"])

    kinds = ", ".join(f"`{n}` {t}" for n, t in stats.dtypes)
    return stats.mapInArrow(run, kinds + ", anomaly double")


def calibrate(scored: DataFrame, labels: DataFrame, keep_weight: float = KEEP_WEIGHT) -> float:
    """Largest anomaly score a document may have: the cut over a histogram of the labelled
    rows' scores that catches most poor rows less ``keep_weight`` times the good ones lost
    (both as shares of their class). Without both classes: 2, nothing is an anomaly."""
    bins = (scored.join(_marks(labels), "doc_id")
            .groupBy("quality", F.floor(F.col("anomaly") * BINS).cast("int").alias("bin"))
            .agg(F.count("*").alias("n")).toPandas())  # at most 2 x (BINS + 1) rows
    hist = np.zeros((2, BINS + 1))
    for q, b, n in bins[["quality", "bin", "n"]].itertuples(index=False):
        if q in (0, 1):
            hist[int(q), int(b)] += n
    if not hist.sum(axis=1).all():
        return 2.0
    above = hist[:, ::-1].cumsum(axis=1)[:, ::-1] / hist.sum(axis=1, keepdims=True)
    gain = above[0] - keep_weight * above[1]
    best = int(np.argmax(gain))
    return best / BINS if gain[best] > 0 else 2.0


def judge(docs: DataFrame, labels: DataFrame, min_words: int = 50, max_repeat: int = 50,
          keep_weight: float = KEEP_WEIGHT, with_key: bool = False) -> DataFrame:
    """doc_id, BASE counts, base_failed, kept, anomaly, threshold (and row_key if asked for):
    one row per input row."""
    stats = materialize(document_stats(docs, with_key), "stats")
    nodes, sample = fit_forest(stats, labels)
    scored = materialize(score_rows(stats, nodes, sample), "scores")
    failed = (F.col("n_words") < min_words) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(max_repeat) * F.col("n_words"))
    cut = calibrate(scored.where(~failed), labels, keep_weight)
    return scored.select("doc_id", *BASE, failed.alias("base_failed"),
                         (~failed & (F.col("anomaly") < F.lit(cut))).alias("kept"),
                         "anomaly", F.lit(cut).alias("threshold"), *[ROW_KEY] * with_key)
