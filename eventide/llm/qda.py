"""Quality classifier: regularised quadratic discriminant.

The statistics of a document (``doc_stats``) are transformed to logs and smoothed log-ratios.
Each class of ``labels.quality`` gets a Gaussian over them whose covariance is shrunk towards
its diagonal. A score is the posterior of class 1: the difference of the two log densities
(Mahalanobis distance by the cached Cholesky factor, log determinant, log prior) through the
logistic function.

Moments are exact sums over all training rows: each Arrow batch adds up its rows, a grouping
adds the batches, and two classes x (1 + d + d * d) numbers reach the driver. The model (two
means and triangular factors) travels with the scoring tasks.

Training rows are labelled rows with a label of 0 or 1 whose crc32(doc_id as text) mod
``folds`` is not 0; labels, source, lang and doc_id are never inputs of a score.

Defined cases: null text counts as empty and is scored like any text. Rows without doc_id are
scored and not held out. If a class has no training rows the score is the share of class 1
among the training rows, or 0.5 without any. Repeated rows each get a row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import materialize
from eventide.llm.doc_stats import COUNTS, FEATURES, document_stats, features

FOLDS = 5
SHRINK = 0.3
RIDGE = 1e-3
THRESHOLD = 0.3


def held_out(doc_id: Column, folds: int = FOLDS, rest: int = 0) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``, equals ``rest``; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == rest, F.lit(False))


def class_moments(stats: DataFrame, labels: DataFrame) -> dict[int, tuple]:
    """class -> (rows, sum of x, sum of x x')."""
    marks = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
             .where("doc_id IS NOT NULL AND quality IN (0, 1)").distinct())
    rows = stats.join(marks.where(~held_out(F.col("doc_id"))), "doc_id").select(
        F.col("quality").cast("int").alias("quality"), *COUNTS)
    d = FEATURES

    def add_up(batches):
        acc = {}
        for batch in batches:
            q = batch.column(0).to_numpy(zero_copy_only=False)
            x = features(np.stack([c.to_numpy(zero_copy_only=False)
                                   for c in batch.columns[1:]], axis=1))
            for k in np.unique(q):
                z = x[q == k]
                m = np.concatenate([[len(z)], z.sum(axis=0), (z.T @ z).ravel()])
                acc[int(k)] = acc.get(int(k), 0) + m
        for k, m in acc.items():
            n = len(m)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, k, np.int32)), pa.array(np.arange(n, dtype=np.int32)),
                 pa.array(m)], names=["quality", "i", "v"])

    sums = rows.mapInArrow(add_up, "quality int, i int, v double").groupBy("quality", "i").agg(
        F.sum("v").alias("v")).toPandas()  # 2 x (1 + d + d * d) rows
    out = {}
    for k, g in sums.groupby("quality"):
        m = g.sort_values("i")["v"].to_numpy()
        out[int(k)] = (m[0], m[1:1 + d], m[1 + d:].reshape(d, d))
    return out


def fit(moments: dict[int, tuple], shrink: float = SHRINK, ridge: float = RIDGE) -> dict:
    """Model: log prior, mean, inverse Cholesky factor and log determinant of each class."""
    total = sum(m[0] for m in moments.values())
    if not all(k in moments for k in (0, 1)):
        share = moments[1][0] / total if 1 in moments else (0.0 if total else 0.5)
        return {"constant": float(share)}
    model = {}
    for k, (n, s, ss) in moments.items():
        mean = s / n
        cov = ss / n - np.outer(mean, mean)
        cov = (1 - shrink) * cov + shrink * np.diag(np.diag(cov)) + ridge * np.eye(len(mean))
        chol = np.linalg.cholesky(cov)
        model[k] = (float(np.log(n / total)), mean, np.linalg.inv(chol),
                    float(2 * np.log(np.diag(chol)).sum()))
    return model


def score(x: np.ndarray, model: dict) -> np.ndarray:
    """Posterior of class 1 for each row of features."""
    if "constant" in model:
        return np.full(len(x), model["constant"])
    log = []
    for k in (0, 1):
        prior, mean, inv, det = model[k]
        z = (x - mean) @ inv.T
        log.append(prior - 0.5 * (det + (z * z).sum(axis=1)))
    return 1.0 / (1.0 + np.exp(np.clip(log[0] - log[1], -700, 700)))


def classify(docs: DataFrame, labels: DataFrame, shrink: float = SHRINK,
             threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per input row."""
    stats = materialize(document_stats(docs), "stats")
    model = fit(class_moments(stats, labels), shrink)
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            x = features(np.stack([c.to_numpy(zero_copy_only=False)
                                   for c in batch.columns[1:]], axis=1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score(x, shared.value))], names=["doc_id", "score"])

    scored = stats.select("doc_id", *COUNTS).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
