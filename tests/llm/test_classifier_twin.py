"""op3's scores against the definition: log densities by solving with the shrunk covariance."""

import zlib

import numpy as np

from eventide.llm import doc_stats, qda

MID = "/root/testdata/sf0.01"


def test_scores_by_definition(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    labels = spark.read.parquet(f"{MID}/labels.parquet")
    rows = doc_stats.document_stats(docs).select("doc_id", *doc_stats.COUNTS).collect()
    ids = [r[0] for r in rows]
    x = doc_stats.features(np.array([list(r)[1:] for r in rows], dtype=np.int64))
    marks = {r.doc_id: r.quality for r in labels.collect()}
    train = [i for i, d in enumerate(ids) if d in marks and zlib.crc32(str(d).encode()) % 5]
    log = []
    for k in (0, 1):
        z = x[[i for i in train if marks[ids[i]] == k]]
        cov = np.cov(z.T, bias=True)
        cov = (1 - qda.SHRINK) * cov + qda.SHRINK * np.diag(np.diag(cov))
        cov = cov + qda.RIDGE * np.eye(len(cov))
        away = x - z.mean(axis=0)
        far = np.einsum("ij,ij->i", away, np.linalg.solve(cov, away.T).T)
        log.append(np.log(len(z) / len(train)) - 0.5 * (np.linalg.slogdet(cov)[1] + far))
    want = dict(zip(ids, 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))))
    out = qda.classify(docs, labels).collect()
    assert len(out) == len(ids) == len(set(ids))
    assert max(abs(r.score - want[r.doc_id]) for r in out) < 1e-6
