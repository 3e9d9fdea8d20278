"""op2's path lengths and threshold by their definitions."""

import numpy as np

from eventide.llm import rules_forest as rf


def _walk(row, sample, tree, at=0, depth=0):
    """Path length of a row: splits above its leaf plus the expected depth below it, by the
    sample rows that reach the leaf."""
    f = tree["feature"][at]
    if f < 0:
        return depth + float(rf._expected_path(len(sample)))
    below = sample[:, f] < tree["cut"][at]
    if row[f] < tree["cut"][at]:
        return _walk(row, sample[below], tree, tree["left"][at], depth + 1)
    return _walk(row, sample[~below], tree, tree["right"][at], depth + 1)


def test_path_lengths_by_walking():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 4)).round(1)          # with ties
    x[:40] = x[0]
    samples = [x[rng.choice(len(x), 64, replace=False)] for _ in range(12)]
    forest = [rf.as_trees(rf.grow_tree(s, i, rng))[0] for i, s in enumerate(samples)]
    rows = np.concatenate([x, [[9.0] * 4, [-9.0] * 4]])
    want = [np.mean([_walk(r, s, t) for s, t in zip(samples, forest)]) for r in rows]
    got = rf.path_lengths(rows, forest)
    assert np.allclose(got, want)
    assert got[-2:].max() < np.median(got)           # far away: short paths
    assert abs(float(rf._expected_path(64)) - (
        2 * sum(1 / i for i in range(1, 64)) - 2 * 63 / 64)) < 0.05
    assert float(rf._expected_path(1)) == 0.0


def test_threshold_by_trying_all(spark):
    rng = np.random.default_rng(5)
    rows = [(i, int(rng.random() < 0.7)) for i in range(300)]
    scored = [(i, float(np.clip(rng.normal(0.45 if q else 0.6, 0.06), 0, 0.999)))
              for i, q in rows]
    cut = rf.calibrate(spark.createDataFrame(scored, "doc_id long, anomaly double"),
                       spark.createDataFrame(rows, "doc_id long, quality int"))
    score, mark = np.array([s for _, s in scored]), np.array([q for _, q in rows])
    bins = np.floor(score * rf.BINS)

    def gain(b):
        lost = [(bins[mark == q] >= b).mean() for q in (0, 1)]
        return lost[0] - rf.KEEP_WEIGHT * lost[1]

    best = max(gain(b) for b in range(rf.BINS + 1))
    assert abs(gain(round(cut * rf.BINS)) - best) < 1e-12
