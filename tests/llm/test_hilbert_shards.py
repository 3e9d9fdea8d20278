"""Hilbert-curve sharding: the curve itself, the law, order, pruning, edge cases."""

import random
import zlib

import numpy as np
import pytest

from eventide.llm import hilbert_shards as hs
from eventide.llm import queries

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, shard string, "
          "slot string, curve string, position int, `a.b` int")


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", 4, 5) for r in rows], SCHEMA).repartition(4)


@pytest.mark.parametrize("n,bits", [(2, 1), (2, 5), (3, 1), (3, 3), (4, 2), (1, 4)])
def test_curve_visits_every_cell_by_unit_steps(n, bits):
    grid = np.indices((1 << bits,) * n).reshape(n, -1)
    index = hs.hilbert_index(grid, bits)
    assert sorted(index) == list(range(grid.shape[1]))
    steps = np.abs(np.diff(grid[:, np.argsort(index)], axis=1)).sum(axis=0)
    assert (steps == 1).all()


def _rows(n=1000):
    rng = random.Random(2)
    # one source holds a third of the rows
    return [(i, "w" * rng.randrange(5, 400), rng.choice(("en", "de", "fr", "es")),
             "hot" if i % 3 == 0 else f"src{rng.randrange(40)}", rng.randrange(1, 5000))
            for i in range(n)]


def _key(row, bounds):
    cells = []
    for value, bound in zip((row.source, row.lang, row.n_chars), bounds):
        if value is None:
            cells.append(0)
            continue
        if isinstance(value, str):
            value = int(value.encode()[:7].ljust(7, b"\0").hex(), 16)
        cells.append(sum(float(value) >= b for b in bound))
    return int(hs.hilbert_index(np.array([[c] for c in cells]), hs.BITS)[0])


def test_shards_are_equal_runs_of_the_curve(spark):
    df = _frame(spark, _rows())
    bounds = hs.cell_bounds(df)
    out = hs.shard_documents(df, shards=16).collect()
    assert len(out) == 1000
    sizes = [sum(r.shard == s for r in out) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == 1000
    ordered = sorted(out, key=lambda r: (r.shard, r.slot))
    assert [r.slot for r in ordered] == [k for s in range(16) for k in range(sizes[s])]
    want = sorted(((_key(r, bounds), r.doc_id) for r in out))
    assert [(r.curve, r.doc_id) for r in ordered] == want


def test_boxes_prune_in_every_dimension(spark):
    out = hs.shard_documents(_frame(spark, _rows(2000)), shards=32)
    boxes = hs.shard_boxes(out).collect()
    assert sum(b["rows"] for b in boxes) == 2000

    def read(dim, value):
        return sum(b[f"min_{dim}"] <= value <= b[f"max_{dim}"] for b in boxes)

    # an order by one column would leave 32 of 32 shards to read for the others
    assert read("source", "hot") < 24
    assert sum(read("lang", v) for v in ("en", "de", "fr", "es")) / 4 < 20
    assert sum(read("n_chars", v) for v in (100, 1500, 3000, 4900)) / 4 < 20


def test_edges(spark):
    rng = random.Random(4)
    rows = [(None, None, None, None, None), (None, "", "en", None, 3), (5, "dup", "en", "s", 3),
            (5, "dup", "en", "s", 3), (5, "other", "en", "s", None), (7, "é" * 200_000, "de", "", 9),
            (8, "", None, "s", -1)] + [(9, "same", "en", "s", 4)] * 30
    rng.shuffle(rows)
    df = _frame(spark, rows)
    out = hs.shard_documents(df, shards=4).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in out) == sorted(
        (str(r[0]), str(r[1])) for r in rows)
    sizes = [sum(r.shard == s for r in out) for s in range(4)]
    assert max(sizes) - min(sizes) <= 1
    for s in range(4):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sizes[s]))
    assert all(r["position"] == 4 and r["a.b"] == 5 for r in out)
    digest = {r.doc_id: r for r in hs.shard_digest(hs.shard_documents(df)).collect()}
    assert digest[7].size == 400_001 and digest[8].size == 1 and digest[8].text_crc32 == 0
    few = hs.shard_documents(df.limit(3)).collect()
    assert sorted(r.slot for r in few) == [0, 0, 0] and len({r.shard for r in few}) == 3
    empty = hs.shard_documents(df.where("false"))
    assert empty.count() == 0 and hs.shard_digest(empty).count() == 0


def test_query(spark):
    out = queries.op12_hilbert_shards(spark, SF).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in out) == sorted(docs)
    for r in out:
        body = (docs[r.doc_id].text or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (
            len(body) + 1, zlib.crc32(body), "rows", None)
    sizes = [sum(r.shard == s for r in out) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(r.slot for r in out if r.shard == s) == list(range(sizes[s]))
               for s in range(16))
