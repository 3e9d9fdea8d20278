"""The corpus pipeline, stage by stage, against its operators' brute-force twins."""

import re

import brute
import corpus_pipeline as P
from eventide.llm import packing

SF = "/root/testdata/sf0.001"


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in P.STAGES[:-1]:
        out = P.materialize(stage(spark, docs, SF), name)
        assert out.columns == list(P.COLUMNS)
        kept[name] = [(r.doc_id, r.text) for r in out.collect()]
        docs = out
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    first = dict(kept["quality_rules"])
    for d, t in rows.items():
        n, _, _, _, again = brute.rule_counts(t)
        if n < 50 or 100 * again > 50 * n:
            assert d not in first
    norm = {}
    for d, t in sorted(first.items()):
        norm.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), d)
    assert sorted(norm.values()) == sorted(d for d, _ in kept["exact_dedup"])
    comp = brute.near_components(kept["exact_dedup"])
    assert sorted(d for d, (_, c) in comp.items() if c == d) == sorted(
        d for d, _ in kept["near_duplicates"])
    mixed = [d for d, _ in kept["mix_sources"]]
    assert set(mixed) <= {d for d, _ in kept["near_duplicates"]}
    packed = P.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == set(mixed)
    assert len({(r.sequence_id, r.offset) for r in packed}) == len(packed)
    fill = {}
    for r in packed:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= packing.CAPACITY


def test_stages_on_edge_cases(spark):
    """Nulls in every column, empty and repeated rows, a further column; and an empty table."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, key string"
    good = "word and other words that follow on each other without any repeat at all " * 1
    text = " ".join(f"{w}{i}" for i in range(8) for w in good.split())
    rows = [(1, text, "en", "a", 10, "k"), (2, text + " end", None, None, None, None),
            (None, text, "en", "a", 10, "k"), (3, None, None, "b", None, "k"), (4, "", "", "", 0, ""),
            (1, text, "en", "a", 10, "k"), (5, "x " * 100_000, "en", "a", 1, "k")]
    df = spark.createDataFrame(rows, schema)
    for name, stage in P.STAGES:
        assert stage(spark, df.limit(0), SF).count() == 0
        out = stage(spark, df, SF)
        assert out.columns == list(P.COLUMNS) or name == "best_fit_packing"
        out.collect()
    kept = [r.doc_id for r in P.exact(spark, df, SF).collect()]
    assert sorted(kept) == [1, 1, 2, 3, 5]  # 3 and 4 are both empty; null equals 1
    near = [r.doc_id for r in P.near_duplicates(spark, df, SF).collect()]
    assert sorted(near) == [1, 1, 3, 4, 5]


def test_run_equals_stages(spark):
    a = sorted(map(tuple, P.run(spark, SF).select("doc_id", "piece", "start", "length",
                                                 "ids_crc32").collect()))
    docs = P.read_table(spark, SF, "documents")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
    assert a == sorted(map(tuple, docs.select("doc_id", "piece", "start", "length",
                                              "ids_crc32").collect()))
