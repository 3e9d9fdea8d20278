"""Spelling variants against the definition; the trie's search; edge cases."""

import random
import re
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest

from eventide.llm import queries, spelling_variants as sv

SF = "/root/testdata/sf0.001"
RUN = re.compile("[A-Za-zÀ-ÿ]+")
SCHEMA = "doc_id long, text string, word int, n string, root int"


def _frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(3)


def _counts(docs, least=7):
    out = Counter()
    for d, t in docs:
        for run in RUN.findall(t or ""):
            run = brute.fold(run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= least:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 2}


def _near(words):
    """Pairs at distance one: equal with a code point taken out, or with one left open."""
    holes, out = defaultdict(set), defaultdict(set)
    words = {w for w in words if len(w) < 10_000}  # longer ones of the tests have no neighbour
    for w in words:
        for i in range(len(w)):
            holes[w[:i] + "\0" + w[i + 1:]].add(w)
    for group in holes.values():
        for a in group:
            out[a] |= group - {a}
    for w in words:
        for i in range(len(w)):
            shorter = w[:i] + w[i + 1:]
            if shorter in words:
                out[w].add(shorter)
                out[shorter].add(w)
    return out


def _brute(counts):
    near, form = _near(counts), {}
    for w in counts:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), n, len(near[w]), counts.get(form[w]))
                  for w, n in counts.items())


def _run(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(9)
    stems = ["".join(rng.choices("etaoinshréÉzxq", k=rng.randint(7, 14))) for _ in range(300)]
    words = []
    for w in stems:
        n = rng.choice((1, 3, 40, 400))
        words += [w] * n
        for _ in range(6):  # variants of variants, so that chains arise
            i = rng.randrange(len(w))
            w = rng.choice((w[:i] + w[i + 1:], w[:i] + rng.choice("abcÿ") + w[i:],
                            w[:i] + rng.choice("etz") + w[i + 1:]))
            words += [w] * rng.choice((1, 2, 3, 30))
    rng.shuffle(words)
    return [(i // 50, " ".join(words[i:i + 50]).replace("z ", "Z, 7")) for i in
            range(0, len(words), 50)]


def test_equals_the_definition(spark, corpus):
    got = _run(sv.spelling_variants(_frame(spark, corpus)))
    want = _brute(_counts(corpus))
    assert got == want
    chains = [w for w, f, r, *_ in want if f is not None and r != f]
    assert chains and sum(x[4] for x in want) > 500


def test_small_branches_and_blocks_change_nothing(spark, corpus):
    """Deeper branches, and leaves cut into blocks, find the same pairs."""
    want = _run(sv.spelling_variants(_frame(spark, corpus)))
    for branch in (1, 3, 40):
        assert _run(sv.spelling_variants(_frame(spark, corpus), branch=branch, part=100)) == want


def test_trie_leaves_are_the_vectors_within_the_budget():
    rng = random.Random(2)
    texts = sorted({"".join(rng.choices("etaxyzbé", k=rng.randint(7, 9))) for _ in range(400)})
    words = sv.Words(pa.array(texts), np.ones(len(texts), np.int64))
    trie = sv.Trie(words, np.zeros(len(texts), np.int64), 0)
    got = {(q, m) for s, qs, nodes in trie.leaves(words, np.zeros(len(texts), np.int64),
                                                  np.zeros(len(texts), np.int8))
           for q, node in zip(qs.tolist(), nodes.tolist())
           for m in trie.member[trie.leaf_start[node]:trie.leaf_start[node] + trie.leaf[node]]}
    counts = words.counts.astype(int)
    want = set()
    for q in range(len(texts)):
        for m in range(len(texts)):
            d = counts[m] - counts[q]
            if np.clip(d, 0, None).sum() <= 1 and np.clip(-d, 0, None).sum() <= 1 and (
                    not d.any() or d[np.flatnonzero(d)[0]] == 1):
                want.add((q, m))
    assert got == want


def test_edges(spark):
    long, longest = "abcdefghij" * 200, "xyz" * 100_000
    docs = [(11, longest + " " + longest), (1, None), (2, ""), (None, "keyword keyword Keyword"), (None, "keywprd keywprd"),
            (3, "éclairage ÉCLAIRAGE éclairage Éclairage"), (3, "éclairage ÉCLAIRAGE"),
            (4, long + " " + long), (5, long[:-1] + "x " + long[:-1] + "x"),
            (6, long + "q " + long + "q"), (7, "sixsix sixsix sevenss sevenss sevens sevens"),
            (8, "a1b2c3d4 letters×letters lettersxletters lettersxletters"),
            (9, "letters×letters"), (10, "aaaaaaaa aaaaaaaa aaaaaaa aaaaaaa aaaaaaaaa aaaaaaaaa")]
    docs += [docs[3]] * 12
    got = _run(sv.spelling_variants(_frame(spark, docs)))
    assert got == _brute(_counts(docs))
    assert _run(sv.spelling_variants(_frame(spark, docs).where("false"))) == []
    assert _run(sv.spelling_variants(_frame(spark, docs[1:3]))) == []


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op13_spelling_variants(spark, SF)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert _run(got) == _brute(_counts(docs))
