"""Cases in which an operator or a stage once did less than its whole job."""

import random

import brute
import corpus_pipeline as P
from eventide.llm import ctw, exact_dedup, line_windows, packing, queries, secret_scan

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _words(rng, n):
    return [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]


def _frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", None) for d, t in rows], SCHEMA).repartition(3)


def _first_of_components(rows, k, percent):
    """Rows that are the first of their near-duplicate component, from the definition."""
    sets = {}
    for d, t in rows:
        w = brute.words(brute.fold(t))
        sets[d] = {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))}
    up = {d: d for d in sets}

    def root(d):
        return d if up[d] == d else root(up[d])

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return sorted(d for d in sets if root(d) == d)


def test_pipeline_links_by_five_words_and_80_percent(spark):
    rng = random.Random(21)
    rows = []
    for n in (100, 300, 500):
        base = _words(rng, n)
        changed = list(base)
        for k in range(n // 45):  # 11 of 500: at 0.8 of five-word, under 0.85 of four-word shingles
            changed[20 + 40 * k] = f"new{n}x{k}"
        for text in (base, base + _words(rng, n // 5), changed, base + _words(rng, n // 3)):
            rows.append((len(rows), " ".join(text)))
    for n in (12, 40, 200):  # chains: each step changes one word in twelve to forty
        step = _words(rng, n)
        for _ in range(6):
            step[rng.randrange(n)] = f"step{rng.randrange(10 ** 6)}"
            rows.append((len(rows), " ".join(step)))
    want = _first_of_components(rows, 5, 80)
    assert want != _first_of_components(rows, 4, 85)
    got = P.near_duplicates(spark, _frame(spark, rows), SF).collect()
    assert sorted(r.doc_id for r in got) == want


def test_special_strings_are_one_id(spark):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.tokenizer_path())
    texts = ["hello <|endoftext|> world", "<|startoftext|>", "a<|endoftext|>b", "é<|startoftext|>É.",
             "end.<|endoftext|>, (<|startoftext|>)!", "<|endoftext|><|startoftext|>7x",
             "one\n<|startoftext|>\ttwo\u00a0<|endoftext|>\r\nthree", "<|ENDOFTEXT|> <|endoftext |>",
             "don<|endoftext|>'t <<|endoftext|>>"]
    rows = list(enumerate(texts))
    out = packing.tokenised_pieces(_frame(spark, rows), with_ids=True).collect()
    got = {r.doc_id: [int.from_bytes(r.ids[i:i + 4], "little") for i in range(0, len(r.ids), 4)]
           for r in out}
    assert got == {i: tok.encode(t, add_special_tokens=False).ids + [packing.END] for i, t in rows}
    assert got[0] == [3306, 49407, 1002, packing.END]


def test_rows_without_own_id_are_judged_alone(spark):
    """A row that goes takes no other row with its id, or without one, along."""
    rng = random.Random(8)
    a, b, c, d = (" ".join(_words(rng, 100)) for _ in range(4))
    poor = "the same " * 100
    rows = [(None, poor), (None, a), (1, poor), (1, b), (2, a), (3, c), (None, c + " end"), (4, d),
            (4, c + " tail"), (None, " ".join(_words(rng, 90)))]
    df = _frame(spark, rows)

    def kept(out):
        return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)

    def but(*gone):
        return sorted((r for k, r in enumerate(rows) if k not in gone), key=str)

    assert kept(P.quality_rules(spark, df, SF)) == but(0, 2)
    # the poor text stays with its least id, the copy without id goes
    assert kept(P.exact(spark, df, SF)) == but(0, 1)
    assert kept(P.near_duplicates(spark, df, SF)) == but(0, 1, 6, 8)
    small = _frame(spark, [(None, "abc"), (None, ""), (3, "abc")])
    assert kept(exact_dedup.exact_dedup(small)) == [(3, "abc"), (None, "")]


def test_lines_are_cut_from_their_own_text(spark):
    rows = [(1, "a\nb\nc"), (None, "a\nb\nc\nd"), (None, "p\nq\nr\ns"), (2, "x\na\nb\nc"),
            (2, "k\nl\nm\nn"), (None, "p\nq\nr\nt"), (1, "a\nb\nc")]
    got = sorted((str(r.doc_id), r.n_removed, r.text)
                 for r in line_windows.line_dedup(_frame(spark, rows)).collect())
    pair = [g for g in got if g[2] in ("s", "t", "p\nq\nr\ns", "p\nq\nr\nt")]
    assert sorted(g[1] for g in pair) == [0, 3]  # one of two equal windows stays
    assert [g for g in got if g not in pair] == [
        ("1", 0, "a\nb\nc"), ("1", 0, "a\nb\nc"), ("2", 0, "k\nl\nm\nn"), ("2", 3, "x"),
        ("None", 3, "d")]


def test_secrets_of_every_alphabet(spark):
    """Keys without digits, and of digits only, are found; words and regular strings are not."""
    rng = random.Random(13)
    lower, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    alphabets = (lower, lower.upper(), lower + lower.upper(), digits,
                 lower + lower.upper() + digits + "+/")
    rows = [(1000 * i + k, "key " + "".join(rng.choices(chars, k=rng.choice((24, 32, 48)))))
            for i, chars in enumerate(alphabets) for k in range(200)]
    rows += [(4200 + k, "key " + "".join(rng.choices(alphabets[2] + "+/", k=20)))
             for k in range(100)]
    plain = ["internationalization", "pneumonoultramicroscopicsilicovolcanoconiosis", "xyz" * 12,
             "-" * 40, "x" * 30, "1000000000000000000000000", "AAAABBBBCCCCDDDDEEEEFFFF"]
    rows += [(9000 + 10 * k + i, f"word {w} end") for i, w in enumerate(plain) for k in range(100)]
    out = secret_scan.scan_secrets(_frame(spark, rows)).collect()
    hit = {r.doc_id for r in out if r.random or r.hex}
    for i in range(len(alphabets)):
        own = [d for d, _ in rows if 1000 * i <= d < 1000 * i + 1000 and d < 9000]
        assert len(hit & set(own)) >= 0.97 * len(own), (alphabets[i], len(hit & set(own)), len(own))
    assert not [t for d, t in rows if d >= 9000 and d in hit]


def test_tree_tasks_get_counts_by_node(spark):
    """What a task weights is bounded by nodes x bytes and gives the tree of all byte strings."""
    import numpy as np
    rng = random.Random(6)
    rows = [(i, " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(60)))
            for i in range(40)]
    grams = ctw.count_training(ctw._docs(_frame(spark, rows)), spark.sparkContext.broadcast(
        np.zeros(0, np.uint64))).where("kind = 0").select("key", "n").toPandas()
    gram = grams.sort_values("key")
    ctx = gram["key"].to_numpy(np.int64).view(np.uint64) >> np.uint64(8)
    kept = [np.zeros(0, np.uint64)] * (ctw.DEPTH + 1)
    for d, most in ((2, 20), (3, 12), (4, 3)):
        c, n = np.unique(ctx & np.uint64((1 << 8 * d) - 1), return_counts=True)
        fits = c[np.isin(c & np.uint64((1 << 8 * (d - 1)) - 1), kept[d - 1])] if d > 2 else c
        kept[d] = np.sort(fits[np.argsort(-n[np.isin(c, fits)], kind="stable")][:most])
    got = ctw.node_counts(spark.createDataFrame(grams), spark.sparkContext.broadcast(kept)
                          ).toPandas().sort_values("key")
    lasts = len(np.unique(ctx & np.uint64(255)))
    assert len(got) <= (sum(map(len, kept)) + lasts) * 10 < len(gram) / 5
    for last, part in got.groupby("last"):
        mine = (ctx & np.uint64(255)) == last
        a = ctw.Subtree(gram["key"].to_numpy(np.int64).view(np.uint64)[mine],
                        gram["n"].to_numpy(float)[mine], kept)
        b = ctw.Subtree(part["key"].to_numpy(np.int64).view(np.uint64),
                        part["n"].to_numpy(float), kept)
        for x in ("parent", "edge", "counts", "pw", "leaf"):
            assert np.array_equal(getattr(a, x), getattr(b, x)), x


def test_mix_query_moves_whole_documents(spark, monkeypatch):
    written = []
    real = queries.materialize
    monkeypatch.setattr(queries, "materialize", lambda df, name: written.append(
        real(df, name)) or written[-1])
    out = queries.op7_poisson_mix(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert set(docs.columns) <= set(written[0].columns)
    text = {r.doc_id: r.text for r in docs.collect()}
    assert [r.shuffle_key for r in out] == sorted(r.shuffle_key for r in out)
    assert sorted((r.doc_id, r.copy) for r in out) == sorted(
        (r.doc_id, r.copy) for r in written[0].collect() if r.text == text[r.doc_id])
