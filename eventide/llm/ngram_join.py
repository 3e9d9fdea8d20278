"""N-gram Jaccard join by vertical partitioning, and its near-duplicate components.

A text is the set of its distinct shingles of ``words`` words (A-Z lower-cased; with fewer words
the whole sequence is the one shingle). Two texts link when 100 * |intersection| >= ``percent`` *
|union|. op9's contract is four words and 85 (the defaults); the steps below are told with its 85.

1. Texts with the same word sequence are one class; only classes are compared.
2. A class with n shingles can miss at most n - ceil(0.85 n) of them in a partner. A hashed
   sample of all shingles (the same shingles for every text) is exchanged by hash range: a
   class of which more sampled shingles than that occur nowhere else has no partner and is
   done. The same test over all shingles follows for the few classes left.
3. What is left is put in the global order: shingles by (number of classes that have them,
   hash). Partners must share a shingle among the first n - ceil(0.85 n) + 1 of each.
4. Every shingle in such a prefix has a list of classes. Instead of all pairs of a list, each
   class is compared with the list's hub, its most central class (highest mean shingle
   frequency). Classes that link to it form components; pairs inside one component need no
   comparing. The overlaps with the hub bound all others: two classes share at most the smaller
   of their overlaps with the hub, plus the smaller of their numbers of shared shingles outside
   it. Only classes of different components that this bound lets link are compared: those
   outside a group's largest component with all others of the group (a group is a list's
   classes of two sizes).
5. Overlaps are counted by vertical partitioning: the global order is cut into fragments at
   fixed quantiles, each pair's partial overlap is counted per fragment, and summed per pair.

Nothing is sampled away: steps 2 and 3 only discard what cannot link. Hashes of 51 bits stand
for shingles within a pair, 64 bits for classes.

Defined cases: null and wordless texts have no shingles and link with nothing. Rows without
doc_id take part as the largest id and report component_id null only if all of the component
lack ids. Repeated rows are in one class. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm import kernels as K
from eventide.llm.common import (ROW_KEY, keep_maybe_present, materialize, presence_bitmap,
                                 row_key, texts)
from eventide.llm.components import connected_components

WORDS = 4
PERCENT = 85
FRAGMENTS = 8
#: One in so many shingles is looked at by the first test (a power of two).
SAMPLE = 4
#: Pairs for which a hub's segments are sent once: a hub with many pairs is read by several tasks.
HUB_PAIRS = 256
#: Bytes of text whose shingles, none left out, are one hash range.
RANGE_BYTES = 16 << 20
#: Prefix shingles by which a pair's list is chosen.
HEAD = 24
_LAST = (1 << 63) - 1
_U = np.uint64
_TOKEN = _U((1 << K.TOKEN_BITS) - 1)


def chunk_shingles(buf: np.ndarray, off: np.ndarray, k: int = WORDS
                   ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class hash and set size of every text; sorted distinct (text number, shingle) keys."""
    buf = K.FOLD[buf]
    starts, ends, per = K.word_spans(buf, off)
    words = K.span_hashes(buf, starts, ends)
    h, doc, _ = K.ngram_hashes(words, per, k)
    # the whole sequence: a polynomial over its words
    pw, inv = K.powers(len(words) + 1)
    acc = np.zeros(len(words) + 1, _U)
    np.cumsum(words * pw[:len(words)], out=acc[1:], dtype=_U)
    end = np.cumsum(per)
    seq = K.mix64((acc[end] - acc[end - per]) * inv[end - per] ^ (per.astype(_U) * K._SEQ[0]))
    short = np.flatnonzero((per > 0) & (per < k))
    keys = np.concatenate([K.keyed_by_doc(h, doc), K.keyed_by_doc(seq[short], short)])
    keys.sort()
    keys = keys[K.first_of_runs(keys)]
    n = np.bincount((keys >> _U(K.TOKEN_BITS)).astype(np.int64), minlength=len(per))
    return seq, n, keys


def _parts(docs: DataFrame, one_in: int) -> int:
    """Hash ranges of an exchange: a power of two, at least about twice the shuffle partitions,
    and so many that a range has the sampled shingles of about RANGE_BYTES of text."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    want = max(2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")),
               size // (RANGE_BYTES * one_in))
    return 1 << max(4, (want - 1).bit_length())


_SCAN = ("part int, doc_id long, cid long, n long, sampled long, shared long, tokens binary, "
         "refs binary, cids binary")


def scan(docs: DataFrame, parts: int, one_in: int, words: int = WORDS) -> DataFrame:
    """One row per text (part null): doc_id (and row_key if ``docs`` has it), class, set size,
    sampled shingles, and how many of these another class of the same batch has. One row per batch and hash range: the batch's
    distinct sampled shingles, each with its class, or with none if several have it."""
    shift = _U(K.TOKEN_BITS - parts.bit_length() + 1)
    keyed = ROW_KEY in docs.columns
    described = _SCAN + f", {ROW_KEY} binary" * keyed
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(),
             pa.binary(), pa.binary()] + [pa.binary()] * keyed
    names = [c.split()[0] for c in described.split(", ")]

    def rows(size, **cols):
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[c], t) if c in cols else pa.nulls(size, t)
             for c, t in zip(names, kinds)], names=names)

    def run(batches):
        for batch in K.blocks(batches, 1):
            ids = batch.column(0)
            own_keys = {ROW_KEY: batch.column(2)} if keyed else {}
            cids, sizes, toks, refs = [], [], [], []
            with np.errstate(over="ignore"):
                for a, _, buf, off in K.chunks(batch.column(1)):
                    seq, n, keys = chunk_shingles(buf, off, words)
                    tok = keys & _TOKEN
                    pick = (tok & _U(one_in - 1)) == 0
                    cids.append(seq)
                    sizes.append(n)
                    toks.append(tok[pick])
                    refs.append((keys[pick] >> _U(K.TOKEN_BITS)).astype(np.int64) + a)
            if not cids:
                continue
            cid, n = np.concatenate(cids), np.concatenate(sizes)
            tok, ref = np.concatenate(toks), np.concatenate(refs)
            sampled = np.bincount(ref, minlength=len(cid))
            # one text of each class goes on
            uniq, first, back = np.unique(cid, return_index=True, return_inverse=True)
            chosen = np.zeros(len(cid), bool)
            chosen[first] = True
            own = chosen[ref]
            tok, ref = tok[own], back[ref[own]]
            order = np.argsort(tok, kind="stable")
            tok, ref = tok[order], ref[order]
            new = K.first_of_runs(tok)
            at = np.flatnonzero(new)
            count = np.diff(np.r_[at, len(tok)])
            many = np.repeat(count > 1, count)
            shared = np.bincount(ref[many], minlength=len(uniq))
            yield rows(len(cid), doc_id=ids, cid=cid.view(np.int64), n=n, sampled=sampled,
                       shared=shared[back], **own_keys)
            tok, ref = tok[at], np.where(count > 1, -1, ref[at])
            bounds = np.searchsorted(tok >> shift, np.arange(parts + 1, dtype=_U))
            full = [p for p in range(parts) if bounds[p + 1] > bounds[p]]
            blobs = ([], [], [])
            for p in full:
                t, r = tok[bounds[p]:bounds[p + 1]], ref[bounds[p]:bounds[p + 1]]
                here, r2 = np.unique(r[r >= 0], return_inverse=True)
                r = r.copy()
                r[r >= 0] = r2 + 1
                r[r < 0] = 0
                blobs[0].append(K.pack_sorted(t))
                blobs[1].append(np.ascontiguousarray(
                    r.astype(np.uint32).view(np.uint8).reshape(-1, 4).T).tobytes())
                blobs[2].append(K.pack_sorted(np.sort(uniq[here])))
            if full:
                # classes are sorted, so their numbers ascend with them
                yield rows(len(full), part=full, tokens=blobs[0], refs=blobs[1], cids=blobs[2])

    return docs.mapInArrow(run, described)


def _hits(pdf: pd.DataFrame, parts: int) -> pd.DataFrame:
    """Of one hash range of shingles: how many of each class another class has too, in one row
    for each of ``parts`` hash ranges of classes."""
    toks, cids = [], []
    for t, r, c in zip(pdf["tokens"], pdf["refs"], pdf["cids"]):
        tok = K.unpack_sorted(t)
        ref = np.ascontiguousarray(np.frombuffer(r, np.uint8).reshape(4, -1).T).view(
            np.uint32).ravel().astype(np.int64)
        cid = np.r_[_U(0), K.unpack_sorted(c)] if len(c) else np.zeros(1, _U)
        toks.append(tok)
        cids.append((ref > 0, cid[ref]))
    tok = np.concatenate(toks)
    single = np.concatenate([s for s, _ in cids])
    cid = np.concatenate([c for _, c in cids])
    order = np.lexsort((cid, ~single, tok))
    tok, single, cid = tok[order], single[order], cid[order]
    new_tok = K.first_of_runs(tok)
    group = np.cumsum(new_tok) - 1
    new_pair = new_tok | np.r_[True, (cid[1:] != cid[:-1]) | (single[1:] != single[:-1])]
    classes = np.bincount(group[new_pair & single], minlength=group[-1] + 1)
    some_many = np.bincount(group[~single], minlength=group[-1] + 1) > 0
    shared = (classes > 1) | some_many
    hit = cid[new_pair & single & shared[group]]
    u, n = np.unique(hit, return_counts=True)
    bounds = np.searchsorted(u >> _U(65 - parts.bit_length()), np.arange(parts + 1, dtype=_U))
    full = [p for p in range(parts) if bounds[p + 1] > bounds[p]]
    cut = [slice(bounds[p], bounds[p + 1]) for p in full]
    return pd.DataFrame({"part": full, "cids": [K.pack_sorted(u[c]) for c in cut],
                         "hits": [n[c].astype(np.uint32).tobytes() for c in cut]})


def _sum_hits(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one hash range of classes: the hits from all ranges of shingles."""
    u, back = np.unique(np.concatenate([K.unpack_sorted(c) for c in pdf["cids"]]),
                        return_inverse=True)
    n = np.concatenate([np.frombuffer(h, np.uint32) for h in pdf["hits"]])
    return pd.DataFrame({"cid": u.view(np.int64),
                         "hits": np.bincount(back, n, minlength=len(u)).astype(np.int64)})


def _need(percent: int):
    """ceil(percent / 100 * n): the least overlap of a set of ``n`` with a partner."""
    return F.expr(f"({percent} * n + 99) div 100")


def may_link(docs: DataFrame, one_in: int, name: str, words: int = WORDS, percent: int = PERCENT
             ) -> tuple[DataFrame, DataFrame]:
    """(texts, classes): all rows of the scan, and (cid, rep) of the classes that may link."""
    parts = _parts(docs, one_in)
    scanned = materialize(scan(docs, parts, one_in, words), name)
    rows = scanned.where("part IS NULL").select(
        "doc_id", "cid", "n", "sampled", "shared", *[c for c in docs.columns if c == ROW_KEY])
    hits = (scanned.where("part IS NOT NULL").select("part", "tokens", "refs", "cids")
            .groupBy("part").applyInPandas(lambda pdf: _hits(pdf, max(16, parts // 8)),
                                           "part int, cids binary, hits binary")
            .groupBy("part").applyInPandas(_sum_hits, "cid long, hits long"))
    classes = rows.where("n > 0").groupBy("cid").agg(
        F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.max("sampled").alias("sampled"),
        F.max("shared").alias("shared"))
    found = F.coalesce("hits", F.lit(0)) + F.col("shared")
    missing = F.col("n") - _need(percent)
    left = classes.join(hits, "cid", "left").where(F.col("sampled") - found <= missing)
    return rows, left.select("cid", "rep")


def _reps(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Texts of the classes' representatives (with a few others, told apart by class later)."""
    keys = classes.select(F.xxhash64(F.coalesce("rep", F.lit(_LAST))).alias("key"))
    probe = docs.withColumn("key", F.xxhash64(F.coalesce("doc_id", F.lit(_LAST))))
    return keep_maybe_present(probe, "key", presence_bitmap(keys, "key")).select("doc_id", "text")


def _sets(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(cid, n, toks): every text's sorted distinct shingles."""
    def run(batches):
        for batch in batches:
            with np.errstate(over="ignore"):
                for _, _, buf, off in K.chunks(batch.column(1)):
                    seq, n, keys = chunk_shingles(buf, off, words)
                    tok = pa.array((keys & _TOKEN).view(np.int64))
                    offs = pa.array(np.r_[0, np.cumsum(n)].astype(np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(seq.view(np.int64)), pa.array(n.astype(np.int64)),
                         pa.ListArray.from_arrays(offs, tok)], names=["cid", "n", "toks"])
    return docs.mapInArrow(run, "cid long, n long, toks array<long>")


def _segments(sets: DataFrame, fragments: int, percent: int = PERCENT
              ) -> tuple[DataFrame, DataFrame]:
    """(prefixes, segments): (tok, cid, n, m, central, pos) for each prefix shingle and its place
    in the order, and (cid, frag, seg) with a class's shingles in each fragment of the global
    order."""
    toks = sets.select("cid", "n", F.explode("toks").alias("tok"))
    # written, so that the join can split a frequent shingle's rows over tasks
    df = materialize(toks.groupBy("tok").agg(F.count("*").alias("df")).where("df > 1"), "shared")
    common = materialize(toks.join(df, "tok"), "common")

    def place(df, tok):  # the order as one number: frequency, then hash
        return (df * F.lit(1 << 31) + F.shiftrightunsigned(tok, K.TOKEN_BITS - 31)).cast("double")

    steps = [i / fragments for i in range(1, fragments)]
    cuts = common.agg(F.percentile_approx(place(F.col("df"), F.col("tok")), steps).alias("p")
                      ).first()["p"] or []
    # one grouping by class: its shingles in the global order
    by_class = materialize(common.groupBy("cid", "n").agg(
        F.sum("df").alias("w"),
        F.sort_array(F.collect_list(F.struct("df", "tok"))).alias("order")), "ordered")
    m = F.size("order").cast("long")
    need = _need(percent)
    prefix = (by_class.select("*", m.alias("m"))
              .withColumn("p", (F.col("m") - need + 1).cast("int")).where("p > 0")
              .select("cid", "n", "m", (F.col("w") / F.col("n")).alias("central"),
                      F.posexplode(F.slice("order", F.lit(1), F.greatest("p", F.lit(0)))))
              .select(F.col("col.tok").alias("tok"), "cid", "n", "m", "central", "pos"))
    bounds = [float("-inf"), *cuts, float("inf")]

    def between(lo: float, hi: float):
        inside = F.filter("order", lambda e: (place(e["df"], e["tok"]) > F.lit(lo))
                          & (place(e["df"], e["tok"]) <= F.lit(hi)))
        return F.transform(inside, lambda e: e["tok"])

    pieces = [F.struct(F.lit(i).alias("frag"), between(lo, hi).alias("seg"))
              for i, (lo, hi) in enumerate(zip(bounds, bounds[1:]))]
    segments = by_class.select("cid", F.inline(F.array(*pieces))).where(F.size("seg") > 0)
    return materialize(prefix, "prefix"), materialize(segments, "segments")


def partial_overlaps(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """pairs (a, na, b, nb) with ``inter``, summed over the fragments. ``a`` may have very many
    pairs: its segments are replicated, once for about every HUB_PAIRS pairs, and its pairs are
    spread over the replicas."""
    pairs = materialize(pairs, "pairs")
    salts = materialize(pairs.groupBy("a").agg(
        F.ceil(F.count("*") / HUB_PAIRS).cast("int").alias("salts")), "salts")
    # both sides are written, so a hub's pairs are split over tasks here
    spread = pairs.join(salts, "a").withColumn(
        "salt", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int")).drop("salts")
    def of(side):  # segments of the classes on one side, and of a few others
        return keep_maybe_present(segments, "cid", presence_bitmap(pairs, side))

    right = of("b").select(F.col("cid").alias("b"), "frag", F.col("seg").alias("sb"))
    left = (of("a").select(F.col("cid").alias("a"), "frag", F.col("seg").alias("sa"))
            .join(salts, "a")
            .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
            .drop("salts"))
    partial = (spread.join(right, "b").join(left, ["a", "frag", "salt"])
               .select("a", "na", "b", "nb", F.size(F.array_intersect("sa", "sb")).alias("part")))
    return partial.groupBy("a", "na", "b", "nb").agg(F.sum("part").alias("inter"))


def _fits(na, nb, percent):
    return F.lit(100) * F.least(na, nb) >= F.lit(percent) * F.greatest(na, nb)


def _enough(overlap, na, nb, percent):
    """100 * overlap >= percent * union, for sets of na and nb with this overlap."""
    return F.lit(100 + percent) * overlap >= F.lit(percent) * (na + nb)


def class_links(prefix: DataFrame, segments: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b): links between classes that connect what is connected by all links."""
    hubs = (prefix.groupBy("tok").agg(F.max_by(F.struct("cid", "n"), F.struct("central", "cid"))
                                      .alias("hub"), F.count("*").alias("members"))
            .where("members > 1").select("tok", "hub.cid", "hub.n").toDF("tok", "a", "na"))
    hubs = materialize(hubs, "hubs")
    members = prefix.join(hubs, "tok")
    star = (members.where("a <> cid").where(_fits("na", "n", percent))
            .select("a", "na", F.col("cid").alias("b"), F.col("n").alias("nb")).distinct())
    star = materialize(partial_overlaps(star, segments), "star")
    links = star.where(_enough(F.col("inter"), F.col("na"), F.col("nb"), percent))
    comp = connected_components(links).withColumnRenamed("node", "cid")

    # what a list still has to compare: classes of different components. A class shares at most
    # ``o`` shingles with another inside the hub and ``e`` outside it.
    own = members.join(star.select("a", F.col("b").alias("cid"), "inter"), ["a", "cid"], "left")
    hub = F.col("cid") == F.col("a")
    own = own.join(comp, "cid", "left").select(
        "tok", "cid", "n", F.coalesce("comp", "cid").alias("comp"),
        F.when(hub, F.col("n")).otherwise(F.coalesce("inter", "n")).alias("o"),
        F.when(hub, 0).otherwise(F.coalesce(F.col("m") - F.col("inter"), "m")).alias("e"))
    sizes = (own.groupBy("tok").agg(F.collect_set("n").alias("sizes"),
                                    F.min("comp").alias("c1"), F.max("comp").alias("c2"))
             .where("c1 <> c2").select("tok", "sizes"))
    sizes = materialize(sizes, "list-sizes")  # again a frequent shingle's rows can be split
    # a group of a list: classes of two sizes, without those that the bound rules out for them
    most = F.col("o") + F.col("e")
    able = F.filter("sizes", lambda s: _fits("n", s, percent)
                    & _enough(most, F.col("n"), s, percent))
    groups = (own.join(sizes, "tok").withColumn("size", F.explode(able))
              .select("tok", F.least("n", "size").alias("s1"), F.greatest("n", "size").alias("s2"),
                      "cid", "n", "comp", "o", "e"))
    groups = materialize(groups, "groups")
    key = ["tok", "s1", "s2"]
    parts = groups.groupBy(*key, "comp").agg(F.count("*").alias("size"))
    major = (parts.groupBy(*key).agg(F.max_by("comp", F.struct("size", "comp")).alias("major"),
                                     F.count("*").alias("comps")).where("comps > 1"))
    open_ = groups.join(major.drop("comps"), key)
    # a class's first prefix shingles: a pair that has one of them in common is compared in the
    # list of the first such only (other pairs may turn up in several lists)
    heads = (prefix.where(F.col("pos") < HEAD).groupBy("cid")
             .agg(F.sort_array(F.collect_list(F.struct("pos", "tok"))).alias("h"))
             .select("cid", F.transform("h", lambda e: e["tok"]).alias("head")))
    open_ = materialize(open_.join(heads, "cid"), "open-groups")
    minor = open_.where("comp <> major").select(
        *key, *[F.col(c).alias(f"{c}2") for c in ("cid", "n", "comp", "o", "e", "head")])
    bound = F.least("o", "o2") + F.least("e", "e2")
    rest = (open_.join(minor, key)
            .where((F.col("comp") != F.col("comp2"))
                   & _enough(bound, F.col("n"), F.col("n2"), percent)
                   & (F.least("n", "n2") == F.col("s1")) & (F.greatest("n", "n2") == F.col("s2"))
                   & ((F.col("comp") == F.col("major")) | (F.col("cid") < F.col("cid2")))
                   & F.coalesce(F.get(F.array_intersect("head", "head2"), F.lit(0))
                                == F.col("tok"), F.lit(True)))
            .select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("cid2").alias("b"),
                    F.col("n2").alias("nb")).distinct())
    more = partial_overlaps(rest, segments).where(
        _enough(F.col("inter"), F.col("na"), F.col("nb"), percent))
    return materialize(links.select("a", "b").unionByName(more.select("a", "b")), "class-links")


def near_duplicates(docs: DataFrame, fragments: int = FRAGMENTS, words: int = WORDS,
                    percent: int = PERCENT, with_key: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id, class_id (and row_key if asked for): one row per input
    row."""
    docs = texts(docs)
    keys = [ROW_KEY] * with_key
    rows, first = may_link(
        docs.select("*", *[row_key(F.col("text")).alias(k) for k in keys]), SAMPLE, "sampled",
        words, percent)
    first = materialize(first, "first-classes")
    _, second = may_link(_reps(docs, first), 1, "shingled", words, percent)
    second = materialize(second.join(first.select("cid"), "cid"), "second-classes")
    sets = (_sets(_reps(docs, second), words).join(second.select("cid"), "cid")
            .dropDuplicates(["cid"]))
    prefix, segments = _segments(materialize(sets, "sets"), fragments, percent)
    comp = connected_components(class_links(prefix, segments, percent)).select(
        F.col("node").alias("cid"), F.col("comp"))
    meta = rows.select(F.coalesce("doc_id", F.lit(_LAST)).alias("ord"), "doc_id", "cid", "n",
                       *keys)
    own = F.when(F.col("n") > 0, F.coalesce("comp", "cid"))
    meta = materialize(meta.join(comp, "cid", "left").withColumn("comp", own), "meta")
    least = meta.where("n > 0").groupBy("comp").agg(F.min("ord").alias("least"))
    out = meta.join(least, "comp", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.nullif(F.coalesce("least", "ord"), F.lit(_LAST)).alias("component_id"),
                      F.col("cid").alias("class_id"), *keys)
