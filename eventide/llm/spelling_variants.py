"""Grouping of spelling variants with a trie of frequency vectors.

The letters are dealt into GROUPS letter groups; a word's frequency vector counts its letters of
each group. One inserted, deleted or replaced code point adds at most one to one count and takes
at most one from another, so words at distance one are found without comparing texts: in a trie
that arranges words by their successive counts, a depth-first search from the word's own vector
may leave the word's counts once upwards (surplus) and once downwards (deficit). Only words at
the leaves reached are verified, code point by code point.

1. ``word_counts``: runs of letters of whole texts, counted per block of text and then over the
   corpus. A run whose hash with its doc_id falls in one of DROP_ONE classes loses a code point
   (the contract's planted variants).
2. ``_routes``: the trie's upper ``levels`` form branches, which are dealt over tasks. The part of
   the search that runs through the upper levels names the branches to visit and the budget
   left there; branches that do not exist are left out by a presence bitmap (4 MB at any input
   size). Of two neighbours only the one that spends its surplus first searches for the other,
   which halves the search; words with equal vectors find each other.
3. ``_search``: a task holds the trie of its branches' words and streams the words routed there
   through it, whole batches at a time; the stack holds (level, budget spent, words, nodes).
   It sends on, per word, the number of neighbours and the best one.
4. Forms from the greatest neighbour; roots by following forms with doubled steps. A form has ten
   times its word's occurrences, so the number of rounds is bounded by the logarithm of the
   logarithm of the greatest count.

Sizes: ``levels`` is the least depth at which no branch has more than BRANCH words, so that
tasks stay small as the vocabulary grows; a leaf beyond that is cut into blocks which every
word routed there visits. No text, word or pair reaches the driver, and a frequent word is one
row after counting.

Defined results: null and empty texts have no words; a null doc_id is read as an empty one; texts
and runs of any length are taken whole; repeated rows count as often as they occur; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm import kernels as kn
from eventide.llm.common import PRESENCE_BITS, materialize, prepare, presence_bitmap

LEAST_LENGTH = 7
LEAST_COUNT = 2
FORM_RATIO = 10
DROP_ONE = 31
#: Letters in groups of their own, in the order of the trie's levels; all other letters share
#: the last four levels.
SINGLE = "etaoinshrdlu"
GROUPS = len(SINGLE) + 4
#: Words of a branch of the trie, and of the trie of one task.
BRANCH = 50_000
PART = 200_000
#: Least depth of a branch.
LEVELS = 4
#: Words that are searched for together.
WORDS = 16_384

GROUP = np.zeros(256, np.int64)  # of a Latin-1 letter
GROUP[:] = len(SINGLE) + np.arange(256) % 4
for _i, _c in enumerate(SINGLE):
    GROUP[ord(_c)] = _i
_STEP = kn.mix64(np.arange(1, GROUPS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_CRC = np.zeros(256, np.uint32)
for _i in range(256):
    _r = _i
    for _ in range(8):
        _r = (_r >> 1) ^ (0xEDB88320 if _r & 1 else 0)
    _CRC[_i] = _r
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LEAD = 0xC3  # U+00C0 to U+00FF are this byte and one more


def _ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[i], start[i] + 1, ... (length[i] numbers) for every i, end to end."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(start - (ends - length), length)


def _strings(buf: np.ndarray, start: np.ndarray, length: np.ndarray) -> pa.Array:
    off = np.zeros(len(start) + 1, np.int64)
    np.cumsum(length, out=off[1:])
    data = buf[_ragged(start, length)]
    return pa.Array.from_buffers(pa.large_string(), len(start),
                                 [None, pa.py_buffer(off), pa.py_buffer(data)])


def _crc32(prefix: np.ndarray, buf: np.ndarray, start: np.ndarray, length: np.ndarray
           ) -> np.ndarray:
    """crc32 of the spans, each continued from its prefix' crc32."""
    reg = prefix.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    order = np.argsort(-length, kind="stable")
    ordered = length[order]
    long = int(np.searchsorted(-ordered, -64, "left"))  # few: one call each
    for i in order[:long]:
        whole = zlib.crc32(buf[start[i]:start[i] + length[i]].tobytes(), int(prefix[i]))
        reg[i] = whole ^ 0xFFFFFFFF
    short, ordered = order[long:], ordered[long:]
    for k in range(int(ordered[0]) if len(ordered) else 0):
        on = short[:int(np.searchsorted(-ordered, -k, "left"))]
        reg[on] = _CRC[(reg[on] ^ buf[start[on] + k]) & 0xFF] ^ (reg[on] >> np.uint32(8))
    return reg ^ np.uint32(0xFFFFFFFF)


def _count_fn(least: int, drop_one: int):
    def words_of(ids: list, texts: pa.Array) -> Iterator[pa.Array]:
        for a, b, buf, off in kn.chunks(texts):
            inside = _LETTER[buf] | (buf == _LEAD)
            inside[1:] |= buf[:-1] == _LEAD
            start, end, per_doc = kn.mask_spans(inside, off)
            doc = np.repeat(np.arange(len(per_doc)), per_doc)
            leads = np.zeros(len(buf) + 1, np.int64)
            np.cumsum(buf == _LEAD, out=leads[1:])
            points = end - start - (leads[end] - leads[start])
            some = np.flatnonzero(points >= least)
            if not len(some):
                continue
            start, length, points = start[some], (end - start)[some], points[some]
            folded = kn.FOLD[buf]
            prefix = np.array([zlib.crc32(f"{'' if i is None else i}:".encode())
                               for i in ids[a:b]], np.uint32)
            crc = _crc32(prefix[doc[some]], folded, start, length).astype(np.int64)
            drop = crc % drop_one == 0
            yield _strings(folded, start[~drop], length[~drop])
            changed = []
            for i in np.flatnonzero(drop & (points > least)):
                run = folded[start[i]:start[i] + length[i]].tobytes().decode()
                at = int(crc[i] % points[i])
                changed.append(run[:at] + run[at + 1:])
            if changed:
                yield pa.array(changed, pa.large_string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kn.blocks(batches, 1):
            tables = []
            for words in words_of(batch.column(0).to_pylist(), batch.column(1)):
                seen = pc.value_counts(words)
                tables.append(pa.table({"word": seen.field("values"), "n": seen.field("counts")}))
            if tables:
                table = pa.concat_tables(tables).group_by("word").aggregate([("n", "sum")])
                for out in table.rename_columns(["word", "n"]).select(["word", "n"]).cast(
                        pa.schema([("word", pa.string()), ("n", pa.int64())])
                        ).combine_chunks().to_batches():
                    yield out
        kn.trim()
    return run


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH,
                least_count: int = LEAST_COUNT, drop_one: int = DROP_ONE) -> DataFrame:
    """(word, n): every distinct word of at least ``least_length`` code points that occurs at
    least ``least_count`` times."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    counted = rows.mapInArrow(_count_fn(least_length, drop_one), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


class Words:
    """Words as Latin-1 codes end to end, with their frequency vectors (counts above 255 are
    255; what that hides is settled by the verification)."""

    def __init__(self, texts: pa.Array, n: np.ndarray):
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        self.texts = texts.cast(pa.large_string())
        self.n = n
        _, offsets, data = self.texts.buffers()
        off = np.frombuffer(offsets, np.int64)[self.texts.offset:
                                               self.texts.offset + len(self.texts) + 1]
        raw = (np.frombuffer(data, np.uint8)[off[0]:off[-1]] if len(off) > 1 and off[-1] > off[0]
               else np.zeros(0, np.uint8))
        lead = raw == _LEAD
        second = np.zeros(len(raw), bool)
        second[1:] = lead[:-1]
        kept = np.zeros(len(raw) + 1, np.int64)
        np.cumsum(~lead, out=kept[1:])
        self.codes = np.where(second, raw + np.uint8(0x40), raw)[~lead]
        ends = kept[off - off[0]]
        self.start, self.length = ends[:-1], np.diff(ends)
        rows = np.repeat(np.arange(len(self.length)), self.length)
        counts = np.bincount(rows * GROUPS + GROUP[self.codes],
                             minlength=len(self.length) * GROUPS)
        self.counts = np.minimum(counts, 255).astype(np.uint8).reshape(-1, GROUPS)

    def __len__(self) -> int:
        return len(self.length)

    def sums(self, levels: int) -> np.ndarray:
        """Linear hash of the first ``levels`` counts: a step up or down adds or takes one
        constant."""
        return (self.counts[:, :levels].astype(np.uint64) * _STEP[:levels]).sum(
            axis=1, dtype=np.uint64)


def place(sums: np.ndarray) -> np.ndarray:
    return kn.mix64(sums.copy()).view(np.int64)


def _differ(a: "Words", ai: np.ndarray, b: "Words", bi: np.ndarray, shift: int
            ) -> tuple[np.ndarray, np.ndarray]:
    """Which code points of words ``ai`` differ from those of ``bi`` (``shift`` further on), end
    to end, and where each pair begins."""
    length = a.length[ai]
    left = a.codes[_ragged(a.start[ai], length)]
    right = b.codes[_ragged(b.start[bi] + shift, length)]
    return left != right, np.cumsum(length) - length


def _insertion(a: "Words", ai: np.ndarray, b: "Words", bi: np.ndarray) -> np.ndarray:
    """b is a with one code point more: up to some place they agree, behind it b is one ahead."""
    length = a.length[ai]
    straight, begin = _differ(a, ai, b, bi, 0)
    ahead, _ = _differ(a, ai, b, bi, 1)
    at = np.arange(len(straight)) - np.repeat(begin, length)
    first = np.minimum.reduceat(np.where(straight, at, np.repeat(length, length)), begin)
    last = np.maximum.reduceat(np.where(ahead, at, -1), begin)
    return last < first


def distance_one(a: "Words", ai: np.ndarray, b: "Words", bi: np.ndarray) -> np.ndarray:
    """Marks the pairs of words that differ by exactly one code point (words are not empty)."""
    out = np.zeros(len(ai), bool)
    gap = b.length[bi] - a.length[ai]
    same = np.flatnonzero(gap == 0)
    if len(same):
        wrong, begin = _differ(a, ai[same], b, bi[same], 0)
        out[same] = np.add.reduceat(wrong.astype(np.int64), begin) == 1
    more = np.flatnonzero(gap == 1)
    if len(more):
        out[more] = _insertion(a, ai[more], b, bi[more])
    less = np.flatnonzero(gap == -1)
    if len(less):
        out[less] = _insertion(b, bi[less], a, ai[less])
    return out


class Trie:
    """Words below the roots (places of branches), by their counts from ``levels`` on.

    A level's nodes are numbered in order of (parent, count), so the child of a node with some
    count is found in the sorted array of these keys.
    """

    def __init__(self, words: Words, places: np.ndarray, levels: int):
        self.levels = levels
        order = np.lexsort([words.counts[:, k] for k in range(GROUPS - 1, levels - 1, -1)]
                           + [places])
        self.words, self.member = words, order
        self.roots = np.unique(places)
        node = np.searchsorted(self.roots, places[order])
        self.keys: list[np.ndarray] = []
        for k in range(levels, GROUPS):
            key = node * 256 + words.counts[order, k]
            new = kn.first_of_runs(key)
            self.keys.append(key[new])
            node = np.cumsum(new) - 1
        nodes = int(node[-1]) + 1 if len(node) else 0
        self.leaf = np.bincount(node, minlength=nodes)
        self.leaf_start = np.cumsum(self.leaf) - self.leaf

    def child(self, level: int, node: np.ndarray, count: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray]:
        """(which have such a child, the child)."""
        keys = self.keys[level - self.levels]
        want = node * 256 + count
        at = np.searchsorted(keys, want)
        at[at == len(keys)] = 0
        hit = np.flatnonzero(keys[at] == want)
        return hit, at[hit]

    def leaves(self, words: Words, places: np.ndarray, spent: np.ndarray
               ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Depth-first search of all words at once: (budget spent, words, leaves reached).

        ``spent``: 0 nothing, 1 the surplus, 2 surplus and deficit. The deficit alone is the
        other word's surplus.
        """
        at = np.searchsorted(self.roots, places)
        at[at == len(self.roots)] = 0
        there = self.roots[at] == places
        stack = []
        for s in (0, 1, 2):
            q = np.flatnonzero(there & (spent == s))
            stack.append((self.levels, s, q, at[q]))
        while stack:
            level, s, q, node = stack.pop()
            if not len(q):
                continue
            if level == GROUPS:
                yield s, q, node
                continue
            count = words.counts[q, level].astype(np.int64)
            hit, child = self.child(level, node, count)
            stack.append((level + 1, s, q[hit], child))
            if s < 2:
                can = np.flatnonzero(count < 255 if s == 0 else count > 0)
                hit, child = self.child(level, node[can], count[can] + (1 if s == 0 else -1))
                stack.append((level + 1, s + 1, q[can][hit], child))


def _depths_fn(depths: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words(batch.column(0), np.zeros(batch.num_rows, np.int64))
            for d in depths:
                at, n = np.unique(place(words.sums(d)), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), d, np.int32)), pa.array(at),
                     pa.array(n.astype(np.int64))], names=["depth", "place", "n"])
        kn.trim()
    return run


def _branches(vocabulary: DataFrame, branch: int) -> tuple[int, dict[int, int], np.ndarray]:
    """(levels, blocks of the branches beyond ``branch`` words, bits of the places that exist)."""
    depths = [*range(LEVELS, GROUPS, 2), GROUPS]
    sizes = (vocabulary.select("word").mapInArrow(_depths_fn(depths),
                                                  "depth int, place long, n long")
             .groupBy("depth", "place").agg(F.sum("n").alias("n")))
    sizes = materialize(sizes, "branches")
    most = {r["depth"]: r["n"] for r in sizes.groupBy("depth").agg(F.max("n").alias("n")).collect()}
    levels = next((d for d in depths if most.get(d, 0) <= branch), GROUPS)
    here = sizes.where(F.col("depth") == levels)
    large = {r["place"]: math.ceil(r["n"] / branch)
             for r in here.where(F.col("n") > branch).collect()}
    bits = np.zeros(PRESENCE_BITS // 8, np.uint8)
    for r in presence_bitmap(here, "place").collect():  # at most 4 MB
        bits[r["__slot"] * 4096:(r["__slot"] + 1) * 4096] = np.frombuffer(r["__bits"], np.uint8)
    return levels, large, bits


def _routes_fn(levels: int, large: dict[int, int], bits: np.ndarray):
    big = np.array(sorted(large), np.int64)
    blocks = np.array([large[int(p)] for p in big], np.int64)

    def exists(at: np.ndarray) -> np.ndarray:
        pos = at % PRESENCE_BITS
        return (bits[pos >> 3] >> (pos & 7).astype(np.uint8)) & 1 == 1

    def batch_of(batch: pa.RecordBatch, row, at, spent, member) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(np.broadcast_to(np.int8(spent), len(row)).copy()),
             pa.array(np.broadcast_to(member, len(row)).copy()),
             batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row))],
            names=["place", "spent", "member", "word", "n"])

    def dealt(batch, row, at, spent, own: bool) -> Iterator[pa.RecordBatch]:
        """Rows for a branch, or for every block of a large one (a member is in one of them)."""
        if len(big):
            k = np.searchsorted(big, at)
            k[k == len(big)] = 0
            cut = big[k] == at
            for i in np.flatnonzero(cut):
                times = blocks[k[i]]
                mine = int(row[i]) % times
                block = np.arange(times)
                places = place((np.full(times, at[i]).view(np.uint64)
                                + (block + 1).astype(np.uint64) * _STEP[0]))
                yield batch_of(batch, np.full(times, row[i]), places, spent,
                               (block == mine) & own)
            row, at = row[~cut], at[~cut]
        if len(row):
            yield batch_of(batch, row, at, spent, own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words(batch.column(0), np.zeros(batch.num_rows, np.int64))
            sums = words.sums(levels)
            every = np.arange(len(words))
            yield from dealt(batch, every, place(sums), 0, True)
            for up in range(levels):
                can = words.counts[:, up] < 255
                surplus = sums + _STEP[up]
                at = place(surplus)
                row = every[can & exists(at)]
                yield from dealt(batch, row, at[row], 1, False)
                for down in range(up + 1, levels):
                    at = place(surplus - _STEP[down])
                    row = every[can & (words.counts[:, down] > 0) & exists(at)]
                    yield from dealt(batch, row, at[row], 2, False)
        kn.trim()
    return run


def _best(owner: np.ndarray, n: np.ndarray, rank: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per owner: (owner, its number of neighbours, index of the best: greatest n, then least
    rank)."""
    order = np.lexsort((rank, -n, owner))
    first = np.flatnonzero(kn.first_of_runs(owner[order]))
    return owner[order][first], np.diff(np.r_[first, len(order)]), order[first]


def _ranks(words: Words) -> np.ndarray:
    """Places of the words in code-point order."""
    order = pc.sort_indices(words.texts).to_numpy()  # UTF-8 bytes sort like code points
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank


def _search_fn(levels: int):
    names = ["word", "n_near", "near", "near_n"]

    def rows(words: Words, owner, count, near: Words, best) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [words.texts.take(pa.array(owner)).cast(pa.string()), pa.array(count.astype(np.int64)),
             near.texts.take(pa.array(best)).cast(pa.string()), pa.array(near.n[best])],
            names=names)

    def pairs_of(trie: Trie, words: Words, places, spent
                 ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Verified (budget spent, words, members), some million code points at a time."""
        for s, q, node in trie.leaves(words, places, spent):
            size = trie.leaf[node]
            cost = np.cumsum(size * words.length[q])
            a = 0
            while a < len(q):
                limit = (int(cost[a - 1]) if a else 0) + (4 << 20)
                b = max(int(np.searchsorted(cost, limit, "right")), a + 1)
                who = np.repeat(q[a:b], size[a:b])
                whom = trie.member[_ragged(trie.leaf_start[node[a:b]], size[a:b])]
                good = distance_one(words, who, trie.words, whom)
                if good.any():
                    yield s, who[good], whom[good]
                a = b

    def search(trie: Trie, member_rank: np.ndarray, held: list[pa.RecordBatch]
               ) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        words = Words(table.column("word"), table.column("n").to_numpy())
        found = list(pairs_of(trie, words, table.column("place").to_numpy(),
                              table.column("spent").to_numpy()))
        if not found:
            return
        who = np.concatenate([f[1] for f in found])
        whom = np.concatenate([f[2] for f in found])
        yield rows(words, *_turn(_best(who, trie.words.n[whom], member_rank[whom]), whom,
                                 words, trie.words))
        # equal vectors are found from both sides, others only from this one
        back = np.concatenate([np.full(len(f[1]), f[0] > 0) for f in found])
        who, whom = who[back], whom[back]
        if len(who):
            yield rows(trie.words, *_turn(_best(whom, words.n[who], _ranks(words)[who]), who,
                                          trie.words, words))

    def _turn(best, other, words, near):
        owner, count, index = best
        return owner, count, near, other[index]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members: list[pa.RecordBatch] = []
        trie = rank = None
        held: list[pa.RecordBatch] = []
        size = 0

        def plant() -> None:
            nonlocal trie, rank
            table = pa.Table.from_batches(members)
            words = Words(table.column("word"), table.column("n").to_numpy())
            trie, rank = Trie(words, table.column("place").to_numpy(), levels), _ranks(words)

        for batch in batches:  # members come first
            if trie is None:
                of = batch.column(2).to_numpy(zero_copy_only=False)
                if of.all():
                    members.append(batch)
                    continue
                cut = int(of.sum())
                members.append(batch.slice(0, cut))
                if not sum(m.num_rows for m in members):
                    return  # words routed to branches that do not exist
                plant()
                for m in members:  # members are searched for like all others
                    yield from search(trie, rank, [m]) if m.num_rows else ()
                batch = batch.slice(cut)
            held.append(batch)
            size += batch.num_rows
            if size >= WORDS:
                yield from search(trie, rank, held)
                held, size = [], 0
        if trie is None and members:
            plant()
            for m in members:
                yield from search(trie, rank, [m])
        if size:
            yield from search(trie, rank, held)
        kn.trim()
    return run


NEAR_SCHEMA = "word string, n_near long, near string, near_n long"


def near_words(vocabulary: DataFrame, branch: int = BRANCH, part: int = PART) -> DataFrame:
    """Partial results of the search over ``vocabulary`` (word, n): rows of a word, a number of
    neighbours and the best of them; a word's rows add up to all its neighbours."""
    spark = vocabulary.sparkSession
    prepare(spark)
    levels, large, bits = _branches(vocabulary, branch)
    routes = vocabulary.select("word", "n").mapInArrow(
        _routes_fn(levels, large, bits),
        "place long, spent byte, member boolean, word string, n long")
    parts = max(math.ceil(vocabulary.count() / part),
                int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = routes.repartition(parts, "place").sortWithinPartitions(F.desc("member"))
    return dealt.mapInArrow(_search_fn(levels), NEAR_SCHEMA)


def word_forms(vocabulary: DataFrame, ratio: int = FORM_RATIO, branch: int = BRANCH,
               part: int = PART) -> DataFrame:
    """word, n, n_near, form, form_n for every word of ``vocabulary`` (word, n)."""
    none = F.lit(None)
    rows = near_words(vocabulary, branch, part).select(
        "word", none.cast("long").alias("n"), "n_near",
        F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")).alias("best"))
    own = vocabulary.select("word", "n", F.lit(0).cast("long").alias("n_near"),
                            none.cast("struct<less:long,near:string>").alias("best"))
    found = own.unionByName(rows).groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    frequent = -F.col("best.less") >= F.lit(ratio) * F.col("n")
    return found.select("word", "n", "n_near", F.when(frequent, F.col("best.near")).alias("form"),
                        F.when(frequent, -F.col("best.less")).alias("form_n"))


def roots_of(forms: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """(word, root) of the words that have a form: the last of their forms' forms.

    Every form occurs at least ``ratio`` times as often as its word, so a chain has at most
    log(greatest n) steps; each round doubles the steps taken.
    """
    links = materialize(forms.where("form IS NOT NULL").select(
        "word", F.col("form").alias("root"), "form_n"), "links")
    most = links.agg(F.max("form_n")).first()[0] or 1
    steps = max(1, math.ceil(math.log(most, ratio))) if ratio > 1 else 64
    links = links.drop("form_n")
    done = 1
    while done < steps:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        links = materialize(
            links.join(further.hint("merge"), "root", "left")
            .select("word", F.coalesce("__next", "root").alias("root")), "links")
        done *= 2
    return links


def spelling_variants(docs: DataFrame, least_length: int = LEAST_LENGTH,
                      least_count: int = LEAST_COUNT, ratio: int = FORM_RATIO,
                      drop_one: int = DROP_ONE, branch: int = BRANCH, part: int = PART
                      ) -> DataFrame:
    """Every word of ``docs`` (doc_id, text) with its form, root and neighbours: word, form,
    root, n, n_near, form_n."""
    prepare(docs.sparkSession)
    vocabulary = materialize(word_counts(docs, least_length, least_count, drop_one), "words")
    forms = materialize(word_forms(vocabulary, ratio, branch, part), "forms")
    out = forms.join(roots_of(forms, ratio).hint("merge"), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near",
                      "form_n")
