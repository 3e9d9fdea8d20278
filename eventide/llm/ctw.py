"""Language-model scoring by context-tree weighting over bytes.

The model: every byte is eight binary decisions (most significant bit first). For each of the
255 bit prefixes a context tree over the preceding bytes, up to DEPTH of them, mixes the
Krichevsky-Trofimov estimates of all depths with the weights of context-tree weighting:
Pw(s) = (Pe(s) + product of Pw(children)) / 2. Counts come from the training texts; the
weights they imply give fixed predictive probabilities, so a text's code length is a sum of
table look-ups. A text starts in a context of zero bytes and ends with a zero byte.

The tree holds every context of the training texts. Counts of byte strings (DEPTH + 1 bytes) are
added up in every batch before they are shuffled; strings whose contexts end in the same two
bytes are weighted in one task, about GRAMS_PER_PART strings each, and their sums for each last
byte (at most 256 x 255 rows) make the top of the tree on the driver. A second pass gives the
probability of every byte string that occurs in any text (``gram_scores``). Texts are scored by
look-ups: strings that occur often (at most FREQUENT_GRAMS, broadcast) in the task that reads the
text, all others by a join of their postings. Which strings these are changes no result.
``fit_model`` is the same tree cut to MAX_CONTEXTS contexts, as dense next-byte tables for callers
that want whole distributions; no score comes from it.

The base score is a smoothed unigram model over words. A text's base score needs the corpus
count of each of its words, so batches send postings (word, training count, texts) to the
owner of the word's hash range, who adds up each text's terms. Words that are frequent in a
hashed sample of the texts are counted before (at most FREQUENT of them, broadcast), so no
owner receives a posting for every text; which words these are changes no result.

Texts are lower-cased in A-Z. Training texts are those whose crc32(doc_id as text) mod FOLDS
is not HELD_OUT. Defined cases: null text is the empty text (one token, the end). Rows
without doc_id train. Repeated rows are separate texts. Without training texts N = V = 0, and
every byte costs 8 bits. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm import kernels as K
from eventide.llm.common import materialize, texts
from eventide.llm.qda import held_out

DEPTH = 5
MAX_CONTEXTS = 24_576
FOLDS, HELD_OUT = 7, 2
FREQUENT = 4096
#: One in so many texts tells which words are frequent.
SAMPLE = 64
#: Byte strings a task counts before it sends them on, about.
HELD_GRAMS = 2_000_000
#: Tokens whose postings one owner takes, about.
TOKENS_PER_PART = 8_000_000
#: Byte strings whose part of the tree one task weights, about.
GRAMS_PER_PART = 100_000
#: Byte strings whose scores are broadcast (12 bytes each); all others are joined.
FREQUENT_GRAMS = 1 << 19
_U = np.uint64
_REST = 256  # edge of the child that stands for all contexts that are not kept


def _lgamma(x: np.ndarray) -> np.ndarray:
    """log Gamma(x) for x >= 0.5 (Stirling's series after shifting x above 8)."""
    x = np.asarray(x, np.float64)
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        small = y < 8
        shift[small] -= np.log(y[small])
        y[small] += 1
    return shift + (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (
        360 * y ** 3) + 1 / (1260 * y ** 5)


_LOG_PI = math.log(math.pi)


def bit_counts(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones at each bit prefix 1..255 (heap order) from byte counts (rows x 256)."""
    total = np.empty((len(counts), 512))
    total[:, 256:] = counts
    for q in range(7, -1, -1):
        lo, hi = 1 << q, 2 << q
        total[:, lo:hi] = total[:, 2 * lo:2 * hi:2] + total[:, 2 * lo + 1:2 * hi:2]
    even = total[:, 2:512:2]
    odd = total[:, 3:512:2]
    return even, odd  # prefix q at column q - 1


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """log probability that the KT estimator gives a sequence with these counts."""
    return _lgamma(zeros + 0.5) + _lgamma(ones + 0.5) - _lgamma(zeros + ones + 1.0) - _LOG_PI


def byte_log10(p_one: np.ndarray) -> np.ndarray:
    """log10 probabilities of the 256 bytes (rows x 256) from those of a one at each prefix."""
    out = np.zeros((len(p_one), 256))
    sym = np.arange(256)
    for level in range(8):
        prefix = (256 + sym) >> (8 - level)
        bit = (sym >> (7 - level)) & 1
        p = p_one[:, prefix - 1]
        out += np.log10(np.where(bit, p, 1.0 - p))
    return out


class Subtree:
    """The context tree below one last byte: nodes with their counts and weights."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, kept: list[np.ndarray],
                 depth: int = DEPTH):
        """grams: context bytes (most recent lowest, above the byte itself in the low 8 bits);
        kept[d]: sorted contexts of d bytes, most recent byte lowest."""
        ctx = grams >> _U(8)
        self.parent, self.edge = [-1], [int(ctx[0] & _U(255))]
        node = np.zeros(len(grams), np.int64)
        alive = np.ones(len(grams), bool)
        levels = [np.array([0])]
        for d in range(2, depth + 1):
            suffix = ctx & _U((1 << 8 * d) - 1)
            pos = np.minimum(np.searchsorted(kept[d], suffix), max(len(kept[d]) - 1, 0))
            known = alive & (kept[d][pos] == suffix if len(kept[d]) else False)
            # nodes without a kept child stay leaves
            inner = np.zeros(len(self.parent), bool)
            inner[node[known]] = True
            go = alive & inner[node]
            edge = np.where(known, (suffix >> _U(8 * (d - 1))).astype(np.int64), _REST)
            key = node[go] * 512 + edge[go]
            uniq, back = np.unique(key, return_inverse=True)
            # a node with children has one for all other contexts too, seen or not
            base = len(self.parent)
            up = np.unique(uniq // 512)
            lone = np.setdiff1d(up, uniq[uniq % 512 == _REST] // 512)
            self.parent += (uniq // 512).tolist() + lone.tolist()
            self.edge += (uniq % 512).tolist() + [_REST] * len(lone)
            node = node.copy()
            node[go] = base + back
            alive = known
            levels.append(np.arange(base, len(self.parent)))
        self.parent, self.edge = np.array(self.parent), np.array(self.edge)
        n = len(self.parent)
        self.counts = np.zeros((n, 256))
        np.add.at(self.counts, (node, (grams & _U(255)).astype(np.int64)), counts)
        self.leaf = np.ones(n, bool)
        self.leaf[self.parent[1:]] = False
        self.levels = levels
        for level in reversed(levels[1:]):
            np.add.at(self.counts, self.parent[level], self.counts[level])
        self.zeros, self.ones = bit_counts(self.counts)
        self.pe = log_kt(self.zeros, self.ones)
        below = np.zeros_like(self.pe)
        self.pw = self.pe.copy()
        for level in reversed(levels):
            inner = level[~self.leaf[level]]
            self.pw[inner] = np.logaddexp(self.pe[inner], below[inner]) - math.log(2)
            up = level[self.parent[level] >= 0]
            np.add.at(below, self.parent[up], self.pw[up])

    def leaf_rows(self, first_acc: np.ndarray, first_weight: np.ndarray
                  ) -> tuple[np.ndarray, np.ndarray]:
        """Leaves and their byte table, given what the root contributes (acc) and leaves."""
        kt = (self.ones + 0.5) / (self.zeros + self.ones + 1.0)
        stop = np.where(self.leaf[:, None], 1.0, np.exp(self.pe - math.log(2) - self.pw))
        weight = np.zeros_like(kt)
        acc = np.zeros_like(kt)
        weight[0], acc[0] = first_weight, first_acc
        for i, level in enumerate(self.levels):
            if i:
                up = self.parent[level]
                acc[level] = acc[up] + weight[up] * stop[up] * kt[up]
                weight[level] = weight[up] * (1.0 - stop[up])
        leaves = np.flatnonzero(self.leaf)
        p = acc[leaves] + weight[leaves] * kt[leaves]
        return leaves, byte_log10(np.clip(p, 1e-12, 1 - 1e-12)).astype(np.float32)


class Model:
    """Byte tables by context: ``trans[d]`` (node * 256 + byte -> node) walks from a node of
    depth d to its child for an older byte, nodes that end earlier stay; ``table`` is indexed
    by final node * 256 + next byte."""

    def __init__(self, trans: list[np.ndarray], table: np.ndarray):
        self.trans, self.table = trans, table

    def log10(self, buf: np.ndarray) -> np.ndarray:
        """log10 probability of buf[DEPTH:], each byte in the context of the ones before."""
        n = len(buf) - DEPTH
        node = self.trans[0][buf[DEPTH - 1:DEPTH - 1 + n]].astype(np.int32)
        for d in range(1, DEPTH):
            node = self.trans[d][(node << 8) + buf[DEPTH - 1 - d:DEPTH - 1 - d + n]].astype(np.int32)
        return self.table[(node << 8) + buf[DEPTH:]]


def padded(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every text between DEPTH zero bytes and a closing zero byte; marks of the bytes that
    are coded; coded bytes per text."""
    size = np.diff(off)
    step = DEPTH + 1
    at = np.arange(len(buf)) + np.repeat(np.arange(len(size)) * step + DEPTH, size)
    out = np.zeros(len(buf) + step * len(size), np.uint8)
    out[at] = buf
    coded = np.zeros(len(out), bool)
    coded[at] = True
    coded[off[1:] + np.arange(len(size)) * step + DEPTH] = True
    return out, coded, size + 1


def _grams(low: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The byte string (DEPTH bytes of context, the oldest highest, and the byte) of every coded
    byte, text by text; strings per text."""
    full, coded, size = padded(low, off)
    g = np.zeros(max(len(full) - DEPTH, 0), _U)
    for i in range(DEPTH + 1):
        g = (g << _U(8)) | full[i:len(full) - DEPTH + i]
    return g[coded[DEPTH:]], size


_ENDS = 0x1F83D9ABFB41BD6B  # stands for the end token among word hashes


def _docs(docs: DataFrame) -> DataFrame:
    base = texts(docs)
    return base.select("doc_id", held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held"), "text")


def _words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, per = K.word_spans(buf, off)
    return K.span_hashes(buf, starts, ends), per


def frequent_words(rows: DataFrame) -> np.ndarray:
    """Sorted hashes of at most FREQUENT words that a hashed sample of texts has most."""
    def run(batches):
        for batch in batches:
            for _, _, buf, off in K.chunks(batch.column(0)):
                with np.errstate(over="ignore"):
                    words, _ = _words(K.FOLD[buf], off)
                u, n = np.unique(words, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n)],
                                                 names=["word", "n"])
    part = rows.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0).select("text")
    top = (part.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "word").limit(FREQUENT).toPandas())
    return np.sort(top["word"].to_numpy(np.int64).view(np.uint64))


def _added(counts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    key, back = np.unique(np.concatenate([k for k, _ in counts]), return_inverse=True)
    return key, np.bincount(back, np.concatenate([n for _, n in counts])).astype(np.int64)


def _counts(kind: int, key: np.ndarray, n: np.ndarray, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(key), kind, np.int32)), pa.array(key.view(np.int64)),
         pa.array(n.astype(np.int64))], names=names)


def count_training(rows: DataFrame, frequent) -> DataFrame:
    """(kind, key, n) added up: of training texts kind 0 byte strings of DEPTH + 1 bytes, kind 1
    counts of the frequent words, kind 2 tokens (key 0) and texts (key 1); kind 3 byte strings of
    held-out texts."""
    names = ["kind", "key", "n"]

    def run(batches):
        common = frequent.value
        words, tokens, n_docs = np.zeros(len(common), np.int64), 0, 0
        grams = {0: [], 3: []}
        for batch in batches:
            held = batch.column(1).to_numpy(zero_copy_only=False)
            for a, _, buf, off in K.chunks(batch.column(0)):
                low = K.FOLD[buf]
                with np.errstate(over="ignore"):
                    w, per = _words(low, off)
                out = held[a:a + len(per)]
                w = w[np.repeat(~out, per)]
                tokens += len(w) + int((~out).sum())
                n_docs += int((~out).sum())
                if len(common) and len(w):
                    pos = np.minimum(np.searchsorted(common, w), len(common) - 1)
                    words += np.bincount(pos[common[pos] == w], minlength=len(common))
                g, size = _grams(low, off)
                out = np.repeat(out, size)
                for kind, mine in ((0, ~out), (3, out)):
                    held_here = grams[kind]
                    held_here.append(np.unique(g[mine], return_counts=True))
                    if sum(len(k) for k, _ in held_here) > HELD_GRAMS:
                        grams[kind] = held_here = [_added(held_here)]
                        if len(held_here[0][0]) > HELD_GRAMS // 2:
                            yield _counts(kind, *held_here[0], names)
                            grams[kind] = []
        for kind, rest in grams.items():
            if rest:
                yield _counts(kind, *_added(rest), names)
        yield _counts(1, common, words, names)
        yield _counts(2, np.array([0, 1], _U), np.array([tokens, n_docs]), names)
    return (rows.select("text", "held").mapInArrow(run, "kind int, key long, n long")
            .groupBy("kind", "key").agg(F.sum("n").alias("n")).where("n > 0"))


def node_counts(grams: DataFrame, kept) -> DataFrame:
    """(last, depth, node, byte, key, n): counts added up by the kept context that a byte string
    ends in (``depth`` bytes, the last one always) and the coded byte; ``key`` is one of these
    strings and stands for all. ``kept``: broadcast sorted contexts by depth."""
    names = ["last", "depth", "node", "byte", "key", "n"]

    def run(batches):
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False)
            ctx = key.view(np.uint64) >> _U(8)
            node, depth = ctx & _U(255), np.ones(len(ctx), np.int32)
            known = np.ones(len(ctx), bool)
            for d in range(2, DEPTH + 1):
                if not len(kept.value[d]):
                    break
                suffix = ctx & _U((1 << 8 * d) - 1)
                pos = np.minimum(np.searchsorted(kept.value[d], suffix), len(kept.value[d]) - 1)
                known &= kept.value[d][pos] == suffix
                node, depth = np.where(known, suffix, node), np.where(known, d, depth)
            yield pa.RecordBatch.from_arrays(
                [pa.array((ctx & _U(255)).astype(np.int32)), pa.array(depth.astype(np.int32)),
                 pa.array(node.view(np.int64)), pa.array((key & 255).astype(np.int32)),
                 batch.column(0), batch.column(1)], names=names)

    ends = grams.select("key", "n").mapInArrow(
        run, "last int, depth int, node long, byte int, key long, n long")
    return ends.groupBy("last", "depth", "node", "byte").agg(
        F.min("key").alias("key"), F.sum("n").alias("n"))


def fit_model(grams: DataFrame) -> Model:
    """The weighted tree of the counted byte strings (key: oldest byte highest, the coded byte
    lowest; n)."""
    spark = grams.sparkSession
    ctx = F.expr("shiftrightunsigned(key, 8)")
    sizes = F.array(*[F.struct(F.lit(d).alias("d"), ctx.bitwiseAND(
        F.lit((1 << 8 * d) - 1)).alias("c")) for d in range(2, DEPTH + 1)])
    top = (grams.select(F.explode(sizes).alias("x"), "n").groupBy("x.d", "x.c")
           .agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "d", "c")
           .limit(MAX_CONTEXTS).toPandas())  # the bound of the model
    kept = [np.sort(top.loc[top["d"] == d, "c"].to_numpy(np.int64).view(np.uint64))
            for d in range(DEPTH + 1)]
    shared = spark.sparkContext.broadcast(kept)
    by_last = materialize(node_counts(grams, shared).select("last", "key", "n"), "node-counts")

    def subtree(pdf: pd.DataFrame) -> Subtree:
        pdf = pdf.sort_values("key")
        return Subtree(pdf["key"].to_numpy(np.int64).view(np.uint64),
                       pdf["n"].to_numpy(np.float64), shared.value)

    def weights(pdf: pd.DataFrame) -> pd.DataFrame:
        t = subtree(pdf)
        return pd.DataFrame({"last": [int(pdf["last"].iloc[0])], "pw": [t.pw[0].tobytes()],
                             "counts": [t.counts[0].tobytes()]})

    tops = by_last.groupBy("last").applyInPandas(
        weights, "last int, pw binary, counts binary").toPandas()  # at most 256 rows
    total = sum((np.frombuffer(c) for c in tops["counts"]), np.zeros(256))
    zeros, ones = bit_counts(total[None, :])
    pe = log_kt(zeros, ones)[0]
    below = sum((np.frombuffer(p) for p in tops["pw"]), np.zeros(255))
    stop = np.exp(pe - np.logaddexp(pe, below))
    acc = stop * ((ones + 0.5) / (zeros + ones + 1.0))[0]
    root = spark.sparkContext.broadcast((acc, 1.0 - stop))

    def tables(pdf: pd.DataFrame) -> pd.DataFrame:
        t = subtree(pdf)
        leaves, rows = t.leaf_rows(*root.value)
        table = [None] * len(t.parent)
        for leaf, row in zip(leaves, rows):
            table[leaf] = row.tobytes()
        return pd.DataFrame({"last": int(pdf["last"].iloc[0]), "node": np.arange(len(t.parent)),
                             "parent": t.parent, "edge": t.edge, "table": table})

    nodes = by_last.groupBy("last").applyInPandas(
        tables, "last int, node int, parent int, edge int, table binary").toPandas()
    return assemble(nodes, acc + (1.0 - stop) * 0.5)


def assemble(nodes: pd.DataFrame, unseen: np.ndarray) -> Model:
    """Transition tables from the subtrees' nodes; ``unseen``: probabilities of a one after a
    byte that no training text has."""
    nodes = nodes.sort_values(["last", "node"]).reset_index(drop=True)
    n = len(nodes) + 1  # one more: an unseen last byte
    first = {int(k): int(v) for k, v in nodes.groupby("last")["node"].size().cumsum().shift(
        fill_value=0).items()}
    parent, depth = np.full(n, -1), np.zeros(n, np.int64)
    edge = np.r_[nodes["edge"].to_numpy(np.int64), 0]
    if len(nodes):
        up = nodes["parent"].to_numpy()
        parent[:-1] = np.where(up >= 0, nodes["last"].map(first).to_numpy() + up, -1)
    for i in np.flatnonzero(parent >= 0):  # parents come first
        depth[i] = depth[parent[i]] + 1
    # shallow nodes get the small numbers, so the table of a depth has rows for these only
    order = np.argsort(depth, kind="stable")
    number = np.empty(n, np.int64)
    number[order] = np.arange(n)
    kind = np.uint16 if n <= 1 << 16 else np.int32
    trans = [np.full(256, number[n - 1], kind)]
    for last, i in first.items():
        trans[0][last] = number[i]
    for d in range(1, DEPTH):
        rows = int((depth < d).sum())
        t = np.repeat(np.arange(rows), 256).reshape(rows, 256)
        own = np.flatnonzero(depth == d)
        rest, byte = own[edge[own] == _REST], own[edge[own] != _REST]
        t[number[parent[rest]]] = number[rest][:, None]
        t[number[parent[byte]], edge[byte]] = number[byte]
        trans.append(t.astype(kind).ravel())
    table = np.zeros((n, 256), np.float32)
    table[number[n - 1]] = byte_log10(np.clip(unseen, 1e-12, 1 - 1e-12)[None, :])[0]
    for i, row in enumerate(nodes["table"]):
        if row is not None:
            table[number[i]] = np.frombuffer(row, np.float32)
    return Model(trans, table.ravel())


class Lower:
    """The tree below depth 1 of some byte strings, whole for each two last context bytes: a node
    is a context and a bit prefix. Strings with count 0 get nodes without counts, which weigh
    nothing and predict 1/2, as a context that was never seen does."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        byte = (grams & _U(255)).astype(np.int64)
        ctx = grams >> _U(8)
        rev = np.zeros(len(grams), _U)  # newest context byte highest
        for i in range(DEPTH):
            rev = (rev << _U(8)) | ((ctx >> _U(8 * i)) & _U(255))
        level = np.arange(8)[:, None]
        self.bit = (byte >> (7 - level)) & 1
        keys = ((rev << _U(8)) | ((256 + byte) >> (8 - level)).astype(_U)).ravel()
        ones, zeros = (self.bit * counts).ravel(), ((1 - self.bit) * counts).ravel()
        self.nodes, self.up = [], []  # from depth DEPTH to 2: (zeros, ones); rows in the next one
        for d in range(DEPTH, 0, -1):
            uniq, back = np.unique(keys, return_inverse=True)
            self.up.append(back)
            zeros = np.bincount(back, zeros, minlength=len(uniq))
            ones = np.bincount(back, ones, minlength=len(uniq))
            if d == 1:
                break
            self.nodes.append((zeros, ones))
            keys = ((uniq >> _U(16)) << _U(8)) | (uniq & _U(255))
        self.top, self.zeros, self.ones = uniq.astype(np.int64), zeros, ones  # last * 256 + prefix
        self.pe = [log_kt(z, o) for z, o in self.nodes]
        self.pw = [self.pe[0]]
        for i in range(1, len(self.nodes)):
            below = np.bincount(self.up[i], self.pw[-1], minlength=len(self.pe[i]))
            self.pw.append(np.logaddexp(self.pe[i], below) - math.log(2))
        self.below = np.bincount(self.up[-1], self.pw[-1], minlength=len(self.top))

    def log10(self, acc: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """log10 probability of every string's byte, given by last * 256 + prefix what the tree
        above contributes (acc) and leaves (weight)."""
        acc, weight = acc[self.top], weight[self.top]
        for i in range(len(self.nodes) - 1, -1, -1):
            zeros, ones = self.nodes[i]
            acc, weight = acc[self.up[i + 1]], weight[self.up[i + 1]]
            stop = np.exp(self.pe[i] - math.log(2) - self.pw[i]) if i else 1.0
            acc = acc + weight * stop * (ones + 0.5) / (zeros + ones + 1.0)
            weight = weight * (1.0 - stop)
        p = np.clip(acc[self.up[0]].reshape(self.bit.shape), 1e-12, 1 - 1e-12)
        return np.log10(np.where(self.bit, p, 1.0 - p)).sum(axis=0)


def gram_scores(grams: DataFrame) -> DataFrame:
    """(key, total, log10p) for byte strings (key; n in training texts, total in all): the
    probability of their last byte by the tree of all n."""
    spark = grams.sparkSession
    grams = materialize(grams, "grams")
    parts = grams.count() // GRAMS_PER_PART + 1
    dealt = grams.withColumn("part", F.pmod(F.xxhash64(
        F.expr("shiftright(key, 8) & 65535")), F.lit(parts)).cast("int"))

    def lower(pdf: pd.DataFrame) -> Lower:
        return Lower(pdf["key"].to_numpy(np.int64).view(_U), pdf["n"].to_numpy(np.float64))

    def tops(pdf: pd.DataFrame) -> pd.DataFrame:
        t = lower(pdf)
        return pd.DataFrame({"top": t.top, "zeros": t.zeros, "ones": t.ones, "below": t.below})

    sums = (dealt.groupBy("part").applyInPandas(
        tops, "top long, zeros double, ones double, below double").groupBy("top")
        .agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "below")])
        .toPandas())  # at most 256 x 255 rows
    zeros, ones, below = np.zeros((3, 256, 256))
    at = sums["top"].to_numpy(np.int64)
    for a, c in ((zeros, "zeros"), (ones, "ones"), (below, "below")):
        a.ravel()[at] = sums[c].to_numpy(np.float64)
    pe = log_kt(zeros, ones)
    pw = np.logaddexp(pe, below) - math.log(2)
    all_zeros, all_ones = zeros.sum(axis=0), ones.sum(axis=0)
    root = log_kt(all_zeros, all_ones)
    stop = np.exp(root - np.logaddexp(root, pw.sum(axis=0)))
    acc, weight = stop * (all_ones + 0.5) / (all_zeros + all_ones + 1.0), 1.0 - stop
    stop = np.exp(pe - math.log(2) - pw)
    above = spark.sparkContext.broadcast((
        (acc + weight * stop * (ones + 0.5) / (zeros + ones + 1.0)).ravel(),
        (weight * (1.0 - stop)).ravel()))

    def scores(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"key": pdf["key"], "total": pdf["total"],
                             "log10p": lower(pdf).log10(*above.value)})

    return materialize(dealt.groupBy("part").applyInPandas(
        scores, "key long, total long, log10p double"), "gram-scores")


def frequent_grams(scores: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and scores of the byte strings that occur most, at most FREQUENT_GRAMS: all
    above a number of occurrences, so that nothing is sorted."""
    level = F.floor(F.log2("total") * 8).cast("int")
    sizes = {r["level"]: r["n"] for r in scores.groupBy(level.alias("level")).agg(
        F.count(F.lit(1)).alias("n")).collect()}  # at most 8 x 63 rows
    least, held = 8 * 64, 0
    for x in sorted(sizes, reverse=True):
        held += sizes[x]
        if held > FREQUENT_GRAMS:
            break
        least = x
    top = scores.where(level >= least).select("key", F.col("log10p").cast("float")).toArrow()
    keys, logs = (top[c].to_numpy() for c in ("key", "log10p"))
    order = np.argsort(keys)  # 48 bits: never negative
    return keys[order].view(_U), logs[order]


_SCORED = ("gram long, tf int, part int, block long, doc_id long, held boolean, at int, n_tokens long, model double, "
           "base double, known long, words binary, counts binary, sizes binary, docs binary, "
           "tfs binary")


def _score_texts(rows: DataFrame, model, frequent, parts: int) -> DataFrame:
    """One row per text (its number in the block, and of frequent words and byte strings the terms
    and the score); one per block and hash range: postings of all other words; one per text and
    other byte string (gram): its occurrences (tf)."""
    shift = _U(64 - parts.bit_length() + 1)
    def looked_up(low, off, keys, logs):
        """Score per text, and (text, byte string, n) of strings that are not in the table."""
        g, size = _grams(low, off)
        uniq, back = np.unique(g, return_inverse=True)
        value, known = np.zeros(len(uniq)), np.zeros(len(uniq), bool)
        if len(keys):
            pos = np.minimum(np.searchsorted(keys, uniq), len(keys) - 1)
            known = keys[pos] == uniq
            value = np.where(known, logs[pos], 0.0).astype(np.float64)
        other = ~known[back]
        doc = np.repeat(np.arange(len(size)), size)[other]
        pair, n = np.unique(back[other].astype(np.int64) * len(size) + doc, return_counts=True)
        return (K.per_doc_sum(value[back], size), pair % len(size),
                uniq[pair // len(size)].view(np.int64), n)

    kinds = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(),
             "binary": pa.binary()}
    schema = pa.schema([(n, kinds[t]) for n, t in (c.split() for c in _SCORED.split(", "))])

    def rows_of(n, **cols):
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(n, f.type)
             for f in schema], schema=schema)

    def run(batches):
        for batch in K.blocks(batches, 2):
            m = model.value
            common, logs = frequent.value
            held = batch.column(1).to_numpy(zero_copy_only=False)
            block = int(np.random.default_rng().integers(1 << 62))
            score, words, doc, tokens, base, known = [], [], [], [], [], []
            for a, _, buf, off in K.chunks(batch.column(2)):
                low = K.FOLD[buf]
                with np.errstate(over="ignore"):
                    w, per = _words(low, off)
                sums, rare_doc, rare, n = looked_up(low, off, *m)
                score.append(sums)
                for i in range(0, len(rare), 100_000):
                    part = slice(i, i + 100_000)
                    yield rows_of(len(rare[part]), block=np.full(len(rare[part]), block),
                                  at=(rare_doc[part] + a).astype(np.int32), gram=rare[part],
                                  tf=n[part].astype(np.int32))
                tokens.append(per + 1)
                d = np.repeat(np.arange(len(per)), per)
                if len(common):
                    pos = np.minimum(np.searchsorted(common, w), len(common) - 1)
                    hit = common[pos] == w
                    terms = np.where(hit, logs[0][pos], 0.0)
                    base.append(np.bincount(d, terms, minlength=len(per)))
                    known.append(np.bincount(d, hit & (logs[1][pos] > 0), minlength=len(per)))
                    w, d = w[~hit], d[~hit]
                else:
                    base.append(np.zeros(len(per)))
                    known.append(np.zeros(len(per)))
                words.append(w)
                doc.append(d + a)
            n_docs = batch.num_rows
            yield rows_of(n_docs, block=np.full(n_docs, block), doc_id=batch.column(0),
                          held=batch.column(1), at=np.arange(n_docs, dtype=np.int32),
                          n_tokens=np.concatenate(tokens), model=np.concatenate(score),
                          base=np.concatenate(base),
                          known=np.concatenate(known).astype(np.int64))
            word, doc = np.concatenate(words), np.concatenate(doc)
            uniq, wid = np.unique(word, return_inverse=True)
            trained = np.bincount(wid[~held[doc]], minlength=len(uniq))
            pair, tf = np.unique(wid.astype(np.int64) * n_docs + doc, return_counts=True)
            wid, doc = pair // n_docs, pair % n_docs
            sizes = np.bincount(wid, minlength=len(uniq))
            bounds = np.searchsorted(uniq >> shift, np.arange(parts + 1, dtype=_U))
            at = np.r_[0, np.cumsum(sizes)][bounds]
            full = [p for p in range(parts) if bounds[p + 1] > bounds[p]]
            cut = [(slice(bounds[p], bounds[p + 1]), slice(at[p], at[p + 1])) for p in full]
            if full:
                yield rows_of(
                    len(full), part=full, block=np.full(len(full), block),
                    words=[K.pack_sorted(uniq[u]) for u, _ in cut],
                    counts=[trained[u].astype(np.uint32).tobytes() for u, _ in cut],
                    sizes=[sizes[u].astype(np.uint32).tobytes() for u, _ in cut],
                    docs=[doc[p].astype(np.uint16 if n_docs <= 1 << 16 else np.uint32).tobytes()
                          for _, p in cut],
                    tfs=[np.minimum(tf[p], (1 << 32) - 1).astype(np.uint32).view(np.uint8)
                         .reshape(-1, 4).T.tobytes() for _, p in cut])

    return rows.mapInArrow(run, _SCORED)


def _terms(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one hash range: each text's sum of log10(count + 1) and known tokens, as arrays per
    block; and the number of words with a training count (block -1)."""
    words = [K.unpack_sorted(w) for w in pdf["words"]]
    counts = [np.frombuffer(c, np.uint32).astype(np.int64) for c in pdf["counts"]]
    uniq, back = np.unique(np.concatenate(words), return_inverse=True)
    total = np.bincount(back, np.concatenate(counts), minlength=len(uniq))
    logs = np.log10(total + 1.0)
    out = [(-1, b"", int((total > 0).sum()), b"", b"")]
    at = 0
    for block, w, sizes, docs, tfs in zip(pdf["block"], words, pdf["sizes"], pdf["docs"],
                                          pdf["tfs"]):
        own = back[at:at + len(w)]
        at += len(w)
        n = np.frombuffer(sizes, np.uint32).astype(np.int64)
        postings = int(n.sum())
        wide = np.uint16 if len(docs) == 2 * postings else np.uint32
        doc = np.frombuffer(docs, wide).astype(np.int64)
        tf = np.ascontiguousarray(np.frombuffer(tfs, np.uint8).reshape(4, -1).T).view(
            np.uint32).ravel().astype(np.float64)
        word = np.repeat(own, n)
        size = int(doc.max()) + 1 if len(doc) else 0
        sums = np.bincount(doc, logs[word] * tf, minlength=size)
        known = np.bincount(doc, np.where(total[word] > 0, tf, 0), minlength=size)
        hit = np.flatnonzero(np.bincount(doc, minlength=size))
        out.append((int(block), hit.astype(np.uint32).tobytes(), 0, sums[hit].tobytes(),
                    known[hit].astype(np.uint32).tobytes()))
    return pd.DataFrame(out, columns=["block", "docs", "vocab", "sums", "known"])


_TERMS = "block long, docs binary, vocab long, sums binary, known binary"


def _block_terms(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one block: the sums of all hash ranges, by text."""
    doc = np.concatenate([np.frombuffer(d, np.uint32) for d in pdf["docs"]]).astype(np.int64)
    sums = np.concatenate([np.frombuffer(s) for s in pdf["sums"]])
    known = np.concatenate([np.frombuffer(k, np.uint32) for k in pdf["known"]])
    n = int(doc.max()) + 1 if len(doc) else 0
    return pd.DataFrame({"block": int(pdf["block"].iloc[0]), "at": np.arange(n, dtype=np.int32),
                         "terms": np.bincount(doc, sums, minlength=n),
                         "more": np.bincount(doc, known, minlength=n).astype(np.int64)})


def lm_scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per input
    row."""
    spark = docs.sparkSession
    rows = _docs(docs)
    common = frequent_words(rows)
    counted = materialize(count_training(rows, spark.sparkContext.broadcast(common)), "counts")
    # not the byte strings (kinds 0 and 3): at most FREQUENT + 2 rows
    small = {(r["kind"], r["key"]): r["n"] for r in counted.where("kind IN (1, 2)").collect()}
    tokens, n_docs = small.get((2, 0), 0), small.get((2, 1), 0)
    counts = np.array([small.get((1, int(k)), 0) for k in common.view(np.int64)], np.float64)
    scores = gram_scores(counted.where("kind IN (0, 3)").groupBy("key").agg(
        F.sum(F.when(F.col("kind") == 0, F.col("n")).otherwise(0)).alias("n"),
        F.sum("n").alias("total")))
    model = frequent_grams(scores)
    parts = 1 << max(4, (int(tokens * 1.2) // TOKENS_PER_PART).bit_length())
    shared = spark.sparkContext.broadcast(model)
    scored = materialize(_score_texts(
        rows, shared,
        spark.sparkContext.broadcast((common, (np.log10(counts + 1.0), counts))), parts), "scored")
    shared.destroy()
    del model
    K.trim()
    terms = materialize(scored.where("part IS NOT NULL").select(
        "part", "block", "words", "counts", "sizes", "docs", "tfs").groupBy("part").applyInPandas(
            _terms, _TERMS), "terms")
    rare = terms.agg(F.sum("vocab").alias("v")).first()["v"] or 0
    vocab = rare + int((counts > 0).sum()) + (1 if n_docs else 0)
    per_text = terms.where("block >= 0").groupBy("block").applyInPandas(
        _block_terms, "block long, at int, terms double, more long")
    each = math.log10(tokens + vocab + 1)
    other = (scored.where("gram IS NOT NULL").select("block", "at", F.col("gram").alias("key"), "tf")
             .join(scores.select("key", "log10p"), "key")
             .groupBy("block", "at").agg(F.sum(F.col("tf") * F.col("log10p")).alias("other")))
    own = scored.where("part IS NULL AND gram IS NULL").select("block", "at", "doc_id", "held", "n_tokens", "model",
                                              "base", "known")
    both = own.join(per_text, ["block", "at"], "left").join(other, ["block", "at"], "left")
    base = (F.col("base") + F.coalesce("terms", F.lit(0.0)) + F.lit(math.log10(n_docs + 1))
            - F.col("n_tokens") * F.lit(each))
    return both.select(
        "doc_id", F.col("held").alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0)) + F.lit(1 if n_docs else 0)).alias("n_known"),
        F.lit(int(tokens)).cast("long").alias("train_tokens"), base.alias("base_score"),
        (F.col("model") + F.coalesce("other", F.lit(0.0))).alias("score"))
