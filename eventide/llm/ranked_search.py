"""Ranked lexical search with the Best Position Algorithm.

Each query item has one list per term: the documents with the term in order of impact, the
term's share of the score. Lists are read from the top, all at the same depth (sorted access);
every document met there is looked up in the other lists of the item (direct access), which
gives its whole score and its position in each of those lists. The best position of a list is
the end of its longest seen prefix, whether a position was seen by reading or by look-up. No
document still unseen can score more than the sum of the impacts at the best positions, and
as best positions lie at or beyond the last positions read, this bound falls faster than that of
the threshold algorithm. Reading stops when the bound is strictly below the k-th score, so that
equal scores are still told apart by doc_id.

1. ``build_index``: one pass over the texts writes, for every document with a term, its length
   and its (query term, occurrences) pairs as Parquet in the shared folder.
2. ``corpus_counts``: number of documents, their terms, and documents per query term, added up
   per task and then over tasks.
3. ``search``: tasks read the index in blocks of bounded size, put each block's lists in impact
   order and run the algorithm for every item. A task keeps the best k of each item so far:
   the k-th score of earlier blocks stops later ones sooner. Per task at most k rows an item
   are sent on; a window per item ranks them.

Items are taken in blocks of ITEM_BYTES of text, so that terms and weights held by driver and
tasks are bounded whatever the number of items. Nothing about documents is broadcast. Documents
are split by position, not by term: the list of a very frequent term is spread over all tasks.

Terms are matched by 64-bit hashes of their bytes.

Defined results: a null or empty text has no terms, is counted in nothing and never returned;
texts of any length are indexed whole; repeated rows are separate documents and items; a null
doc_id comes after all others among equal scores; an item without terms, or without a match,
gives no rows; an empty table gives none. Other columns are not read, so their names cannot
clash.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm import kernels as kn
from eventide.llm.common import materialize, prepare

TOP = 10
#: Text of the items searched for together.
ITEM_BYTES = 4 << 20
#: Documents and (term, occurrences) pairs of a block of the index.
BLOCK_DOCS = 8192
BLOCK_PAIRS = 2 << 20
#: Positions read from each list in the first round; every round reads twice as many.
FIRST_DEPTH = 16

TERM_BYTE = np.zeros(256, bool)  # of [^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F] in UTF-8
for _lo, _hi in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    TERM_BYTE[_lo:_hi + 1] = True

INDEX_SCHEMA = "doc_id long, n long, terms array<int>, tfs array<int>"


def _terms_of(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, list]]:
    """Per chunk of texts: first document, terms per document, hashes, (bytes, starts, ends)."""
    for a, _, buf, off in kn.chunks(texts):
        starts, ends, per_doc = kn.mask_spans(TERM_BYTE[buf], off)
        folded = kn.FOLD[buf]
        yield a, per_doc, kn.span_hashes(folded, starts, ends), [folded, starts, ends]


class Items:
    """Query items: their terms (numbered by ascending hash) and occurrences."""

    def __init__(self, rows: list[tuple[int | None, str | None]]):
        self.ids = [r[0] for r in rows]
        text = pa.array([r[1] or "" for r in rows], pa.large_string())
        found: list[Counter] = [Counter() for _ in rows]
        for a, per_doc, hashes, _ in _terms_of(text):
            for i, h in zip(np.repeat(np.arange(len(per_doc)), per_doc) + a, hashes.tolist()):
                found[i][h] += 1
        self.hashes = np.array(sorted(set().union(*found)) if found else [], np.uint64)
        number = {h: i for i, h in enumerate(self.hashes.tolist())}
        self.terms = [np.array([number[h] for h in sorted(c)], np.int64) for c in found]
        self.times = [np.array([c[h] for h in sorted(c)], np.int64) for c in found]


def _index_fn(hashes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = np.int64(max(len(hashes), 1))
        for batch in kn.blocks(batches, 1):
            ids = batch.column(0)
            for a, per_doc, found, _ in _terms_of(batch.column(1)):
                at = np.searchsorted(hashes, found)
                at[at == len(hashes)] = 0
                hit = np.flatnonzero(hashes[at] == found) if len(hashes) else np.zeros(0, int)
                doc = np.repeat(np.arange(len(per_doc), dtype=np.int64), per_doc)
                pairs, tf = np.unique(doc[hit] * width + at[hit], return_counts=True)
                rows = np.flatnonzero(per_doc)
                ends = np.searchsorted(pairs, (rows + 1) * width)
                offsets = np.r_[0, ends].astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(rows + a)), pa.array(per_doc[rows].astype(np.int64)),
                    pa.ListArray.from_arrays(offsets, (pairs % width).astype(np.int32)),
                    pa.ListArray.from_arrays(offsets, tf.astype(np.int32))],
                    names=["doc_id", "n", "terms", "tfs"])
        kn.trim()
    return run


def build_index(docs: DataFrame, items: Items) -> DataFrame:
    """Length and query-term occurrences of every document with a term, as written."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return materialize(rows.mapInArrow(_index_fn(items.hashes), INDEX_SCHEMA), "search-index")


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the lengths of its lists."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    off = column.offsets.to_numpy()
    return column.values.to_numpy()[off[0]:off[-1]], np.diff(off)


def _count_fn(n_terms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_terms, np.int64)
        docs = length = 0
        for batch in batches:
            df += np.bincount(_flat(batch.column(1))[0], minlength=n_terms)[:n_terms]
            docs += batch.num_rows
            length += int(batch.column(0).to_numpy().sum())
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[-2, -1, used].astype(np.int32)),
             pa.array(np.r_[docs, length, df[used]].astype(np.int64))], names=["term", "n"])
    return run


def corpus_counts(index: DataFrame, items: Items) -> tuple[int, int, np.ndarray]:
    """(documents with a term, their terms, documents per query term)."""
    per_task = index.select("n", "terms").mapInArrow(_count_fn(len(items.hashes)),
                                                     "term int, n long")
    df = np.zeros(len(items.hashes), np.int64)
    docs = length = 0
    for r in per_task.groupBy("term").agg(F.sum("n").alias("n")).collect():
        if r["term"] == -2:
            docs = r["n"]
        elif r["term"] == -1:
            length = r["n"]
        else:
            df[r["term"]] = r["n"]
    return docs, length, df


class Block:
    """The impact lists of a block of documents, and the way into them by document."""

    def __init__(self, n: np.ndarray, terms: np.ndarray, tf: np.ndarray, per_doc: np.ndarray,
                 docs: int, length: int, weight: np.ndarray):
        self.size = np.int64(len(n))
        m = 100 - 75 + (75 * n * docs) // max(length, 1)
        doc = np.repeat(np.arange(len(n), dtype=np.int64), per_doc)
        impact = weight[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
        some = np.flatnonzero(impact)
        doc, term, impact = doc[some], terms[some].astype(np.int64), impact[some]
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.length = np.bincount(term, minlength=len(weight)).astype(np.int64)
        self.start = np.cumsum(self.length) - self.length
        # direct access: postings by (term, document), each with its position in its list
        keys = term[order] * self.size + self.doc
        by_key = np.argsort(keys)
        self.keys = keys[by_key]
        self.place = by_key

    def look_up(self, terms: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the list, posting) wherever one of ``docs`` is in the list of a term."""
        want = (terms[:, None] * self.size + docs[None, :]).ravel()
        at = np.searchsorted(self.keys, want)
        at[at == len(self.keys)] = 0
        hit = np.flatnonzero(self.keys[at] == want)
        return hit // len(docs), self.place[at[hit]]


def best_positions(block: Block, terms: np.ndarray, times: np.ndarray, top: "Top") -> int:
    """Offer to ``top`` every document of the block that can be among its best; returns how many
    documents were looked up."""
    there = block.length[terms] > 0
    terms, times = terms[there], times[there]
    if not len(terms):
        return 0
    start, length = block.start[terms], block.length[terms]
    base = np.cumsum(length) - length              # the lists' flags stand end to end
    seen_at = np.zeros(int(length.sum()), bool)
    own = np.arange(len(seen_at)) - np.repeat(base, length)
    seen = np.zeros(int(block.size), bool)
    depth, step, met = 0, FIRST_DEPTH, 0
    deepest = int(length.max())
    while depth < deepest:
        at = depth + np.arange(min(step, deepest - depth))
        valid = at[None, :] < length[:, None]
        seen_at[(base[:, None] + at[None, :])[valid]] = True
        docs = block.doc[(start[:, None] + at[None, :])[valid]]
        docs = np.unique(docs[~seen[docs]])
        if len(docs):
            met += len(docs)
            seen[docs] = True
            score = np.zeros(len(docs), np.int64)
            which, posting = block.look_up(terms, docs)
            seen_at[base[which] + posting - start[which]] = True
            np.add.at(score, np.searchsorted(docs, block.doc[posting]),
                      times[which] * block.impact[posting])
            top.offer(docs, score)
        depth += len(at)
        step *= 2
        # best position: the positions before the first unseen one
        prefix = np.minimum.reduceat(np.where(seen_at, deepest + 1, own), base)
        open_ = prefix < length
        bound = int((times[open_] * block.impact[start[open_] + prefix[open_] - 1]).sum())
        if bound < top.least():
            break
    return met


class Top:
    """The best k (score, doc_id) of an item so far."""

    def __init__(self, k: int):
        self.k = k
        self.best: list[tuple[int, bool, int]] = []
        self.ids: list[int | None] = []

    def least(self) -> int:
        """The k-th score; 1 below k documents (only scores above 0 count)."""
        return -self.best[-1][0] if len(self.best) == self.k else 1

    def offer(self, docs: np.ndarray, score: np.ndarray) -> None:
        good = np.flatnonzero(score >= self.least())
        new = [(-int(s), self.ids[d] is None, self.ids[d] or 0)
               for d, s in zip(docs[good], score[good])]
        if new:
            self.best = heapq.nsmallest(self.k, self.best + new)


def _search_fn(items: Items, docs: int, length: int, weight: np.ndarray, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = [Top(k) for _ in items.ids]

        def search(held: list[pa.RecordBatch]) -> None:
            table = pa.Table.from_batches(held)
            terms, per_doc = _flat(table.column("terms"))
            tf = _flat(table.column("tfs"))[0].astype(np.int64)
            block = Block(table.column("n").to_numpy().astype(np.int64), terms, tf, per_doc,
                          docs, length, weight)
            ids = table.column("doc_id").to_pylist()
            for term, times, top in zip(items.terms, items.times, tops):
                if len(term) and len(block.keys):
                    top.ids = ids
                    best_positions(block, term, times, top)

        held: list[pa.RecordBatch] = []
        rows = pairs = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            pairs += len(_flat(batch.column(2))[0])
            if rows >= BLOCK_DOCS or pairs >= BLOCK_PAIRS:
                search(held)
                held, rows, pairs = [], 0, 0
        if rows:
            search(held)
        out = [(i, items.ids[i], None if none else doc, -score)
               for i, top in enumerate(tops) for score, none, doc in top.best]
        columns = list(zip(*out)) if out else [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64(),
                                                            pa.int64()))],
            names=["item", "item_id", "doc_id", "score"])
        kn.trim()
    return run


def _item_blocks(queries: DataFrame, item_bytes: int) -> Iterator[list]:
    held, size = [], 0
    rows = queries.select(F.col("item_id").cast("long").alias("item_id"), "text")
    for r in rows.toLocalIterator():
        held.append((r["item_id"], r["text"]))
        size += len(r["text"] or "") + 64
        if size >= item_bytes:
            yield held
            held, size = [], 0
    if held:
        yield held


def _search_block(docs: DataFrame, rows: list, k: int) -> DataFrame:
    items = Items(rows)
    index = build_index(docs, items)
    n, length, df = corpus_counts(index, items)
    weight = np.floor(1000 * np.log((2.0 * n + 2) / (2.0 * df + 1))).astype(np.int64)
    found = index.mapInArrow(_search_fn(items, n, length, weight, k),
                             "item int, item_id long, doc_id long, score long")
    by_score = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))


def ranked_search(docs: DataFrame, queries: DataFrame, k: int = TOP,
                  item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The ``k`` best documents (doc_id, text) of every item (item_id, text) with their integer
    scores: item_id, rank (from 1), doc_id, score."""
    prepare(docs.sparkSession)
    out = None
    for n, rows in enumerate(_item_blocks(queries, item_bytes)):
        found = _search_block(docs, rows, k)
        if n:
            found = materialize(found, f"found-{n}")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = docs.sparkSession.createDataFrame(
            [], "item_id long, rank int, doc_id long, score long")
    return out


_TERMS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
docs AS (SELECT r, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM d WHERE len(terms) > 0),
total AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM docs),
postings AS (SELECT r, doc_id, n, term, count(*) AS tf
             FROM (SELECT r, doc_id, n, unnest(terms) AS term FROM docs) GROUP BY ALL),
items AS (SELECT i, item_id, term, count(*) AS times
          FROM (SELECT i, item_id, unnest(terms) AS term
                FROM (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS terms
                      FROM benchmark)) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE)
                                              / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
            FROM (SELECT term, count(*) AS df FROM postings
                  WHERE term IN (SELECT term FROM items) GROUP BY term), total),
scores AS (
  SELECT i, item_id, r, doc_id,
         CAST(sum(times * w * ((1000000000 * tf)
              // (1000 * tf + 8 * (25 + (75 * n * big_n) // big_l)))) AS BIGINT) AS score
  FROM items JOIN weights USING (term) JOIN postings USING (term), total GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank
           FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10"""
