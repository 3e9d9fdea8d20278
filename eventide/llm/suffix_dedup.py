"""Removal of repeated byte strings with distributed enhanced suffix arrays.

A byte goes when a string of ``least`` (100) bytes that covers it also starts earlier: in a
document of smaller id, or earlier in the same one. What repeats is found as maximal repeats:
nodes of a suffix array's common-prefix interval tree whose occurrences have diverse left
extensions; all occurrences but the earliest of each group are removed.

The corpus does not fit one suffix array, so suffixes are dealt to tasks such that all equal
100-byte strings meet. Every such string has an anchor: its 32-byte gram of smallest hash.
Neighbouring strings with the same anchor position form a piece of 100 to 168 bytes.

1. Scan: pieces of every text, by anchor. Equal pieces of one batch are settled there (all but
   the first are repeats); the first of each goes to the owner of its anchor's hash range as
   numbers (anchor, place, digest), not as text.
2. Owners settle equal pieces of different batches the same way. An anchor with one distinct
   piece left is done. The pieces of all others are named for fetching.
3. Only documents with such pieces are read again; the pieces' bytes go to the owner of the
   anchor, who builds an enhanced suffix array over them, scans its interval tree with a
   stack and emits the spans covered by groups with diverse left extensions. The preceding
   byte counts as unknown (so diverse) at a piece's start.
4. Spans of all tasks are merged per document and cut out.

An anchor with very many different pieces in a batch or in all (the edge of a passage that
a third of all documents quote) is hot: its pieces are cut into single 100-byte strings, which
are dealt by their own hash and settled by digests like equal pieces, those of a batch before
they are sent. So no task gets more than one copy of a string per batch.

Defined cases: null text is the empty text. Texts under 100 bytes lose nothing. Rows without
doc_id are as one document that comes last. Repeated rows of one id and text are the same
document (none repeats the other); if one id has different texts, spans found in any of them
are cut from each. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm import kernels as K
from eventide.llm.common import keep_maybe_present, materialize, presence_bitmap, texts
from eventide.llm.suffix_array import (covered_lengths, maximal_repeats, sorted_suffixes,
                                       suffix_rows)

LEAST = 100
GRAM = 32
#: Different pieces of one anchor in a batch, or in all batches, from which it is hot.
HOT_BATCH = 64
HOT_ALL = 4096
#: Suffixes sorted together in a task (groups of one anchor are not parted).
SUFFIXES = 80_000
#: Text bytes whose pieces are settled together before they are sent on.
SCAN_BLOCK = 4 << 20
_PLACE = 26  # low bits of an anchor code: its place in the chunk
_SEGMENT = 1 << (_PLACE - 1)  # longer texts are looked at in overlapping segments
_LAST = (1 << 63) - 1
_U = np.uint64
_SCAN = ("part int, kind int, doc long, keys binary, refs binary, docs binary, starts binary, "
         "lens binary, idents binary")
COVER, WHOLE, STRINGS, NUMBERS = 0, 1, 2, 3


def _sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    span = 1
    while span * 2 <= width:
        a = np.minimum(a[:-span], a[span:])
        span *= 2
    rest = width - span
    return np.minimum(a[:len(a) - rest], a[rest:]) if rest else a


def pieces(buf: np.ndarray, off: np.ndarray, least: int = LEAST, gram: int = GRAM
           ) -> tuple[np.ndarray, ...]:
    """doc, first byte, last string's start, anchor hash, digest of each piece of a chunk."""
    none = np.zeros(0, np.int64)
    if len(buf) < least:
        return none, none, none, none.astype(_U), none.astype(_U)
    pw, inv = K.powers(len(buf) + 1)
    acc = np.zeros(len(buf) + 1, _U)
    np.cumsum(K.BYTE_CODE[buf] * pw[:len(buf)], out=acc[1:], dtype=_U)
    g = K.mix64((acc[gram:] - acc[:-gram]) * inv[:len(buf) - gram + 1])
    code = (g & ~_U((1 << _PLACE) - 1)) | np.arange(len(g), dtype=_U)
    low = _sliding_min(code, least - gram + 1)  # one for each string start
    at = (low & _U((1 << _PLACE) - 1)).astype(np.int64)
    n_starts = len(at)
    valid = np.zeros(n_starts + 1, np.int64)
    size = np.diff(off)
    ok = size >= least
    np.add.at(valid, off[:-1][ok], 1)
    np.add.at(valid, off[1:][ok] - least + 1, -1)
    valid = np.cumsum(valid)[:n_starts] > 0
    new = np.empty(n_starts, bool)
    new[0] = True
    new[1:] = at[1:] != at[:-1]
    begin = off[:-1][ok]
    new[begin] = True
    s1 = np.flatnonzero(new & valid)
    edge = new.copy()
    edge[1:] |= ~valid[1:] & valid[:-1]
    stops = np.flatnonzero(edge)
    nxt = np.searchsorted(stops, s1, "right")
    s2 = np.where(nxt < len(stops), stops[np.minimum(nxt, len(stops) - 1)], n_starts) - 1
    doc = np.searchsorted(off, s1, "right") - 1
    # minima are small: mixed again, they spread evenly over the hash ranges
    anchor = K.mix64(g[at[s1]] + _U(0x9E3779B97F4A7C15))
    end = s2 + least
    # a second polynomial for the digest, so that it is independent of the anchor's
    np.cumsum(_CODE2[buf] * pw[:len(buf)], out=acc[1:], dtype=_U)
    ident = K.mix64((acc[end] - acc[s1]) * inv[s1] ^ ((end - s1).astype(_U) * K._SEQ[1]))
    return doc, s1 - off[doc], s2 - off[doc], anchor, ident


_CODE2 = K._table(4099)


def _segments(buf: np.ndarray, off: np.ndarray, least: int):
    """(buffer, offsets, added to a start) so that no buffer is longer than a segment."""
    if len(buf) <= _SEGMENT:
        yield buf, off, 0
        return
    for a in range(0, len(buf) - least + 1, _SEGMENT - least + 1):  # one long document
        part = buf[a:a + _SEGMENT]
        yield part, np.array([0, len(part)], np.int64), a


def _planes(values: np.ndarray, kind) -> bytes:
    v = np.ascontiguousarray(values.astype(kind))
    return np.ascontiguousarray(v.view(np.uint8).reshape(len(v), -1).T).tobytes()


def _unplanes(blob: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(width, -1).T).view(
        kind).ravel()


def _spans(*columns: np.ndarray) -> bytes:
    return np.stack([c.astype(np.int64) for c in columns], axis=1).tobytes()


def _by_doc(doc: np.ndarray, *columns: np.ndarray):
    """(doc, packed spans) for each document of parallel arrays."""
    order = np.argsort(doc, kind="stable")
    doc = doc[order]
    at = np.flatnonzero(K.first_of_runs(doc))
    packed = np.stack([c[order].astype(np.int64) for c in columns], axis=1)
    for a, b in zip(at, np.r_[at[1:], len(doc)]):
        yield int(doc[a]), packed[a:b].tobytes()


def _later(group_keys: tuple[np.ndarray, ...], doc: np.ndarray, start: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by the keys, then place; marks of each group's first place and of later places."""
    order = np.lexsort((start, doc, *group_keys[::-1]))
    new = np.zeros(len(order), bool)
    for k in group_keys:
        new |= K.first_of_runs(k[order])
    first = np.flatnonzero(new)[np.cumsum(new) - 1] if len(order) else order
    d, s = doc[order], start[order]
    later = (d != d[first]) | (s != s[first])
    return order, new, later


def _rows(schema: pa.Schema, n: int, **cols):
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(n, f.type)
         for f in schema], schema=schema)


_SCHEMA = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("doc", pa.int64())]
                    + [(n, pa.binary()) for n in ("keys", "refs", "docs", "starts", "lens",
                                                  "idents")])


def scan(docs: DataFrame, parts: int, least: int = LEAST) -> DataFrame:
    """For each batch and hash range the batch's distinct pieces as numbers; and per document
    what the batch settles itself (kind COVER) or declares hot (kind STRINGS)."""
    shift = _U(64 - parts.bit_length() + 1)

    def run(batches):
        for batch in K.blocks(batches, 1, SCAN_BLOCK):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            found = [[], [], [], [], []]
            with np.errstate(over="ignore"):
                for a, _, buf, off in K.chunks(batch.column(1)):
                    for part, poff, base in _segments(buf, off, least):
                        doc, s1, s2, anchor, ident = pieces(part, poff, least)
                        for col, v in zip(found, (ids[doc + a], s1 + base, s2 + base + least,
                                                  anchor, ident)):
                            col.append(v)
            if not found[0]:
                continue
            doc, s1, end, anchor, ident = (np.concatenate(c) for c in found)
            order, new, later = _later((anchor, ident), doc, s1)
            doc, s1, end, anchor, ident = (c[order] for c in (doc, s1, end, anchor, ident))
            out = [(d, COVER, b) for d, b in _by_doc(doc[later], s1[later], end[later])]
            doc, s1, end, anchor, ident = (c[new] for c in (doc, s1, end, anchor, ident))
            at = np.flatnonzero(K.first_of_runs(anchor))
            count = np.diff(np.r_[at, len(anchor)])
            hot = np.repeat(count > HOT_BATCH, count)
            out += [(d, STRINGS, b) for d, b in
                    _by_doc(doc[hot], s1[hot], end[hot], anchor[hot].view(np.int64))]
            if out:
                d, kind, blob = zip(*out)
                yield _rows(_SCHEMA, len(out), kind=kind, doc=d, keys=blob,
                            part=[x % parts for x in d])
            go = ~hot
            go[at] = True  # a hot anchor is told by one entry of length 0
            lens = np.where(hot, 0, end - s1 - least + 1)[go]
            doc, s1, anchor, ident = doc[go], s1[go], anchor[go], ident[go]
            bounds = np.searchsorted(anchor >> shift, np.arange(parts + 1, dtype=_U))
            full = [p for p in range(parts) if bounds[p + 1] > bounds[p]]
            cols = {n: [] for n in ("keys", "refs", "docs", "starts", "lens", "idents")}
            for p in full:
                r = slice(bounds[p], bounds[p + 1])
                table, ref = np.unique(doc[r], return_inverse=True)
                cols["keys"].append(K.pack_sorted(anchor[r]))
                cols["refs"].append(_planes(ref, np.uint32))
                cols["docs"].append(_planes(table, np.int64))
                cols["starts"].append(_planes(s1[r], np.uint32 if not len(s1[r]) or s1[r].max()
                                              < 1 << 32 else np.int64))
                cols["lens"].append(lens[r].astype(np.uint8).tobytes())
                cols["idents"].append(_planes(ident[r] >> _U(16), np.uint64))
            if full:
                yield _rows(_SCHEMA, len(full), part=full, kind=[NUMBERS] * len(full),
                            doc=[0] * len(full), **cols)

    return docs.mapInArrow(run, _SCAN)


_SETTLED = "doc long, kind int, spans binary"


def _settle(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one hash range: equal pieces settled, pieces to fetch named."""
    out = []
    local = pdf["kind"] != NUMBERS
    for d, k, b in zip(pdf["doc"][local], pdf["kind"][local], pdf["keys"][local]):
        out.append((int(d), int(k), b))
    cols = [[], [], [], [], []]
    for keys, refs, docs, starts, lens, idents in pdf.loc[~local, [
            "keys", "refs", "docs", "starts", "lens", "idents"]].itertuples(index=False):
        anchor = K.unpack_sorted(keys)
        wide = np.int64 if len(starts) == 8 * len(anchor) else np.uint32
        for col, v in zip(cols, (
                anchor, _unplanes(docs, np.int64)[_unplanes(refs, np.uint32)],
                _unplanes(starts, wide).astype(np.int64),
                np.frombuffer(lens, np.uint8).astype(np.int64), _unplanes(idents, np.uint64))):
            col.append(v)
    if cols[0]:
        anchor, doc, start, length, ident = (np.concatenate(c) for c in cols)
        # markers of hot anchors
        told = np.unique(anchor[length == 0])
        real = length > 0
        anchor, doc, start, length, ident = (c[real] for c in (anchor, doc, start, length, ident))
        order, new, later = _later((anchor, ident), doc, start)
        anchor, doc, start, length, ident = (c[order] for c in (anchor, doc, start, length, ident))
        end = start + length + LEAST - 1
        out += [(d, COVER, b) for d, b in _by_doc(doc[later], start[later], end[later])]
        anchor, doc, start, end = (c[new] for c in (anchor, doc, start, end))
        at = np.flatnonzero(K.first_of_runs(anchor))
        count = np.diff(np.r_[at, len(anchor)])
        hot = np.repeat((count > HOT_ALL) | np.isin(anchor[at], told), count)
        mixed = np.repeat(count > 1, count) & ~hot
        for kind, pick in ((WHOLE, mixed), (STRINGS, hot)):
            out += [(d, kind, b) for d, b in
                    _by_doc(doc[pick], start[pick], end[pick], anchor[pick].view(np.int64))]
    K.trim()
    return pd.DataFrame(out, columns=["doc", "kind", "spans"])


_FETCHED = "part int, kind int, doc long, spans binary, text binary"


def fetch(docs: DataFrame, wanted: DataFrame, parts: int, least: int = LEAST) -> DataFrame:
    """By hash range: the bytes of the pieces in ``wanted`` (doc, kind, spans) of kind WHOLE, and
    hashes of all strings of the pieces of kind STRINGS; and what a batch settles itself (kind
    COVER). The join never broadcasts, so its cost grows evenly with the input."""
    shift = _U(64 - parts.bit_length() + 1)
    per_doc = wanted.groupBy("doc").agg(
        F.collect_list(F.when(F.col("kind") == WHOLE, F.col("spans"))).alias("whole"),
        F.collect_list(F.when(F.col("kind") == STRINGS, F.col("spans"))).alias("strings"))
    keys = wanted.select(F.xxhash64("doc").alias("key"))
    bodies = keep_maybe_present(
        docs.select("doc_id", "text", F.xxhash64("doc_id").alias("key")), "key",
        presence_bitmap(keys, "key"))
    rows = bodies.join(per_doc.hint("merge"), F.col("doc_id") == F.col("doc")).select(
        "doc_id", F.encode("text", "utf-8").alias("body"), "whole", "strings")
    schema = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("doc", pa.int64()),
                        ("spans", pa.binary()), ("text", pa.binary())])

    def columns(blobs, size):
        """start, end, anchor of packed spans that lie within the text."""
        v = np.frombuffer(b"".join(blobs), np.int64).reshape(-1, 3)
        return v[v[:, 1] <= size]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = []
            whole, hashed, bodies, at = [], [], [], 0
            for doc, body, spans, strings in zip(*(c.to_pylist() for c in batch.columns)):
                b = np.frombuffer(body, np.uint8)
                v = columns(spans, len(b))
                if len(v):
                    whole.append(np.c_[np.full(len(v), doc), v, np.full(len(v), at)])
                    bodies.append(b)
                    at += len(b)
                v = columns(strings, len(b))
                if len(v):
                    n = v[:, 1] - v[:, 0] - least + 1
                    s = np.repeat(v[:, 0] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                    with np.errstate(over="ignore"):
                        h = K.span_hashes(b, s, s + least)
                        again = K.span_hashes(b ^ np.uint8(255), s, s + least)
                    hashed.append((np.full(len(s), doc), s, h, again))
            if hashed:
                # equal strings of the batch: only the first goes on
                doc, s, key, ident = (np.concatenate(c) for c in zip(*hashed))
                order, new, later = _later((key, ident), doc, s)
                rows += [(d % parts, COVER, d, x, None) for d, x in
                         _by_doc(doc[order][later], s[order][later], s[order][later] + least)]
                doc, s, key, ident = (c[order[new]] for c in (doc, s, key, ident))
                bounds = np.searchsorted(key >> shift, np.arange(parts + 1, dtype=_U))
                for p in np.flatnonzero(bounds[1:] > bounds[:-1]).tolist():
                    r = slice(bounds[p], bounds[p + 1])
                    rows.append((p, STRINGS, 0, b"".join((
                        _planes(doc[r], np.int64), _planes(s[r], np.int64),
                        _planes(ident[r], np.uint64))), K.pack_sorted(key[r])))
            if whole:
                v, body = np.concatenate(whole), np.concatenate(bodies)
                key = np.ascontiguousarray(v[:, 3]).view(_U)
                order = np.argsort(key, kind="stable")
                v, key = v[order], key[order]
                bounds = np.searchsorted(key >> shift, np.arange(parts + 1, dtype=_U))
                for p in np.flatnonzero(bounds[1:] > bounds[:-1]).tolist():
                    r = v[bounds[p]:bounds[p + 1]]
                    n = r[:, 2] - r[:, 1]
                    idx = np.repeat(r[:, 4] + r[:, 1] - (np.cumsum(n) - n), n) + np.arange(
                        int(n.sum()))
                    rows.append((p, WHOLE, 0, _spans(*r[:, :4].T), body[idx].tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            K.trim()

    return rows.mapInArrow(run, _FETCHED)


def repeat_spans(text: np.ndarray, doc: np.ndarray, start: np.ndarray, length: np.ndarray,
                 key: np.ndarray, least: int = LEAST) -> list[tuple[int, bytes]]:
    """Covered spans of the pieces (concatenated in ``text``), by document."""
    first = np.cumsum(length) - length
    order = np.argsort(key, kind="stable")
    starts_of = (length - least + 1)[order]
    total = np.cumsum(starts_of)
    new = np.flatnonzero(K.first_of_runs(key[order]))
    out_doc, out_s, out_e = [], [], []
    a = 0
    while a < len(order):
        # whole groups of a key, about SUFFIXES suffixes
        limit = (total[a - 1] if a else 0) + SUFFIXES
        b = int(np.searchsorted(total, limit, "right"))
        cut = new[np.searchsorted(new, max(b, a + 1), "right") - 1]
        if cut <= a:
            k = np.searchsorted(new, a, "right")
            cut = new[k] if k < len(new) else len(order)
        if b >= len(order):
            cut = len(order)
        pick = order[a:cut]
        a = int(cut)
        n = length[pick]
        width = int(n.max())
        padded = np.zeros((len(pick), 2 * width - least + 1), np.uint8)
        cols = np.arange(width)
        inside = cols[None, :] < n[:, None]
        padded[:, :width][inside] = text[(first[pick][:, None] + cols[None, :])[inside]]
        per = n - least + 1
        row = np.repeat(np.arange(len(pick)), per)
        at = np.arange(int(per.sum())) - np.repeat(np.cumsum(per) - per, per)
        suffixes = suffix_rows(padded, row, at, width)
        sa, lcp = sorted_suffixes(suffixes, n[row] - at)
        if not (lcp >= least).any():
            continue
        # only runs of suffixes that share the least length
        share = lcp >= least
        keep = share.copy()
        keep[:-1] |= share[1:]
        sa, lcp = sa[keep], np.where(share, lcp, 0)[keep]
        row, at = row[sa], at[sa]
        left = np.where(at > 0, padded[row, np.maximum(at, 1) - 1].astype(np.int64), -1)
        d, s = doc[pick][row], start[pick][row] + at
        rank = np.empty(len(d), np.int64)
        by_place = np.lexsort((s, d))
        same = np.r_[False, (d[by_place][1:] == d[by_place][:-1])
                     & (s[by_place][1:] == s[by_place][:-1])]
        rank[by_place] = np.cumsum(~same)
        cover = covered_lengths(maximal_repeats(lcp, left, least), rank)
        hit = cover > 0
        out_doc.append(d[hit])
        out_s.append(s[hit])
        out_e.append((s + cover)[hit])
    if not out_doc:
        return []
    return list(_by_doc(np.concatenate(out_doc), np.concatenate(out_s), np.concatenate(out_e)))


def _suffix_task(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one hash range: covered spans of the whole pieces (by their suffix array) and of the
    single strings (equal ones but the first), and what batches settled."""
    out = [(int(d), COVER, s) for d, s in pdf.loc[pdf["kind"] == COVER, ["doc", "spans"]]
           .itertuples(index=False)]
    whole = pdf[pdf["kind"] == WHOLE]
    if len(whole):
        spans = np.frombuffer(b"".join(whole["spans"]), np.int64).reshape(-1, 4)
        text = np.frombuffer(b"".join(whole["text"]), np.uint8)
        out += [(d, COVER, s) for d, s in repeat_spans(
            text, spans[:, 0], spans[:, 1], spans[:, 2] - spans[:, 1],
            np.ascontiguousarray(spans[:, 3]).view(_U))]
    single = pdf[pdf["kind"] == STRINGS]
    if len(single):
        cols = [[], [], [], []]
        for packed, keys in zip(single["spans"], single["text"]):
            key = K.unpack_sorted(keys)
            n = 8 * len(key)
            for col, v in zip(cols, (_unplanes(packed[:n], np.int64),
                                     _unplanes(packed[n:2 * n], np.int64), key,
                                     _unplanes(packed[2 * n:], np.uint64))):
                col.append(v)
        doc, s, key, ident = (np.concatenate(c) for c in cols)
        order, _, later = _later((key, ident), doc, s)
        doc, s = doc[order][later], s[order][later]
        out += [(d, COVER, x) for d, x in _by_doc(doc, s, s + LEAST)]
    K.trim()
    return pd.DataFrame(out, columns=["doc", "kind", "spans"])


def merged(blobs: list[bytes], size: int) -> np.ndarray:
    """Maximal runs covered by the packed (start, end) spans, within ``size`` bytes."""
    s = np.frombuffer(b"".join(blobs), np.int64).reshape(-1, 2)
    s = s[s[:, 1] <= size]
    if not len(s):
        return s
    s = s[np.argsort(s[:, 0], kind="stable")]
    reach = np.maximum.accumulate(s[:, 1])
    new = np.r_[True, s[1:, 0] > reach[:-1]]
    at = np.flatnonzero(new)
    return np.stack([s[at, 0], reach[np.r_[at[1:] - 1, len(s) - 1]]], axis=1)


def _parts(spark) -> int:
    want = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return 1 << max(4, (want - 1).bit_length())


def covered_spans(docs: DataFrame) -> DataFrame:
    """(doc, spans): packed (start, end) spans to remove, several rows per document."""
    parts = _parts(docs.sparkSession)
    settled = materialize(scan(docs, parts).groupBy("part").applyInPandas(_settle, _SETTLED),
                          "settled")
    found = (fetch(docs, settled.where(F.col("kind") != COVER), parts).groupBy("part")
             .applyInPandas(_suffix_task, _SETTLED))
    return (settled.where(F.col("kind") == COVER).select("doc", "spans")
            .unionByName(found.select("doc", "spans")))


_CUT = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        "spans array<struct<start:long,end:long>>, kept binary")


def remove_repeats(docs: DataFrame, with_kept: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept (the remaining bytes, null
    unless ``with_kept``): one row per input row."""
    base = texts(docs).select("doc_id", F.coalesce("doc_id", F.lit(_LAST)).alias("ord"), "text")
    keyed = base.select(F.col("ord").alias("doc_id"), "text")
    spans = materialize(covered_spans(keyed), "spans")
    touched = presence_bitmap(spans.select(F.xxhash64("doc").alias("key")), "key")
    probe = base.withColumn("key", F.xxhash64("ord"))
    none = F.expr("cast(array() as array<struct<start:long,end:long>>)")
    whole = keep_maybe_present(probe, "key", touched, absent=True).select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
        F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.sha2("text", 256).alias("kept_sha256"), none.alias("spans"),
        F.when(F.lit(with_kept), F.encode("text", "utf-8")).alias("kept"))
    per_doc = spans.groupBy("doc").agg(F.collect_list("spans").alias("spans"))
    rows = keep_maybe_present(probe, "key", touched).join(
        per_doc.hint("merge"), F.col("ord") == F.col("doc"), "left").select(
            "doc_id", F.encode("text", "utf-8").alias("body"), "spans")
    kind = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                      ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
                      ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                      ("kept", pa.binary())])

    def run(batches):
        for batch in batches:
            out = []
            for doc, body, blobs in zip(*(c.to_pylist() for c in batch.columns)):
                gone = merged(blobs or [], len(body)).tolist()
                keep, at = [], 0
                for s, e in gone:
                    keep.append(body[at:s])
                    at = e
                keep.append(body[at:])
                left = b"".join(keep)
                out.append((doc, len(body), len(body) - len(left), len(gone),
                            hashlib.sha256(left).hexdigest(),
                            [{"start": s, "end": e} for s, e in gone],
                            left if with_kept else None))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out), kind)], schema=kind)

    return whole.unionByName(rows.mapInArrow(run, _CUT))
