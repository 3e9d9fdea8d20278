"""Per-document statistics that the quality operators share.

``document_stats`` adds, for every row, the counts that rules are written in. One pass over
the text in Arrow tasks; nothing is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm import kernels as K
from eventide.llm.common import ROW_KEY, row_key

SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
          "n_bytes", "n_upper", "n_digits", "n_punct", "n_distinct_words", "n_adjacent",
          "n_ends", "n_bangs", "n_short_words", "n_long_words", "n_marked_words",
          "n_repeat_bigram_words", "max_word", "n_titled"]
_SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)


def _flags(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


_SYMBOL, _UPPER, _LOWER = _flags(SYMBOLS), _flags(bytes(range(65, 91))), _flags(bytes(range(97, 123)))
_DIGIT = _flags(b"0123456789")
_PUNCT = _flags(bytes(c for c in range(33, 127) if not chr(c).isalnum()))
_BANG, _END = _flags(b"!"), _flags(b".,;:?")
_CONT = np.zeros(256, bool)
_CONT[128:192] = True


def chunk_stats(buf: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each document of a chunk, by name."""
    n_docs = len(off) - 1
    starts, ends, per = K.word_spans(buf, off)
    doc = np.repeat(np.arange(n_docs), per)
    words = K.span_hashes(buf, starts, ends)
    cont = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(_CONT[buf], out=cont[1:])
    chars = (ends - starts) - (cont[ends] - cont[starts])
    out = {"n_words": per, "word_chars": K.per_doc_sum(chars, per), "n_bytes": np.diff(off)}
    for name, table in (("n_symbols", _SYMBOL), ("n_upper", _UPPER), ("n_digits", _DIGIT),
                        ("n_punct", _PUNCT), ("n_bangs", _BANG)):
        out[name] = K.bytes_sum(table[buf], off)

    # lines: cut at \n and at document ends; those with a word are compared by hash
    cuts = np.unique(np.r_[off[:-1], np.flatnonzero(buf == 10) + 1]) if len(buf) else off[:0]
    cuts = cuts[cuts < len(buf)]
    stops = np.r_[cuts[1:], len(buf)] if len(cuts) else cuts
    line_doc = np.searchsorted(off, cuts, "right") - 1
    stops = stops - ((stops > cuts) & (buf[np.maximum(stops, 1) - 1] == 10)) if len(cuts) else stops
    n_in = np.searchsorted(starts, stops) - np.searchsorted(starts, cuts)
    real = np.flatnonzero(n_in > 0)
    keys = K.keyed_by_doc(K.span_hashes(buf, cuts[real], stops[real]), line_doc[real])
    uniq = np.unique(keys)
    all_lines = np.bincount(line_doc[real], minlength=n_docs)
    out["n_lines"] = all_lines
    out["n_dup_lines"] = all_lines - np.bincount((uniq >> K._U(K.TOKEN_BITS)).astype(np.int64),
                                                 minlength=n_docs)

    for name, k in (("n_repeat_words", 3), ("n_repeat_bigram_words", 2)):
        h, d, at = K.ngram_hashes(words, per, k)
        marks = K.repeated_window_words(K.keyed_by_doc(h, d), at, k, len(words))
        out[name] = K.per_doc_sum(marks, per)

    uniq = np.sort(K.keyed_by_doc(words, doc))
    new = np.r_[True, uniq[1:] != uniq[:-1]] if len(uniq) else np.zeros(0, bool)
    out["n_distinct_words"] = np.bincount((uniq[new] >> K._U(K.TOKEN_BITS)).astype(np.int64),
                                          minlength=n_docs)
    same = np.zeros(len(words), bool)
    if len(words) > 1:
        same[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    out["n_adjacent"] = K.per_doc_sum(same, per)
    last = buf[ends - 1] if len(ends) else buf[:0]
    out["n_ends"] = K.per_doc_sum(_END[last], per)
    out["n_marked_words"] = K.per_doc_sum(_SYMBOL[last] | _BANG[last], per)
    first = buf[starts] if len(starts) else buf[:0]
    second = buf[np.minimum(starts + 1, len(buf) - 1)] if len(starts) else buf[:0]
    out["n_titled"] = K.per_doc_sum(_UPPER[first] & _LOWER[second], per)
    out["n_short_words"] = K.per_doc_sum(chars <= 2, per)
    out["n_long_words"] = K.per_doc_sum(chars >= 13, per)
    longest = np.zeros(n_docs, np.int64)
    np.maximum.at(longest, doc, chars)
    out["max_word"] = longest
    return out


def document_stats(docs: DataFrame, with_key: bool = False) -> DataFrame:
    """doc_id and COUNTS of every row (and its row_key if asked for); null text counts as empty."""
    key = [(ROW_KEY, pa.binary())] * with_key

    def run(batches):
        schema = pa.schema([("doc_id", pa.int64())] + [(c, pa.int64()) for c in COUNTS] + key)
        for batch in batches:
            for a, b, buf, off in K.chunks(batch.column(1)):
                with np.errstate(over="ignore"):
                    stats = chunk_stats(buf, off)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a)]
                    + [pa.array(stats[c].astype(np.int64)) for c in COUNTS]
                    + [batch.column(2).slice(a, b - a) for _ in key], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       *[row_key(F.col("text")).alias(ROW_KEY)] * with_key)
    return rows.mapInArrow(run, _SCHEMA + f", {ROW_KEY} binary" * with_key)


def features(counts: np.ndarray) -> np.ndarray:
    """Transformed statistics: logs of sizes, smoothed log-ratios of shares (columns of
    COUNTS in, one row per document)."""
    c = {name: counts[:, i].astype(np.float64) for i, name in enumerate(COUNTS)}

    def share(part, whole, a=0.5):
        return np.log((part + a) / (np.maximum(whole - part, 0) + a))

    words, chars = c["n_words"], c["word_chars"]
    return np.stack([
        np.log1p(words),
        np.log((chars + 1.0) / (words + 1.0)),
        share(c["n_symbols"], chars),
        share(c["n_dup_lines"], c["n_lines"]),
        share(c["n_repeat_words"], words),
        share(c["n_repeat_bigram_words"], words),
        share(c["n_upper"], chars),
        share(c["n_punct"], chars),
        share(c["n_distinct_words"], words),
        share(c["n_adjacent"], words),
        share(c["n_ends"], words),
        share(c["n_marked_words"], words),
        share(c["n_bangs"], words),
        share(c["n_short_words"], words),
        share(c["n_long_words"], words),
        share(c["n_titled"], words),
        share(c["n_digits"], chars),
        np.log1p(c["n_lines"]) - np.log1p(words),
        np.log1p(c["max_word"]),
    ], axis=1)


FEATURES = 19
