"""Vectorised text kernels used inside Arrow tasks.

Texts of an Arrow batch are looked at as one UTF-8 byte buffer with document offsets; words,
hashes and counts come from numpy passes over that buffer. Batches are cut into chunks of
about CHUNK bytes, so memory does not grow with the batch (a longer document is a chunk).
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of a chunk; documents are never cut.
CHUNK = 1 << 18
#: Documents of a chunk, so that a document's number fits in the 13 high bits of a key.
MAX_DOCS = 1 << 13
TOKEN_BITS = 51  # bits of a token hash beside the document number

_U = np.uint64
try:
    _libc = ctypes.CDLL("libc.so.6")
    _libc.malloc_trim  # noqa: B018 - absent in other C libraries
except (OSError, AttributeError):
    _libc = None
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift), in place."""
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _table(seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64((np.arange(1, 257, dtype=_U) + _U(seed)) * _U(0x9E3779B97F4A7C15))


BYTE_CODE = _table(0)
_P = 0x5851F42D4C957F2D  # odd, so that it has an inverse modulo 2^64
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^i and P^-i modulo 2^64 for i < n."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK + (CHUNK >> 1))
        out = []
        for base in (_P, pow(_P, -1, 1 << 64)):
            a = np.full(size, base, _U)
            a[0] = 1
            out.append(np.cumprod(a, dtype=_U))
        if n > CHUNK * 4:
            return out[0], out[1]
        _powers[:] = out
    return _powers[0], _powers[1]


#: Text bytes that are aggregated together before they are sent on.
BLOCK = 8 << 20


def trim() -> None:
    """Give freed memory back to the system: workers are kept for later tasks, and what they hold
    counts against the executor."""
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def blocks(batches: Iterator[pa.RecordBatch], column: int, block: int | None = None
           ) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in batches of about ``block`` (BLOCK) bytes in a text column (a
    longer text is one of its own)."""
    block = block or BLOCK
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        length = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        total = np.cumsum(length.to_numpy(zero_copy_only=False), dtype=np.int64)
        a = 0
        while a < batch.num_rows:
            done = int(total[a - 1]) if a else 0
            b = max(int(np.searchsorted(total, done + block - size, "right")), a)
            if b == a and not held:
                b = a + 1
            if b > a:
                held.append(batch.slice(a, b - a))
                size += int(total[b - 1]) - done
            a = b
            if a < batch.num_rows:
                yield _joined(held)
                held, size = [], 0
                trim()
    if held:
        yield _joined(held)
    trim()


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(held) == 1:
        return held[0]
    return pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def chunks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first document, last document + 1, bytes, document offsets) of each chunk."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    if not n:
        return
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset:texts.offset + n + 1]
    off = off.astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = int(np.searchsorted(off, off[a] + CHUNK, "right")) - 1
        b = min(max(b, a + 1), n, a + MAX_DOCS)
        yield a, b, buf[off[a]:off[b]], off[a:b + 1] - off[a]
        a = b


def word_spans(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and words per document of the runs of other than ASCII white space."""
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off) - 1, np.int64)
    space = SPACE[buf]
    inner = off[(off > 0) & (off < len(buf))]
    before = np.empty_like(space)
    before[0] = True
    before[1:] = space[:-1]
    before[inner] = True
    starts = np.flatnonzero(before & ~space)
    after = np.empty_like(space)
    after[-1] = True
    after[:-1] = space[1:]
    after[inner - 1] = True
    ends = np.flatnonzero(after & ~space) + 1
    return starts, ends, np.diff(np.searchsorted(starts, off))


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, equal for equal bytes wherever they stand."""
    pw, inv = powers(len(buf) + 1)
    acc = np.zeros(len(buf) + 1, _U)
    np.cumsum(BYTE_CODE[buf] * pw[:len(buf)], out=acc[1:], dtype=_U)
    h = (acc[ends] - acc[starts]) * inv[starts]
    return mix64(h ^ ((ends - starts).astype(_U) * _U(0x9E3779B97F4A7C15)))


_SEQ = (_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9),
        _U(0xD6E8FEB86659FD93))


def ngram_hashes(words: np.ndarray, per_doc: np.ndarray, k: int
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of every k consecutive words of a document, their document and first word."""
    total = len(words)
    first = np.cumsum(per_doc) - per_doc
    n = np.maximum(per_doc - (k - 1), 0)
    doc = np.repeat(np.arange(len(per_doc)), n)
    at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    if not len(at):
        return np.zeros(0, _U), doc, at
    h = np.zeros(max(total - k + 1, 0), _U)
    for i in range(k):
        h += words[i:total - k + 1 + i] * _SEQ[i % 4] + (words[i:total - k + 1 + i] >> _U(29 + i))
        h *= _U(0xFF51AFD7ED558CCD)
    return mix64(h)[at], doc, at


def keyed_by_doc(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Document number in the high bits, the hash's high bits below: sorts by document."""
    return (doc.astype(_U) << _U(TOKEN_BITS)) | (hashes >> _U(64 - TOKEN_BITS))


def repeated_window_words(keys: np.ndarray, at: np.ndarray, k: int, n_words: int) -> np.ndarray:
    """Marks the words that lie in a window of k words whose key occurs twice or more."""
    marks = np.zeros(n_words, bool)
    if len(keys) < 2:
        return marks
    order = np.sort(keys)
    dup = order[1:][order[1:] == order[:-1]]
    if not len(dup):
        return marks
    dup = dup[np.r_[True, dup[1:] != dup[:-1]]]
    # only windows of documents that have a repeat are looked up
    doc = (keys >> _U(TOKEN_BITS)).astype(np.int64)
    has = np.zeros(MAX_DOCS, bool)
    has[(dup >> _U(TOKEN_BITS)).astype(np.int64)] = True
    cand = np.flatnonzero(has[doc])
    pos = np.searchsorted(dup, keys[cand])
    pos[pos == len(dup)] = 0
    hits = at[cand[dup[pos] == keys[cand]]]
    for i in range(k):
        marks[hits + i] = True
    return marks


def per_doc_sum(values: np.ndarray, per_doc: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``per_doc`` values (runs may be empty)."""
    acc = np.zeros(len(values) + 1, np.int64 if values.dtype != np.float64 else np.float64)
    np.cumsum(values, out=acc[1:])
    end = np.cumsum(per_doc)
    return acc[end] - acc[end - per_doc]


def bytes_sum(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    acc = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=acc[1:])
    return acc[off[1:]] - acc[off[:-1]]


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending 64-bit values as byte planes of their differences (zero planes compress)."""
    if not len(values):
        return b""
    delta = np.empty_like(values)
    delta[0] = values[0]
    np.subtract(values[1:], values[:-1], out=delta[1:])
    return np.ascontiguousarray(delta.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack_sorted(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def first_of_runs(sorted_values: np.ndarray) -> np.ndarray:
    """Marks where a new value begins in a sorted array."""
    new = np.ones(len(sorted_values), bool)
    if len(new) > 1:
        new[1:] = sorted_values[1:] != sorted_values[:-1]
    return new


def mask_spans(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and number per document of the maximal runs of marked bytes."""
    if not len(inside):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off) - 1, np.int64)
    cuts = off[(off > 0) & (off < len(inside))]
    left = np.empty_like(inside)
    left[0] = True
    np.logical_not(inside[:-1], out=left[1:])
    left[cuts] = True
    right = np.empty_like(inside)
    right[-1] = True
    np.logical_not(inside[1:], out=right[:-1])
    right[cuts - 1] = True
    starts = np.flatnonzero(inside & left)
    ends = np.flatnonzero(inside & right) + 1
    return starts, ends, np.diff(np.searchsorted(starts, off))
