"""Best-fit packing planned on the histogram of lengths.

Texts are tokenised; every text is its ids, then the end id 0. Texts longer than a sequence
are cut into full pieces and a rest. The plan looks only at how many pieces there are of each
length (at most ``capacity`` numbers): from the longest length down, pieces go to the open
sequences with the smallest room that still fits. Sequences with equal room are handled as
one group with a count, so planning takes a few thousand steps for any number of documents.
The plan is a list of slot ranges: pieces of this length with ranks from..to take these
sequences at this offset. Documents then take their slots by joining on rank within length.

Ranks are dense per length without gathering a length in one task: rows are numbered within
(length, salt), and the counts of all (length, salt) give each salt its offset.

Tokenisation looks at the distinct words (runs between spaces and newlines; the pre-tokeniser
never joins across white space) of an Arrow batch, at most about GROUP_BYTES of text, and puts
the texts' ids together from theirs. A word that is Latin letters and ASCII punctuation is what
the tokeniser's rules make of it, two pieces in lower case, so only its vocabulary model is
asked, JOINED pieces at a time; any other goes through all of it. Ids of pieces and other words
are cached per Python worker, at most CACHE of them and one batch's.
Ids are those of the tokeniser's default call without added special tokens, so a special
token's string in a text is that token's one id.

Defined cases: null text is the empty text, one piece that is the end id alone. Rows without
doc_id are packed too. Repeated rows are packed as often as they occur. An empty table gives
no sequence. Extra columns are ignored.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm import kernels as K
from eventide.llm.common import materialize, texts

CAPACITY = 2048
END = 0
SALTS = 256
#: Pieces of words whose ids a worker remembers.
CACHE = 800_000
#: Text tokenised together; a longer text is one of its own.
GROUP_BYTES = 8 << 20
#: Pieces of words the vocabulary model is asked for together.
JOINED = 256
#: Words whose ids are put together at once.
GATHERED = 1 << 20


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


#: Letters that are in composed form already and lower-case one by one (not U+0130), then
#: punctuation (a run of it is one piece).
PLAIN = (r"^(?P<body>[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{17F}]+)"
         r"(?P<tail>[!-/:-@\[-`{-~]*)$")


def _byte_letters() -> dict[int, int]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for the
    characters from U+0100 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {b: b for b in own} | {b: 256 + i for i, b in enumerate(rest)}


class WordEncoder:
    """Ids of texts, as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit
        self.tok = Tokenizer.from_file(path)
        self.joined = Tokenizer(self.tok.model)
        self.joined.pre_tokenizer = WhitespaceSplit()
        self.letters = _byte_letters() | {32: 32}
        self.ids: dict[str, bytes] = {"": b""}

    def _learn(self, pieces: list[str]) -> None:
        """Put the ids of pre-tokens that need no normalising into the cache."""
        for i in range(0, len(pieces), JOINED):
            part = pieces[i:i + JOINED]
            text = " ".join(part)
            if not text.isascii():
                text = text.encode().decode("latin-1").translate(self.letters)
            e = self.joined.encode(text, add_special_tokens=False)
            ids = np.array(e.ids, "<u4").tobytes()
            end = 4 * np.cumsum(np.bincount(e.word_ids, minlength=len(part)))
            at = 0
            for piece, to in zip(part, end.tolist()):
                self.ids[piece] = ids[at:to]
                at = to

    def _learn_words(self, words: list[str]) -> None:
        for i in range(0, len(words), 4096):
            part = words[i:i + 4096]
            for w, e in zip(part, self.tok.encode_batch(part, add_special_tokens=False)):
                self.ids[w] = struct.pack(f"<{len(e.ids)}I", *e.ids)

    def _known(self, pieces: list[str], words: set[str]) -> list[bytes]:
        """Ids of pieces, those in ``words`` by all rules of the tokeniser."""
        new = [p for p in pieces if p not in self.ids]
        if len(self.ids) + len(new) > CACHE:
            self.ids = {"": b""}
            new = [p for p in pieces if p]
        self._learn([p for p in new if p not in words])
        self._learn_words([p for p in new if p in words])
        return [self.ids[p] for p in pieces]

    def encode(self, group: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, one text after the other, and each text's number of ids."""
        split = pc.split_pattern(pc.replace_substring(group, "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        cut = pc.extract_regex(coded.dictionary, PLAIN)
        plain = cut.is_valid()
        body, tail = cut.filter(plain).flatten()
        other = coded.dictionary.filter(pc.invert(plain))
        # a distinct word is two pieces: body and tail, or itself and the empty string
        pieces = pa.concat_arrays([pc.utf8_lower(body), other, tail, pa.array([""])]).dictionary_encode()
        ids = self._known(pieces.dictionary.to_pylist(), set(other.to_pylist()))
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first = np.cumsum(size) - size
        ids = np.frombuffer(b"".join(ids), "<u4")
        index, plain = pieces.indices.to_numpy(), plain.to_numpy(zero_copy_only=False)
        pair = np.full((len(plain), 2), index[-1], np.int32)
        n, m = len(body), len(other)
        pair[plain, 0], pair[~plain, 0], pair[plain, 1] = index[:n], index[n:n + m], index[n + m:-1]
        word = coded.indices.to_numpy()
        out = [np.zeros(0, "<u4")]
        for a in range(0, len(word), GATHERED):
            part = pair[word[a:a + GATHERED]].ravel()
            n = size[part]
            end = np.cumsum(n)
            out.append(ids[np.arange(end[-1]) + np.repeat(first[part] - (end - n), n)])
        return np.concatenate(out), K.per_doc_sum(size[pair].sum(axis=1)[word],
                                                  pc.list_value_length(split).to_numpy())


_encoders: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches' rows; batches of more than GROUP_BYTES of text are cut."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(), dtype=np.int64)
        a = 0
        while a < batch.num_rows:
            done = ends[a - 1] if a else 0
            b = max(int(np.searchsorted(ends, done + GROUP_BYTES, "right")), a + 1)
            yield batch.slice(a, b - a)
            a = b


def tokenised_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY,
                     with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids, little-endian, if asked for)."""
    path = path or tokenizer_path()
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
              ("length", pa.int64()), ("ids_crc32", pa.int64())]
    fields += [("ids", pa.binary())] * with_ids
    schema = pa.schema(fields)

    def run(batches):
        enc = _encoder(path)
        for batch in _groups(batches):
            ids, size = enc.encode(batch.column(1))
            ids = np.insert(ids, np.cumsum(size), END)
            size = size + 1
            n = -(-size // capacity)
            doc = np.repeat(np.arange(len(n)), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            length = np.minimum(size[doc] - piece * capacity, capacity)
            end = 4 * np.cumsum(length)
            data = memoryview(ids).cast("B")
            cuts = [data[a:b] for a, b in zip((end - 4 * length).tolist(), end.tolist())]
            cols = [batch.column(0).take(pa.array(doc)), piece, piece * capacity, length,
                    [zlib.crc32(c) for c in cuts]]
            if with_ids:
                cols.append([bytes(c) for c in cuts])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return texts(docs).mapInArrow(run, kinds + ", ids binary" * with_ids)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, ...]]:
    """Slot ranges (length, first_rank, count, per_sequence, first_sequence, offset).

    Piece number r of a length, first_rank <= r < first_rank + count, goes to sequence
    first_sequence + i // per_sequence at offset + (i % per_sequence) * length, where
    i = r - first_rank.
    """
    rooms: dict[int, list[tuple[int, int]]] = {}  # room -> [(first sequence, sequences)]
    slots = []
    sequences = 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            rooms.setdefault(room, []).append((first, n))

    for length in sorted((k for k, n in histogram.items() if n), reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = min((r for r in rooms if r >= length), default=None)
            if room is None:
                room, n = capacity, -(-left // (capacity // length))
                first, sequences = sequences, sequences + n
            else:
                first, n = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room]
            # a sequence keeps the least room that fits as long as it can take one more
            per = room // length
            full = min(n, left // per)
            if full:
                slots.append((length, rank, full * per, per, first, capacity - room))
                put(room - per * length, first, full)
                rank, left = rank + full * per, left - full * per
            if full < n and left:  # one sequence takes the rest
                slots.append((length, rank, left, left, first + full, capacity - room))
                put(room - left * length, first + full, 1)
                full, left = full + 1, 0
            if full < n:
                put(room, first + full, n - full)
    return slots


_SLOT = T.StructType([T.StructField(n, T.LongType()) for n in (
    "slot_length", "first_rank", "count", "per_sequence", "first_sequence", "slot_offset")])


def ranked(pieces: DataFrame, salts: int = SALTS) -> DataFrame:
    """pieces with a dense rank from 0 within their length."""
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))  # bounded size
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = counts.select("length", "salt",
                            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    own = F.row_number().over(Window.partitionBy("length", "salt").orderBy(
        "doc_id", "piece", "ids_crc32")) - 1
    return (salted.withColumn("own", own).join(offsets, ["length", "salt"])
            .withColumn("rank", F.col("own") + F.col("base")).drop("own", "base", "salt"))


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY,
         with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids if asked for)."""
    pieces = materialize(tokenised_pieces(docs, path, capacity, with_ids), "pieces")
    spark = pieces.sparkSession
    # at most ``capacity`` rows
    histogram = {r["length"]: r["n"] for r in
                 pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = spark.createDataFrame(plan(histogram, capacity), _SLOT)  # a few per length
    i = F.col("rank") - F.col("first_rank")
    taken = ranked(pieces).join(
        F.broadcast(slots), (F.col("length") == F.col("slot_length")) & (i >= 0)
        & (i < F.col("count")))
    seq = F.col("first_sequence") + F.floor(i / F.col("per_sequence")).cast("long")
    offset = F.col("slot_offset") + (i % F.col("per_sequence")) * F.col("length")
    return taken.select("doc_id", "piece", "start", "length", "ids_crc32",
                        seq.alias("sequence_id"), offset.alias("offset"),
                        *(["ids"] if with_ids else []))
