"""op5's ids: put together from distinct words, those of the tokeniser for any text."""

import random

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from eventide.llm import packing


class _Asked:
    """The tokeniser, and the words it was asked for by all its rules."""

    def __init__(self, tok):
        self.tok, self.words = tok, []

    def encode_batch(self, words, **how):
        self.words += words
        return self.tok.encode_batch(words, **how)


def _ids(encoder, group):
    ids, size = encoder.encode(pa.array(group))
    end = np.cumsum(size)
    return [ids[a:b].tolist() for a, b in zip(end - size, end)]


def test_words_before_any_punctuation_ask_the_vocabulary_only():
    encoder = packing.WordEncoder(packing.tokenizer_path())
    tok = encoder.tok
    encoder.tok = asked = _Asked(tok)
    group = ["Then the### then%%% the. émeute,%%% Élan", "then\nTHE&&& x<|> it's 21.33 don't"]
    want = [e.ids for e in tok.encode_batch(group, add_special_tokens=False)]
    assert _ids(encoder, group) == want
    assert sorted(asked.words) == ["21.33", "don't", "it's"]
    assert _ids(encoder, group[::-1]) == want[::-1]
    assert len(asked.words) == 3  # the others are known


def test_odd_texts_have_the_tokenisers_ids(monkeypatch):
    tok = Tokenizer.from_file(packing.tokenizer_path())
    rng = random.Random(37)
    chars = ("abcXYZéÀßÿİſŉµªºǅΣσñ'’.,;:!?#$%&<>|*/-_()[]{}\"`~^@+=\\0 9٣ \n\t\ŕ 漢🙂Ωﬁ"
             "\x00\x1c\x85")
    odd = ["".join(rng.choices(chars, k=rng.randint(0, 40))) for _ in range(3000)]
    odd += ["", " ", "\n", "a<|endoftext|>b", "<|endoftext|>", "</w> a</w>", "'s word' it's a'b"]
    want = [e.ids for e in tok.encode_batch(odd, add_special_tokens=False)]
    encoder = packing.WordEncoder(packing.tokenizer_path())
    assert _ids(encoder, odd) == want
    monkeypatch.setattr(packing, "CACHE", 100)  # forgets everything again and again
    monkeypatch.setattr(packing, "GATHERED", 7)
    for i in range(0, len(odd), 50):
        assert _ids(encoder, odd[i:i + 50]) == want[i:i + 50]


def test_large_batches_are_cut(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_BYTES", 10)
    texts = ["abc", "", "x" * 30, "defg", "hij", "klmnop"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], names=["d", "t"])
    got = [g.column(1).to_pylist() for g in packing._groups(iter([batch, batch.slice(0, 0)]))]
    assert got == [["abc", ""], ["x" * 30], ["defg", "hij"], ["klmnop"]]
    rows = [(i, t) for i, t in enumerate(["one two", None, "three " * 40, ""])]
    docs = spark.createDataFrame(rows + [(None, "four")], "doc_id long, text string")
    out = packing.tokenised_pieces(docs, capacity=16, with_ids=True).collect()
    tok = Tokenizer.from_file(packing.tokenizer_path())
    for doc, text in rows + [(None, "four")]:
        own = sorted((r for r in out if r.doc_id == doc), key=lambda r: r.piece)
        ids = tok.encode(text or "", add_special_tokens=False).ids + [packing.END]
        assert [r.piece for r in own] == list(range(-(-len(ids) // 16)))
        assert [list(np.frombuffer(r.ids, "<u4")) for r in own] == [
            ids[r.start:r.start + r.length] for r in own]
        assert [r.start for r in own] == list(range(0, len(ids), 16))
