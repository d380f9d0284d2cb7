import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from murmur.llm.pieces import Pieces, encode_pieces, piece_digest

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
ODD = ["", " ", "  a  b ", "\n", "a\n\n b", "▁x ▁", "x\x00y\x00 z", "\x00", "日本語 テキスト", "é́ ﬁ", "<s> </s><0x41>",
       "aaaaaaaaaaaaaaaaaaaaaaa", "\t\ttab", " nb　sp", "😀😀 ok", "   ", "a" * 3000, "hello" * 400, "\r\n.\r\n"]


def same(text):
    (got,) = Pieces.of(PATH).encode([text])
    assert np.frombuffer(got, "<u4").tolist() == LIBRARY.encode(text, add_bos=True, add_eos=True)


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    same(text)


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=" \n▁abeinorstTh.,'é1中\x00", max_size=40))
def test_any_text(text):
    same(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=30))
def test_any_characters(text):
    same(text)


def test_backtracking_equals_merging():
    p = Pieces.of(PATH)
    for word in ("▁internationalization", "erorndthaonre", "aaaaabaaab", "▁▁▁▁x"):
        assert p.backtracked(word) == p.merged(word)


def test_digest(docs):
    rows = [{"doc_id": i, "text": t} for i, t in enumerate([*ODD, None, "same", "same"])] + [{"text": "x"}]
    got = sorted(map(tuple, piece_digest(docs(rows), PATH).collect()), key=str)
    want = []
    for r in rows:
        ids = LIBRARY.encode(r.get("text") or "", add_bos=True, add_eos=True)
        raw = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        want.append((r.get("doc_id"), len(ids), raw, hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_encode_keeps_columns(docs):
    frame = docs([{"doc_id": 1, "text": "ab"}, {"doc_id": 2}]).withColumn("n_tokens", F.lit(1))
    got = {r.doc_id: r for r in encode_pieces(frame, PATH).collect()}
    assert got[1].ids == LIBRARY.encode("ab", add_bos=True, add_eos=True) and got[2].ids == [1, 2]
    assert got[1].n_tokens == 1
    assert piece_digest(docs([]), PATH).collect() == []


@pytest.mark.parametrize("letters", ["abcdefghijklmnop", "日本語中文字", "ab", "QUJDRA+/9", "é"])
def test_long_words_take_linear_time(letters):
    import random
    import time

    rng = random.Random(5)
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    pieces, times = Pieces(PATH), []
    for size in (20_000, 200_000):
        word = "".join(rng.choice(letters) for _ in range(size))
        begin = time.process_time()
        (got,) = pieces.encode([word])
        times.append(time.process_time() - begin)
        assert np.frombuffer(got, "<u4").tolist() == library.encode(word, add_bos=True, add_eos=True)
    assert times[1] < 25 * max(times[0], 0.02)
    assert all(len(w) <= 100 for w in pieces.words)


def test_a_worker_keeps_little(monkeypatch):
    """Many distinct words, long ones and words of one hash among them, take few bytes each."""
    import random
    import sys

    from murmur.llm import pieces as module
    from murmur.llm import units

    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(60_000)]
    texts = [" ".join(words[i : i + 600]) + "\nx" + "y" * (i % 7) * 40 for i in range(0, len(words), 600)]
    want = [np.array(i, "<u4").tobytes() for i in LIBRARY.encode(texts, add_bos=True, add_eos=True)]
    made = Pieces(PATH)
    before = sys.getallocatedblocks()
    assert made.encode(texts) == want
    made.pairs.clear()
    assert sys.getallocatedblocks() - before < 20_000
    monkeypatch.setattr(module, "REMEMBERED", 1000)
    monkeypatch.setattr(module, "REMEMBERED_PAIRS", 100)
    assert made.encode(texts[:3] * 2) == want[:3] * 2
    assert made.memory.count < 60_000 and len(made.pairs) < 60_000
    # Every word has the hash of the first one.
    monkeypatch.setattr(units, "string_hashes", lambda body, starts, sizes, words: np.zeros(len(starts), np.uint64))
    assert Pieces(PATH).encode(texts[:2] + ODD) == want[:2] + [
        np.array(i, "<u4").tobytes() for i in LIBRARY.encode(ODD, add_bos=True, add_eos=True)
    ]
