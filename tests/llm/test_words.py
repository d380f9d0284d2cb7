import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from murmur.llm.words import groups, shingle_sets, string_hashes, utf8, word_hashes


def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower() if text else b"")
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbB \n\té\x0b中", max_size=40)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_sets_equal_python(texts):
    sets = [set(s.tolist()) for s in shingle_sets(pa.array(texts, pa.string()))]
    plain = [shingles(t) for t in texts]
    assert [len(s) for s in sets] == [len(p) for p in plain]
    for a, p in zip(sets, plain):
        for b, q in zip(sets, plain):
            assert len(a & b) == len(p & q)


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_words(texts):
    body, offsets = utf8(pa.array(texts, pa.string()))
    hashes, starts, ends, counts, begun = word_hashes(body, offsets, (1, 3))
    want = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    flat = [w for ws in want for w in ws]
    assert [bytes(body[s:e]) for s, e in zip(starts, ends)] == flat
    assert len(set(hashes.tolist())) == len(set(flat))
    assert len(set(begun[0].tolist())) == len({w[:1] for w in flat})


def test_groups_and_slices():
    assert list(groups(np.array([0, 5, 5, 100, 101]), 10)) == [(0, 2), (2, 3), (3, 4)]
    sliced = pa.array(["x y", "a b c d e f", None, "q"]).slice(1, 2)
    assert [len(s) for s in shingle_sets(sliced)] == [2, 0]


def test_hashes_know_no_structure():
    """Polynomials modulo 2^64 agree on such pairs, whatever their base."""
    from tests.llm.test_huffman import thue_morse

    for bits in (4, 9, 10, 11, 13):
        pair = thue_morse(bits, "a", "b")
        assert len({s.tobytes() for s in shingle_sets(pa.array(pair))}) == 2
        body, offsets = utf8(pa.array(pair))
        hashes, *_, begun = word_hashes(body, offsets, (4, 8))
        assert len(set(hashes.tolist())) == 2 and len(set(begun[1].tolist())) == 2


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(min_size=0, max_size=40), min_size=1, max_size=20), st.integers(0, 9))
def test_equal_strings_hash_alike_anywhere(strings, shift):
    strings = strings + strings[:3] + [b"z" * 1500, b"z" * 1500]
    body = np.frombuffer(b"q" * shift + b"".join(strings), np.uint8)
    sizes = np.array([len(s) for s in strings])
    got = string_hashes(body, np.cumsum(sizes) - sizes + shift, sizes).tolist()
    assert len(set(zip(strings, got))) == len(set(strings)) == len(set(got))
