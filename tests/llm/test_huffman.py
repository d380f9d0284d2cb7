import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from murmur.llm import huffman as H
from murmur.llm.units import ByteBpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 60), max_size=900), st.integers(6, 18), st.integers(1, 40))
def test_round_trip(ids, limit, stride):
    ids = np.array(ids, np.int64)
    lengths = H.code_lengths(np.bincount(ids, minlength=1), limit)
    assert lengths.max() <= max(limit, 6)
    payload, checkpoints, bits = H.pack(ids, H.canonical_codes(lengths), lengths, stride)
    assert len(payload) == (bits + 7) // 8
    got = H.unpack(payload, checkpoints, len(ids), H.decode_table(lengths), stride)
    assert got.tolist() == ids.tolist()


def test_lengths_are_best():
    """Without a limit in reach the cost is that of Huffman's own algorithm."""
    import heapq

    rng = random.Random(1)
    for _ in range(20):
        counts = np.array([rng.randint(0, 50) for _ in range(30)])
        heap, cost = sorted(int(c) for c in counts if c), 0
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            cost += a + b
            heapq.heappush(heap, a + b)
        lengths = H.code_lengths(counts, 18)
        assert int((counts * lengths).sum()) == cost
        assert sum(2.0 ** -int(n) for n in lengths if n) == pytest.approx(1)


def test_limit_holds():
    counts = np.array([1 << i for i in range(30)])
    lengths = H.code_lengths(counts, 6)
    assert lengths.max() <= 6 and sum(2.0 ** -int(n) for n in lengths) <= 1


ODD = ["", " ", "a  b", "a\n\nb", "\n", " a", "a ", "a \n b", "it's ok\nX", "x\x00y z", "é ü   z", "<|endoftext|> a",
       "a\tb c", "日本 語\nテ", "a\u0085b c\x1cd e", "1 2\n3", "don't 's\n's"]


@pytest.mark.parametrize("text", ODD)
def test_pieces_equal_whole(text):
    t = Tokenizer.from_file(PATH)
    (got,) = ByteBpe.of(PATH).encode([text])
    assert np.frombuffer(got, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \n\ta'sB1.é 中", max_size=30))
def test_pieces_equal_whole_any(text):
    test_pieces_equal_whole(text)


@pytest.mark.parametrize("options", [{}, {"block_ids": 7, "stride": 3}])
def test_digest(docs, options):
    texts = [*ODD, None, "long " * 4000, "same", "same"]
    rows = [{"doc_id": i * 3, "text": x} for i, x in enumerate(texts)] + [{"text": "no id"}]
    rows += [{"doc_id": 6, "text": "twice"}] * 2
    random.Random(2).shuffle(rows)
    frame = docs(rows).withColumnsRenamed({"lang": "ids", "source": "part"})
    got = sorted(map(tuple, H.token_digest(frame, PATH, **options).collect()), key=lambda r: r[1])
    t = Tokenizer.from_file(PATH)
    start, want = 0, []
    for row in sorted(rows, key=lambda r: (r.get("doc_id") is not None, r.get("doc_id") or 0, r.get("text") or "")):
        ids = t.encode(row.get("text") or "", add_special_tokens=False).ids + [2]
        want.append((row.get("doc_id"), start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want


def test_empty(docs):
    assert H.token_digest(docs([]), PATH).collect() == []


SPECIAL = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\ny z", "<|endoftext| > a", "<|endof\ntext|>"]


def test_special_tokens_are_those_of_the_untouched_tokenizer(docs):
    t = Tokenizer.from_file(PATH)
    want = [t.encode(x, add_special_tokens=False).ids for x in SPECIAL]
    assert want[0] == [64, 220, 50256, 275]
    got = ByteBpe.of(PATH).encode(SPECIAL)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == want
    rows = H.token_digest(docs([{"doc_id": i, "text": x} for i, x in enumerate(SPECIAL)]), PATH).collect()
    crcs = {i: zlib.crc32(np.array([*ids, 2], "<u4").tobytes()) for i, ids in enumerate(want)}
    assert {tuple(r)[0]: tuple(r)[3] for r in rows} == crcs


def thue_morse(bits, a, b):
    """Two strings of 2^bits letters on which every polynomial modulo 2^64 of an odd base agrees."""
    letters = [bin(i).count("1") % 2 for i in range(1 << bits)]
    return "".join((a, b)[x] for x in letters), "".join((b, a)[x] for x in letters)


@pytest.mark.parametrize("bits", [10, 11, 12])
def test_texts_of_like_structure_keep_their_ids(bits):
    pair = thue_morse(bits, "a", "b")
    t = Tokenizer.from_file(PATH)
    got = ByteBpe(PATH).encode([*pair, f"x {pair[1]}", f"x {pair[0]}"])
    want = [t.encode(x, add_special_tokens=False).ids for x in (*pair, f"x {pair[1]}", f"x {pair[0]}")]
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == want


def test_pieces_of_one_hash_are_told_apart_by_their_bytes(monkeypatch):
    """Were all hashes of a length equal, the ids would still be right."""
    from murmur.llm import units

    monkeypatch.setattr(units, "string_hashes", lambda body, starts, sizes, words=None: sizes.astype(np.uint64))
    texts = ["one two", "two one six", "six ten one", "abcdefghij klmnopqrst", "klmnopqrst abcdefghij", "a\nb", "b\na"]
    t = Tokenizer.from_file(PATH)
    bpe = ByteBpe(PATH)
    for _ in range(2):
        got = [np.frombuffer(g, "<u4").tolist() for g in bpe.encode(texts)]
        assert got == [t.encode(x, add_special_tokens=False).ids for x in texts]
