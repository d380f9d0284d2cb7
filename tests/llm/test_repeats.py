import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from murmur.llm import repeats as R


def brute(rows, size=50):
    """doc_id, n_bytes, n_removed, n_spans, sha256 of what is kept, for each row."""
    texts = [(r.get("doc_id"), (r.get("text") or "").encode()) for r in rows]
    rank = lambda d: (d is not None, d or 0)
    first = {}
    for d, b in texts:
        for p in range(len(b) - size + 1):
            s = b[p : p + size]
            first[s] = min(first.get(s, rank(d)), rank(d))
    out = []
    for d, b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - size + 1):
            if first[b[p : p + size]] < rank(d):
                gone[p : p + size] = b"\1" * size
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def key(row):
    return tuple((x is not None, x if x is not None else 0) for x in row)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    line, passage = prose(14), prose(60)
    rows = []
    for i in range(60):
        text = prose(rng.randint(1, 120))
        if i % 3 == 0:
            text = prose(rng.randint(0, 9)) + " " + line + "\n" + text
        if i % 5 == 0:
            text = text + passage[rng.randint(0, 40) :] + prose(3)
        rows.append({"doc_id": i * 7 % 61, "text": text})
    near = prose(150)
    rows += [{"doc_id": 100 + i, "text": near[: i * 9] + "X" + near[i * 9 :]} for i in range(12)]
    rows += [{"doc_id": 200 + i, "text": near} for i in range(5)]
    rows += [{"doc_id": 3, "text": near}, {"text": near + "!"}, {"text": None, "doc_id": 300}, {"doc_id": 301, "text": ""}]
    rows += [{"doc_id": 302, "text": "a" * 400}, {"doc_id": 303, "text": "b" + "a" * 50}, {"doc_id": 304, "text": "a" * 49}]
    rows += [{"doc_id": 305, "text": "xy" * 300}, {"doc_id": 299, "text": "yx" * 80}, {"doc_id": 305, "text": "xy" * 300}]
    rows += [{"doc_id": -4, "text": "é" * 30}, {"doc_id": 9, "text": "é" * 25}, {"doc_id": 10, "text": "a" + "é" * 25}]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(
    "options",
    [{}, {"block_bytes": 700, "shard_bytes": 900}, {"block_bytes": 2000, "shard_bytes": 5000, "hot": 1}],
    ids=["one block", "many", "all by window"],
)
def test_against_brute_force(docs, options):
    rows = corpus(len(options))
    got = [tuple(r) for r in R.repeats_digest(docs(rows).repartition(3), **options).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_spans_and_rest(docs):
    s = "".join(chr(97 + i * i % 26) for i in range(60))
    rows = [{"doc_id": 1, "text": s}, {"doc_id": 2, "text": f"<{s[5:]}>{s[:50]}."}]
    got = {r.doc_id: r for r in R.remove_repeats(docs(rows)).collect()}
    assert got[1].spans == [] and bytes(got[1].kept).decode() == s
    assert [tuple(x) for x in got[2].spans] == [(1, 56), (57, 107)]
    assert bytes(got[2].kept) == b"<>."
    assert (got[2].n_bytes, got[2].n_removed) == (108, 105)


def test_smaller_strings(docs):
    rows = corpus(9)[:40]
    got = [tuple(r) for r in R.repeats_digest(docs(rows), size=20, block_bytes=1500).collect()]
    assert sorted(got, key=key) == sorted(brute(rows, 20), key=key)
    with pytest.raises(ValueError):
        R.remove_repeats(docs([]), size=5)


def test_empty_and_extra_columns(docs):
    assert R.repeats_digest(docs([])).collect() == []
    assert [r.n_removed for r in R.repeats_digest(docs([{"doc_id": 1}])).collect()] == [0]
    wide = docs([{"doc_id": 1, "text": "q" * 60}, {"doc_id": 2, "text": "q" * 70}]).withColumns(
        {c: F.lit("x") for c in ("block", "kind", "shard", "payload", "kept", "spans", "n_bytes")}
    )
    assert sorted((r.doc_id, r.n_removed) for r in R.repeats_digest(wide).collect()) == [(1, 0), (2, 70)]


def test_very_long_text(docs):
    rng = np.random.default_rng(3)
    body = rng.integers(97, 123, 700_000).astype(np.uint8).tobytes().decode()
    rows = [{"doc_id": 1, "text": body}, {"doc_id": 2, "text": body[200_000:] + "z"}, {"doc_id": 3, "text": " " * 300_000}]
    got = {r.doc_id: r for r in R.repeats_digest(docs(rows), block_bytes=1000).collect()}
    assert (got[1].n_removed, got[2].n_removed, got[3].n_removed) == (0, 500_000, 0)
    assert got[2].kept_sha256 == hashlib.sha256(b"z").hexdigest()


def test_windows_of_equal_content_share_an_anchor():
    """Wherever a window stands, in any chunk, its anchor is the same gram."""
    rng = np.random.default_rng(0)
    passage = rng.integers(97, 101, 120).astype(np.uint8)
    body = np.concatenate([rng.integers(97, 101, 333).astype(np.uint8), passage, rng.integers(97, 101, 77).astype(np.uint8), passage])
    anchors = {}
    for start, count, anchor in zip(*(x.tolist() for x in R.all_segments(body, np.array([0, len(body)]), 50))):
        for p in range(start, start + count):
            window = body[p : p + 50].tobytes()
            assert anchors.setdefault(window, anchor) == anchor
    assert len(anchors) == len(body) - 49 - 71


@pytest.mark.parametrize("size", [16, 17, 20, 33, 50])
@pytest.mark.parametrize("seed", range(4))
def test_windows_of_a_shard_against_brute_force(size, seed):
    """Whatever is left out of the sort, each window gets the smallest document that has it."""
    rng = np.random.default_rng(seed)
    base = rng.integers(97, 99 + seed, 150).astype(np.uint8)
    texts = [base, np.full(90, 97, np.uint8), np.tile(base[:7], 15)]
    for _ in range(30):
        text = base[int(rng.integers(0, 60)) : int(rng.integers(80, 150))].copy()
        text[rng.integers(0, len(text), int(rng.integers(0, 3)))] = 122
        texts.append(text)
    body, offsets = np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    starts, counts, _ = R.all_segments(body, offsets, size)
    low = rng.integers(0, 25, len(starts))
    got = R.smallest_documents(body, starts, counts, low, size)
    windows = [(body[p : p + size].tobytes(), d) for s, c, d in zip(starts, counts, low) for p in range(s, s + c)]
    least = {}
    for w, d in windows:
        least[w] = min(least.get(w, d), d)
    assert got.tolist() == [least[w] for w, _ in windows]


def test_only_what_may_repeat_is_sorted(monkeypatch):
    """Two texts with one gram in common have no window in common; of two with 52 bytes in
    common, little besides them is sorted."""
    windows_sorted = []
    sort = R.sorted_windows
    monkeypatch.setattr(R, "sorted_windows", lambda *a: windows_sorted.extend(a[2].tolist()) or sort(*a))
    rng = np.random.default_rng(1)
    common = rng.integers(97, 123, 52).astype(np.uint8)

    def run(shared):
        texts = [rng.integers(48, 58, 300).astype(np.uint8) for _ in range(2)]
        for t in texts:
            t[120 : 120 + len(shared)] = shared
        body = np.concatenate(texts)
        # The segments around the shared bytes, all of whose windows hold the same gram.
        starts, counts, anchor = R.all_segments(body, np.array([0, 300, 600]), 50)
        both = np.isin(anchor, np.intersect1d(anchor[starts < 300], anchor[starts >= 300]))
        starts, counts = starts[both], counts[both]
        low = starts // 300
        return counts, R.smallest_documents(body, starts, counts, low, 50), low

    tried = 0
    for k in range(37):
        counts, got, low = run(common[k : k + 16])
        tried += len(counts)
        assert got.tolist() == np.repeat(low, counts).tolist()
    assert tried and not windows_sorted
    counts, got, low = run(common)
    assert got.sum() == np.repeat(low, counts).sum() - 3
    # Besides the equal ones, at most the rest of the ranges at either end.
    assert windows_sorted and max(windows_sorted) <= 3 + 2 * 6 < counts.max()


def test_unequal_strings_of_one_hash_stay_apart(monkeypatch, docs):
    """Were all hashes equal, bytes still decide."""
    monkeypatch.setattr(R, "content_hashes", lambda body, starts, sizes: np.zeros(len(starts), np.uint64))
    texts = ["m" * 60, "n" * 60, "m" * 60, "o" * 70 + "m" * 60]
    body = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    starts, counts, _ = R.all_segments(body, offsets, 50)
    number, first = R.distinct(body, starts, counts, R.content_hashes(body, starts, counts), 50)
    for n in set(number.tolist()):
        same = {body[starts[i] : starts[i] + counts[i] + 49].tobytes() for i in np.flatnonzero(number == n)}
        assert len(same) == 1
    assert len(first) == number.max() + 1


def test_packing():
    arrays = [np.arange(5, dtype=np.int64), np.zeros(0, np.uint8), np.array([7], np.uint32)]
    back = R.unpacked(R.packed(*arrays), np.int64, np.uint8, np.uint32)
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(arrays, back))
    assert pa.Codec.is_available("zstd")
