import hashlib
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from murmur.llm import imatch
from murmur.llm.imatch import fingerprint_documents


def word_hash(w):
    return xxhash.xxh64(w.encode(), seed=42).intdigest()


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def chain(values, widths):
    h = 42
    for v, w in zip(values, widths):
        h = xxhash.xxh64(struct.pack("<q" if w == 8 else "<i", v), seed=h).intdigest()
    return signed(h)


def terms(text):
    return set(re.findall(r"[^\x20\x09-\x0D]+", text.lower()))


def brute(rows, least, most):
    texts = [(i, t or "") for i, t in rows]
    df = {}
    for _, t in texts:
        for w in terms(t):
            df[w] = df.get(w, 0) + 1
    n = len(texts)
    band = {w for w, c in df.items() if max(2, least * n) <= c <= max(2, most * n)}

    def hashes(t):
        own = sorted(signed(word_hash(w)) for w in terms(t) & band)
        out = []
        for d in imatch.ONE_IN:
            for s in range(imatch.SEEDS):
                picked = [x for x in own if chain([x, d * 100 + s], [8, 4]) % d == 0]
                out.append(chain(picked, [8] * len(picked)) % ((1 << 32) - 1) + 1 if picked else 0)
        return out

    def near(a, b):
        if a == b:
            return 1.0
        live = [(x, y) for x, y in zip(hashes(a), hashes(b)) if x or y]
        return sum(x == y for x, y in live) / len(live) if live else 0.0

    distinct = sorted({(i, signed(word_hash(t)), t) for i, t in texts}, key=lambda r: r[:2])
    result = {}
    for at, (i, _, t) in enumerate(distinct):
        following = distinct[at - 1][2]
        cut = len(t) // 3
        edited = t[: len(t) - cut] + following[:cut]
        h = hashes(t)
        print_ = "".join(f"{x:08x}" for x in h) if any(h) else "text:" + hashlib.sha256(t.encode()).hexdigest()
        result[i, t] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), print_, near(t, edited), near(t, following))
    return sorted((i, *result[i, t]) for i, t in texts)


def got(frame, **options):
    rows = fingerprint_documents(frame, **options).collect()
    assert all(r.edited_fingerprint for r in rows)
    return sorted((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.near_edited, r.near_next) for r in rows)


@pytest.mark.parametrize("least,most", [(0.0005, 0.005), (0.05, 0.6)])
def test_equals_brute_force(docs, least, most):
    rows = [(i * 7 % 101, " ".join(f"w{(i * k) % 37}" for k in range(i % 23))) for i in range(40)]
    rows += [(200, "Été\nété 中文 é" * 5), (201, None), (202, ""), (203, "a"), (204, "w1 W1  w2"), (204, "w1 W1  w2")]
    rows += [(204, "another"), (205, "long word " * 3000)]
    frame = docs([{"doc_id": i, "text": t} for i, t in rows]).withColumn("k", F.lit(1)).withColumn("row", F.lit(2))
    assert got(frame, least=least, most=most) == brute(rows, least, most)


def test_equal_texts_and_edges(docs):
    assert got(docs([])) == []
    (one,) = got(docs([{"doc_id": 1, "text": "abc def"}]))
    assert one[4:] == (0.0, 1.0) and one[1] == 7
    rows = fingerprint_documents(docs([{"doc_id": i, "text": "x y z"} for i in (1, 2)] + [{"text": "x y q"}])).collect()
    assert len({r.fingerprint for r in rows if r.doc_id}) == 1 and len(rows) == 3
