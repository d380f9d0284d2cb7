import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from murmur.llm import codes as K

KIND = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=16, entries=64, rounds=2):
    """Plain loops over Python integers."""
    kept = [
        (i, label, [math.floor(256 * np.float32(c).item()) for c in v])
        for i, v, label in rows
        if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    size = len(kept[0][2]) // parts
    cut = lambda v, p: v[p * size : (p + 1) * size]
    books = [[cut(r[2], p) for r in kept[:entries]] for p in range(parts)]

    def near(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, _, v in kept:
                groups.setdefault(near(cut(v, p), books[p])[1], []).append(cut(v, p))
            for k, g in groups.items():
                books[p][k] = [sum(c) // len(g) for c in zip(*g)]
    found = [(i, label, [near(cut(v, p), books[p]) for p in range(parts)]) for i, label, v in kept]
    sums = {}
    for _, label, f in found:
        sums[label] = sums.get(label, 0) + sum(d for d, _ in f)
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return [
        (i, "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), sums[label], digest) for i, label, f in found
    ]


def vectors(n, width, seed, spread=1.0):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, spread) for _ in range(width)] for _ in range(5)]
    rows = [
        (i * 3, [c + rng.gauss(0, 0.1) for c in rng.choice(middles)], rng.choice([0, 1, 2, None])) for i in range(n)
    ]
    rng.shuffle(rows)
    return rows


def order(row):
    return tuple((x is not None, x if x is not None else 0) for x in row)


@pytest.mark.parametrize("n, width, spread", [(400, 32, 1.0), (150, 16, 0.01), (30, 64, 3.0), (1, 16, 1.0)])
def test_against_brute_force(spark, n, width, spread):
    rows = vectors(n, width, n, spread)
    rows += [(1000001, None, 1), (1000002, [None] * width, 1), (1000003, [float("nan")] + [0.0] * (width - 1), 1)]
    rows += [(1000004, [float("inf")] * width, 1), (None, [0.5] * width, None)]
    rows += [rows[0], (rows[0][0], [0.25] * width, 2)]
    got = [tuple(r) for r in K.compress_embeddings(spark.createDataFrame(rows, KIND).repartition(3)).collect()]
    assert sorted(got, key=order) == sorted(brute(rows), key=order)


def test_ties_go_to_the_lower_entry(spark):
    rows = [(i, [float(i % 2)] * 16, 0) for i in range(70)] + [(99, [0.5] * 16, 0)]
    got = {r.vec_id: r for r in K.compress_embeddings(spark.createDataFrame(rows, KIND)).collect()}
    want = {r[0]: r for r in brute(rows)}
    assert {i: tuple(r) for i, r in got.items()} == want
    assert got[99].code == "00" * 16 and got[3].code == "01" * 16


@pytest.mark.parametrize("seed", range(20))
def test_cells_keep_every_possible_answer(seed):
    rng = np.random.default_rng(seed)
    size = int(rng.integers(1, 7))
    book = rng.integers(-60, 60, (int(rng.integers(1, 65)), size))
    book[: len(book) // 3] = book[0]  # entries that are equal
    x = rng.integers(-200, 200, (3000, size))
    x[:100] = book[rng.integers(0, len(book), 100)]
    grid = K.Grid(book)
    for part in np.array_split(x, 3):
        entry, distance = grid.nearest(part)
        d = ((part[:, None, :] - book[None]) ** 2).sum(axis=2)
        assert (entry == d.argmin(axis=1)).all() and (distance == d.min(axis=1)).all()
    assert len(grid.flat) <= len(grid.known) * len(book)


def test_memory_is_bounded_and_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(K, "REMEMBERED", 50)
    rng = np.random.default_rng(1)
    book, x = rng.integers(-50, 50, (20, 2)), rng.integers(-500, 500, (400, 2))
    grid = K.Grid(book)
    for part in np.array_split(x, 20):
        entry, _ = grid.nearest(part)
        assert (entry == ((part[:, None] - book[None]) ** 2).sum(axis=2).argmin(axis=1)).all()
        assert len(grid.known) <= 50


def test_odd_lengths_and_huge_numbers(spark):
    rows = [(1, [1.0] * 32, 1), (2, [2.0] * 32, 1), (3, [1.0] * 5, 1), (4, [], None), (5, [3e38] * 32, 2)]
    got = {r.vec_id: r for r in K.compress_embeddings(spark.createDataFrame(rows, KIND)).collect()}
    assert (got[3].code, got[3].error, got[4].code, got[4].label_error) == (None, None, None, None)
    assert got[1].error == 0 and got[1].label_error == 0 and got[5].error == 0
    none = K.compress_embeddings(spark.createDataFrame([(1, [1.0] * 5, 0)], KIND)).collect()
    assert [(r.code, r.error, r.label_error) for r in none] == [(None, None, None)]


def test_empty_and_extra_columns(spark):
    assert K.compress_embeddings(spark.createDataFrame([], KIND)).collect() == []
    wide = spark.createDataFrame([(1, [1.0] * 16, 3)], KIND).withColumns(
        {c: F.lit("q") for c in ("x", "code", "error", "label_error", "_label")}
    )
    assert [tuple(r)[:4] for r in K.compress_embeddings(wide).collect()] == [(1, "00" * 16, 0, 0)]


def test_decoding_stands_near_the_vector(spark):
    rows = vectors(200, 32, 5)
    frame = K.whole_vectors(spark.createDataFrame(rows, KIND))
    books = K.learn_books(frame, 32)
    back = K.decoded_vectors(K.encode_vectors(frame, books, 32), books).collect()
    true = {i: np.array(v) for i, v, _ in rows}
    for r in back:
        # Half a step a component, besides the error of the code.
        assert ((np.array(r.vector) - true[r.vec_id]) ** 2).sum() ** 0.5 <= (r.error**0.5 + 32**0.5) / 256
