import random

import pytest
from pyspark.sql import functions as F

from murmur.llm import jaccard as J
from murmur.llm.components import components
from tests.llm.test_words import shingles


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and None not in (sets[x][0], sets[y][0]) and 100 * len(a & b) >= 80 * len(a | b):
                parent[max(find(x), find(y))] = min(find(x), find(y))
    least = {}
    for x, (i, _) in enumerate(sets):
        if i is not None:
            least[find(x)] = min(i, least.get(find(x), i))
    return sorted(((i, len(s), least.get(find(x)) if i is not None else None) for x, (i, s) in enumerate(sets)), key=str)


def near(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"v{rng.randrange(10**6)}"
    return words


def corpus(seed):
    rng = random.Random(seed)
    rows = []
    passage = [f"p{i}" for i in range(60)]
    for _ in range(25):
        n = rng.choice([1, 2, 4, 5, 6, 9, 30, 80, 300])
        base = [f"w{rng.randrange(5000)}" for _ in range(n)]
        rows.append(" ".join(base))
        for _ in range(rng.randrange(4)):
            rows.append("  ".join(near(rng, base, rng.randrange(1 + n // 25))).upper())
        rows.append(" ".join(base + passage))
    group = [f"g{i}" for i in range(200)]
    rows += [" ".join(near(rng, group, rng.randrange(9))) for _ in range(60)]
    rows += [" ".join(group)] * 10
    # A chain, each link just similar enough.
    rows += [" ".join(f"c{k}" for k in range(s, s + 64)) for s in range(0, 60, 6)]
    rows += ["", " \n", None, "one", "ONE", "a b c d", "x " * 3000]
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    return list(zip(ids, rows)) + [(7, "another text with the same id as one before"), (None, "one"), (3, rows[ids.index(3)])]


@pytest.mark.parametrize("seed,block", [(1, J.BLOCK), (2, 3)])
def test_equals_brute_force(docs, seed, block):
    rows = corpus(seed)
    frame = docs([{"doc_id": i, "text": t} for i, t in rows]).withColumn("n", F.lit("x")).withColumn("node", F.lit(0))
    got = J.link_documents(frame.repartition(5), block=block).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_the_order_only_steers(docs, monkeypatch):
    rows = corpus(3)[:80]
    frame = docs([{"doc_id": i, "text": t} for i, t in rows])
    monkeypatch.setattr(J, "frequent_shingles", lambda texts: __import__("numpy").zeros(0, "uint64"))
    got = J.link_documents(frame).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_empty_and_representatives(docs):
    assert J.link_documents(docs([])).collect() == []
    frame = docs([{"doc_id": i, "text": t} for i, t in [(1, "a b"), (2, "A B"), (3, None), (4, ""), (1, "a b"), (None, "a b")]])
    frame = frame.withColumn("component_id", F.lit("z"))
    out = J.representatives(frame)
    assert out.columns == frame.columns
    assert sorted(map(str, (r.doc_id for r in out.collect()))) == ["1", "3", "4", "None"]


def test_unlike_texts_of_one_doc_id_both_stay(docs):
    rows = [(1, "a b c"), (1, "x y z"), (2, "A b c"), (5, ""), (5, "q r"), (5, "q r"), (0, "x y z"), (None, None), (None, None), (6, None), (6, None)]
    frame = docs([{"doc_id": i, "text": t} for i, t in rows]).withColumns({c: F.lit(1) for c in ("row", "class_id", "n", "a b")})
    out = J.representatives(frame)
    assert out.columns == frame.columns
    want = [(0, "x y z"), (1, "a b c"), (5, ""), (5, "q r"), (6, None), (6, None), (None, None), (None, None)]
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_pairs_of_small_tiles_leave_once(size):
    import numpy as np
    import pyarrow as pa

    rng = random.Random(size)
    n_of = {k: rng.choice([10, 11, 20]) for k in range(40)}
    component = {k: k % 7 for k in n_of}
    rows = []
    for tile in range(60):
        nodes = sorted(rng.sample(sorted(n_of), rng.randint(2, J.SMALL)))
        rows += [(nodes[0], tile, k, component[k], n_of[k]) for k in nodes]
    rows.sort()
    names = ["leader", "tile", "node", "component", "n"]
    batches = [
        pa.RecordBatch.from_arrays([pa.array(np.array(c, np.int64)) for c in zip(*rows[k : k + size])], names)
        for k in range(0, len(rows), size)
    ]
    got = [pair for b in J._compare_small(iter(batches)) for pair in zip(*b.to_pydict().values())]
    want = {}
    for leader, tile, *_ in rows:
        want.setdefault(leader, set())
    for i, x in enumerate(rows):
        for y in rows[i + 1 :]:
            if x[:2] == y[:2] and x[3] != y[3] and 5 * min(x[4], y[4]) >= 4 * max(x[4], y[4]):
                want[x[0]].add((min(x[2], y[2]), max(x[2], y[2])))
    every = [p for pairs in want.values() for p in pairs]
    # Once for each leader at most; leaders that come in one batch share a pair.
    assert set(got) == set(every) and len(got) <= len(every)
    assert size == 1000 or sorted(got) == sorted(every)
    assert list(J._compare_small(iter([]))) == []


def test_shared_rows_stream(spark):
    import pyarrow as pa

    rng = random.Random(4)
    rows = sorted({(t, rng.randrange(50)) for t in [rng.randrange(30) for _ in range(200)]})
    rows = sorted(rows + rows[::7])
    for size in (1, 2, 3, 50, 500):
        batches = [pa.RecordBatch.from_pydict({"tile": [t for t, _ in part], "node": [n for _, n in part]})
                   for part in (rows[k : k + size] for k in range(0, len(rows), size))]
        got = [tuple(r.values()) for b in J._shared(iter(batches)) for r in b.to_pylist()]
        tiles = {}
        for t, n in rows:
            tiles.setdefault(t, set()).add(n)
        want = [(t, n, min(s)) for t, s in tiles.items() if len(s) > 1 for n in s]
        assert sorted(got) == sorted(want)


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(40)] + [(100 + rng.randrange(50), 100 + rng.randrange(50)) for _ in range(30)] + [(5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    label = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in label:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert got == label


def test_tables_grow_with_the_documents_not_their_pairs(docs, monkeypatch):
    """150 texts share a passage and are just too unlike to link, so all their pairs are candidates."""
    rng = random.Random(6)
    passage = [f"p{i}" for i in range(176)]
    texts = [passage + [f"q{k}x{i}" for i in range(24)] for k in range(150)]
    texts += [near(rng, t, 2) for t in texts[::10]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    counts = {}

    def stored(frame, name):
        out = real(frame, name)
        counts[name] = out.count()
        return out

    real = J.stored
    monkeypatch.setattr(J, "stored", stored)
    got = J.link_documents(docs([{"doc_id": i, "text": t} for i, t in rows])).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
    pairs = {k: n for k, n in counts.items() if "possible" in k or "apart" in k or "near" in k or "links" in k}
    assert max(pairs.values()) <= J.HEADS * len(rows), counts
    assert counts["jaccard-near"] >= 150


@pytest.mark.parametrize("size", [1, 7, 1000])
@pytest.mark.parametrize("blocks", [1, 3])
def test_blocks_of_large_groups(size, blocks):
    """Sets of many sizes: what `_near` and `_joined` leave joins as all pairs do."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(blocks)
    rows = []
    for leader in (1, 2):
        base = rng.integers(0, 2**63, 400, dtype=np.uint64)
        for node in range(40):
            n = int(rng.choice([3, 30, 40, 200, 250, 400]))
            own = rng.integers(0, 2**63, int(n * rng.choice([0, 0.05, 0.12, 0.3])), dtype=np.uint64)
            own = np.unique(np.concatenate([base[: n - len(own)], own]))
            home = int(rng.integers(blocks))
            for other in range(blocks):
                rows.append({
                    "leader": leader, "i": min(home, other), "j": max(home, other), "block": home, "node": 100 * leader + node,
                    "component": 100 * leader + node - node % 2, "tiles": int(rng.choice([1, 3, -1])) if blocks == 1 else 1,
                    "n": len(own), "bitmap": J.bitmap_of(own), "shingles": own.tobytes(),
                })
    rows.sort(key=lambda r: (r["leader"], r["i"], r["j"]))
    types = {"i": pa.int32(), "j": pa.int32(), "block": pa.int32(), "bitmap": pa.binary(), "shingles": pa.binary()}
    schema = pa.schema([(c, types.get(c, pa.int64())) for c in rows[0]])

    def batches(some):
        return iter([pa.RecordBatch.from_pylist(some[k : k + size], schema) for k in range(0, len(some), size)])

    kept = [r for b in J._near(batches(rows)) for r in b.to_pylist()]
    key = ("leader", "i", "j", "node")
    assert len({tuple(r[c] for c in key) for r in kept}) == len(kept) < len(rows)
    whole = {tuple(r[c] for c in key): r for r in rows}
    found = [p for b in J._joined(batches([whole[tuple(r[c] for c in key)] for r in kept])) for p in zip(*b.to_pydict().values())]
    sets = {r["node"]: np.frombuffer(r["shingles"], np.uint64) for r in rows}
    every = {
        (x["node"], y["node"])
        for x in rows for y in rows
        if x["node"] < y["node"] and x["leader"] == y["leader"] and x["tiles"] & y["tiles"]
        and 100 * len(np.intersect1d(sets[x["node"]], sets[y["node"]])) >= 80 * len(np.union1d(sets[x["node"]], sets[y["node"]]))
    }
    assert set(found) <= every and len(found) < len(kept)

    def joined(edges):
        label = {r["node"]: r["component"] for r in rows}
        for a, b in edges:
            old, new = label[a], label[b]
            label = {k: new if v == old else v for k, v in label.items()}
        return {frozenset(k for k in label if label[k] == v) for v in label.values()}

    assert joined(found) == joined(every)
    assert list(J._near(iter([]))) == list(J._joined(iter([]))) == []
