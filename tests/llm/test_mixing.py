import random

import pytest
from pyspark.sql import functions as F

from murmur.llm import mixing
from murmur.llm.mixing import mix_documents, mixed_documents


def rows_of(sizes):
    return [
        {"doc_id": i, "source": s, "text": " ".join(["w"] * n)}
        for i, (s, n) in enumerate(sizes)
    ]


def targets(sizes, weights=(3, 1, 2)):
    """Water filling the slow way."""
    total = {}
    for s, n in sizes:
        total[s] = total.get(s, 0) + n
    names = sorted((s for s in total if s is not None)) + ([None] if None in total else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    out, left, open_ = {}, 1.5 * sum(total.values()), list(names)
    while open_:
        level = left / sum(w[s] for s in open_)
        full = [s for s in open_ if level * w[s] > 2 * total[s]]
        if not full:
            return out | {s: level * w[s] for s in open_}
        for s in full:
            out[s] = 2 * total[s]
            left -= out[s]
            open_.remove(s)
    return out


@pytest.mark.parametrize("bucket", [50_000, 3])
def test_targets_and_taken(docs, monkeypatch, bucket):
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", bucket)
    sizes = [("a", 5)] * 40 + [("b", 3)] * 10 + [("c", 7)] * 30 + [(None, 2)] * 20 + [("d", 0)]
    got = mix_documents(docs(rows_of(sizes))).collect()
    want = targets(sizes)
    assert len(got) == len(sizes)
    for r in got:
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r["size"]
    for s, t in want.items():
        assert abs(sum(r.taken for r in got if r.source == s) - t) <= 14
    assert sum(r.taken for r in got) == int(1.5 * sum(n for _, n in sizes))


def test_the_same_whatever_the_ranges(docs, monkeypatch):
    frame = docs(rows_of([("a", i % 9) for i in range(200)] + [("b", 4)] * 50))
    one = sorted(map(tuple, mix_documents(frame).select("doc_id", "taken").collect()))
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", 7)
    assert one == sorted(map(tuple, mix_documents(frame.repartition(5)).select("doc_id", "taken").collect()))


def test_edge_cases(docs):
    assert mix_documents(docs([])).collect() == []
    got = mix_documents(docs([{"doc_id": 1}, {"doc_id": 1}, {"text": " \n"}])).collect()
    assert [r.taken for r in got] == [0, 0, 0]
    same = docs([{"doc_id": 1, "text": "a b", "source": "s"}] * 3)
    assert sum(r.taken for r in mix_documents(same).collect()) == 9


def test_documents_repeat_as_taken(docs):
    frame = docs(rows_of([("a", 1)] * 10 + [("b", 1)] * 30))
    plan = {r.doc_id: r.copies for r in mix_documents(frame).collect()}
    out = mixed_documents(frame.withColumn("size", F.lit("x")).withColumn("copies", F.lit(9)))
    assert out.columns == [*frame.columns, "size", "copies"]
    counts = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert counts == {k: v for k, v in plan.items() if v}


def test_ranges_of_time_rise_and_stay_small(spark):
    """Sources that go on long after the others fill no range of their own."""
    rng = random.Random(3)
    finish = sorted([rng.random() * 2**k for k in range(12) for _ in range(200)] + [2.0**k for k in range(12)])
    frame = spark.createDataFrame([(x,) for x in finish], "x double")
    got = [r[0] for r in frame.orderBy("x").select(mixing._range_of(F.col("x"), F.lit(16).cast("bigint"))).collect()]
    assert got == sorted(got) and got[0] >= 0
    # a source that runs to time 1000 at an even pace, beside one that ends at 1
    even = spark.range(40_000).select((F.col("id") / 40.0).alias("x")).unionAll(spark.range(1000).select((F.col("id") / 1000.0).alias("x")))
    times = 41
    most = even.groupBy(mixing._range_of(F.col("x"), F.lit(times).cast("bigint"))).count().agg(F.max("count")).first()[0]
    assert most <= 41_000 / times
