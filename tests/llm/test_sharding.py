import zlib

import pytest
from pyspark.sql import functions as F

from murmur.llm.sharding import permuted, shard_documents, sides_of


@pytest.mark.parametrize("total", [1, 2, 3, 5, 16, 97, 1000, 4097])
def test_permutation_is_a_bijection(spark, total):
    places = [r[0] for r in spark.range(total).select(permuted(F.col("id"), total, 3)).collect()]
    assert sorted(places) == list(range(total))
    assert total < 90 or places != sorted(places)


def test_grid_is_close():
    for total in (1, 2, 10, 99, 10**6 + 3):
        a, b = sides_of(total)
        assert total <= a * b < total + a


def test_documents(docs):
    rows = [{"doc_id": i, "text": "é" * (i % 5)} for i in range(100)]
    rows += [{"doc_id": 5, "text": "again"}, {"doc_id": 5, "text": "again"}, {"text": None}]
    got = shard_documents(docs(rows), shards=7).collect()
    assert len(got) == 103
    assert sorted(r.row for r in got) == list(range(103))
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert set(by) <= set(range(7))
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    sizes = [len(by.get(s, [])) for s in range(7)]
    assert max(sizes) - min(sizes) <= 1
    want = sorted((len((r.get("text") or "").encode()) + 16, zlib.crc32((r.get("text") or "").encode())) for r in rows)
    assert sorted((r["size"], r.text_crc32) for r in got) == want
    again = shard_documents(docs(rows).repartition(3), shards=7).collect()
    key = lambda r: tuple(-1 if v is None else v for v in (r.doc_id, r.text_crc32, r.shard, r.slot))
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_empty_and_extra_columns(docs):
    assert shard_documents(docs([])).collect() == []
    wide = docs([{"doc_id": 1, "text": "a"}]).withColumns(
        {c: F.lit("x") for c in ("row", "_part", "shard", "slot", "size")}
    )
    assert [(r.shard, r.slot) for r in shard_documents(wide, shards=1).collect()] == [(0, 0)]
