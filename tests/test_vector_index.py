import numpy as np
import pytest
from pyspark.sql import functions as F

from murmur.operators import vector_index as V
from murmur.operators.retrieval import cosine_top_k

DIMS = 24


def clustered(n, seed=3, clusters=60):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(clusters, DIMS))
    rows = middles[rng.integers(0, clusters, n)] + 0.25 * rng.normal(size=(n, DIMS))
    return rows.astype(np.float32)


def frame(spark, rows, name="id", vec="embedding"):
    return spark.createDataFrame(
        [(i, [float(x) for x in r]) for i, r in enumerate(rows)], f"{name} long, {vec} array<float>"
    )


def recall(got, want):
    pairs = lambda hits: {(r.query_id, r.doc_id) for r in hits}
    return len(pairs(got) & pairs(want)) / len(pairs(want))


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    out = {}
    for n in (5_000, 20_000):
        path = str(tmp_path_factory.mktemp("v") / "rows")
        frame(spark, clustered(n)).repartition(8).write.parquet(path)
        collection = spark.read.parquet(path)
        index = V.fit_index(collection)
        store = f"{path}-index"
        V.write_collection(V.encode_collection(collection, index), store)
        out[n] = (collection, index, spark.read.parquet(store))
    return out


@pytest.mark.parametrize("n", [5_000, 20_000])
def test_few_questions_find_their_neighbours_in_a_tenth(spark, indexed, n):
    collection, index, encoded = indexed[n]
    asked = frame(spark, clustered(100, seed=3)[:60] + 0.05, "query_id")
    got = V.cosine_top_k_indexed(encoded, asked, index).collect()
    want = cosine_top_k(collection, asked, 5).collect()
    assert recall(got, want) >= 0.95
    exact = {(r.query_id, r.doc_id): r.distance for r in want}
    assert all(abs(r.distance - exact[r.query_id, r.doc_id]) < 1e-9 for r in got if (r.query_id, r.doc_id) in exact)
    # rows that a question meets
    sizes = {r.cell: r["count"] for r in encoded.groupBy("cell").count().collect()}
    units = V._unit_rows(np.stack([r.embedding for r in asked.collect()]).astype(float))
    met = np.mean([sum(sizes.get(int(c), 0) for c in cells) for cells in index.cells_near(units)])
    assert met < n / 10


def test_many_questions_meet_only_their_cells(spark, indexed):
    collection, index, encoded = indexed[5_000]
    asked = frame(spark, clustered(400, seed=3) + 0.02, "query_id")
    few = V.cosine_top_k_indexed(encoded, asked, index).collect()
    many = V.cosine_top_k_indexed(encoded, asked, index, per_pass=50, rows_per_task=300).collect()
    want = cosine_top_k(collection, asked, 5).collect()
    assert recall(many, want) >= 0.95 and recall(few, want) >= 0.95
    assert sorted({r.query_id for r in many}) == list(range(400))
    ranks = {}
    for r in many:
        ranks.setdefault(r.query_id, []).append((r["rank"], r.distance))
    assert all([x[0] for x in sorted(v)] == [1, 2, 3, 4, 5] and sorted(v) == sorted(v, key=lambda x: (x[1], x[0])) for v in ranks.values())


def test_a_search_opens_only_its_cells(spark, indexed):
    _, index, encoded = indexed[20_000]
    asked = frame(spark, clustered(1, seed=3), "query_id")
    hits = V.cosine_top_k_indexed(encoded, asked, index)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cell" in plan and index.probe < len(index.centres)


def test_without_structure_everything_is_scanned(spark):
    rows = np.random.default_rng(1).normal(size=(4_500, 64))
    collection = frame(spark, rows).repartition(4)
    index = V.fit_index(collection)
    assert index.probe == 0
    few = frame(spark, rows[:100])
    assert V.fit_index(few).probe == 0
    asked = frame(spark, rows[:5] + 0.1, "query_id")
    encoded = collection.select(F.col("id").alias("doc_id"), F.col("embedding").alias("vec"))
    got = V.cosine_top_k_indexed(encoded, asked, index).collect()
    assert recall(got, cosine_top_k(collection, asked, 5).collect()) == 1.0


def test_codes_and_no_questions(spark, indexed):
    collection, index, encoded = indexed[5_000]
    units = V._unit_rows(clustered(200).astype(float))
    cell, codes = index.codes(units)
    said = np.array([V._guesses(index, u[None], c, k[None])[0, 0] for u, c, k in zip(units, cell, codes)])
    assert np.abs(said - 1).mean() < 0.1
    none = spark.createDataFrame([], "query_id long, embedding array<float>")
    assert V.cosine_top_k_indexed(encoded, none, index).collect() == []
    assert V.encode_collection(collection.where("id < 0"), index).collect() == []
