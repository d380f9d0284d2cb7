import numpy as np
import pytest
from pyspark.sql import functions as F

from murmur.operators import retrieval
from murmur.operators.topics import communities


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(7)
    matrix = rng.normal(size=(400, 16))
    matrix[100:230] = matrix[100]  # a group of copies
    matrix[399] = 0
    return matrix


@pytest.fixture(scope="module")
def collection(spark, vectors):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "id long, embedding array<double>").repartition(5)


def brute(vectors, questions, k):
    def unit(m):
        n = np.linalg.norm(m, axis=1, keepdims=True)
        return np.divide(m, n, out=np.zeros_like(m), where=n > 0)

    distance = np.round(1 - unit(questions) @ unit(vectors).T, 9)
    found = []
    for q, row in enumerate(distance):
        order = sorted(range(len(row)), key=lambda i: (row[i], i))[:k]
        found += [(q, i, r + 1) for r, i in enumerate(order)]
    return found


@pytest.mark.parametrize("per_pass", [2000, 3])
def test_exact_neighbours_equal_brute_force(spark, collection, vectors, per_pass):
    questions = np.vstack([vectors[[100, 5, 399]], np.ones((4, 16))])
    asked = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(questions)],
        "query_id int, embedding array<double>",
    )
    got = retrieval.cosine_top_k(collection, asked, 5, per_pass=per_pass)
    found = sorted((r.query_id, r["rank"], r.doc_id) for r in got.collect())
    assert found == sorted((q, r, i) for q, i, r in brute(vectors, questions, 5))


def test_no_questions_no_hits(spark, collection):
    none = spark.createDataFrame([], "query_id int, embedding array<double>")
    assert retrieval.cosine_top_k(collection, none, 5).count() == 0


def ask(spark, matrix):
    return spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(matrix)],
        "query_id int, embedding array<double>",
    )


@pytest.mark.parametrize("rows_per_task", [10**5, 20])
def test_approximate_neighbours_recall(spark, collection, vectors, rows_per_task):
    """The last case splits crowded signatures on both sides."""
    questions = np.vstack([vectors[240:270] + 0.05, vectors[[100]]])
    buckets = retrieval.fit_buckets(collection, bucket_length=0.5, tables=8, width=2)
    got = retrieval.cosine_top_k_approx(
        collection, ask(spark, questions), buckets, 3, rows_per_task=rows_per_task
    )
    hits = got.collect()
    assert len({(r.query_id, r.doc_id) for r in hits}) == len(hits)
    found = {(r.query_id, r.doc_id) for r in hits}
    exact = {(q, i) for q, i, _ in brute(vectors, questions, 3)}
    assert len(found & exact) / len(exact) >= 0.6
    nearest = {(q, i) for q, i, r in brute(vectors, questions, 3) if r == 1}
    assert len(found & nearest) / len(nearest) >= 0.9
    copies = [(r["rank"], r.doc_id) for r in hits if r.query_id == 30]
    assert sorted(copies) == [(1, 100), (2, 101), (3, 102)]


def test_cell_join_splits_do_not_change_the_answer(spark, collection, vectors):
    buckets = retrieval.fit_buckets(collection, bucket_length=0.5, tables=3, width=1)
    asked = ask(spark, vectors[230:330])

    def rows(n):
        got = retrieval.cosine_top_k_approx(
            collection, asked, buckets, 4, rows_per_task=n
        )
        return sorted((r.query_id, r["rank"], r.doc_id) for r in got.collect())

    assert rows(15) == rows(10**5)


def test_approximate_scan_prunes(spark, collection):
    buckets = retrieval.fit_buckets(collection, bucket_length=0.1, tables=2, width=2)
    asked = collection.where("id = 5").select(F.lit(0).alias("query_id"), "embedding")
    got = retrieval.cosine_top_k_approx(collection, asked, buckets, 400)
    assert 1 <= got.count() < 200
    assert got.where("rank = 1").collect()[0].doc_id == 5


def test_an_answer_does_not_depend_on_the_other_questions(spark, collection, vectors):
    buckets = retrieval.fit_buckets(collection, bucket_length=0.5, tables=3, width=2)

    def rows(asked):
        got = retrieval.cosine_top_k_approx(collection, asked, buckets, 4)
        return sorted((r.query_id, r["rank"], r.doc_id) for r in got.where("query_id = 0").collect())

    assert rows(ask(spark, vectors[230:231])) == rows(ask(spark, vectors[230:330]))


def test_cells_stay_small_as_the_collection_grows(spark):
    pairs = []
    for n in (500, 8000):
        x = np.random.default_rng(n).normal(size=(n, 24))
        frame = spark.createDataFrame(
            [(i, v.tolist()) for i, v in enumerate(x)], "id int, embedding array<double>"
        )
        cells = retrieval._signatures(frame, retrieval.fit_buckets(frame), "embedding")
        sizes = cells.select(F.explode("_cells").alias("c")).groupBy("c").count()
        pairs.append(sizes.agg(F.sum(F.col("count") ** 2)).first()[0] / n)
    assert pairs[1] < 4 * pairs[0]


@pytest.mark.parametrize("n, clustered", [(1000, False), (6000, True)])
def test_default_buckets_keep_recall_at_every_size(spark, n, clustered):
    rng = np.random.default_rng(n)
    centers = rng.normal(size=(n // 20, 32))
    x = centers[np.arange(n) % len(centers)] + 0.4 * rng.normal(size=(n, 32))
    if not clustered:
        x = rng.normal(size=(n, 32))
    frame = spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(x)], "id long, embedding array<double>"
    )
    questions = x[:40] + 0.1 * rng.normal(size=(40, 32))
    buckets = retrieval.fit_buckets(frame)
    hits = retrieval.cosine_top_k_approx(frame, ask(spark, questions), buckets, 5).collect()
    exact = {(q, i) for q, i, _ in brute(x, questions, 5)}
    assert len({(r.query_id, r.doc_id) for r in hits} & exact) / len(exact) >= 0.9
    # At the larger size cells answer, not the scan.
    assert np.isfinite(buckets.reach) or n < 6000 or not clustered


POSTS = "post_id string, subreddit string, cleaned_title string, cleaned_text string, created long"


@pytest.fixture(scope="module")
def posts(spark):
    rows = [
        (f"p{i:02d}", "s" if i % 2 else "t", f"title {i}", f"cats and dogs number{i}", i)
        for i in range(20)
    ]
    rows += [("n1", "s", None, "lonely text", 99), ("n2", "s", "kept out", None, 100)]
    return spark.createDataFrame(rows, POSTS)


def test_compose_skips_nulls(posts):
    got = {r.id: r for r in retrieval.compose_document(posts, "x").collect()}
    assert got["doc_n1"].document == "lonely text"
    assert got["doc_p03"].document == "title 3\ncats and dogs number3"
    assert tuple(got["doc_p03"].metadata) == ("s", "p03", "x")


def test_build_collection_and_ask(spark, posts, tmp_path):
    path = str(tmp_path / "c")
    topics = {"pets": {"posts": communities(["s"])}}
    documents = retrieval.compose_document(posts.where("cleaned_text is not null"), "pets")
    model = retrieval.fit_embedder(documents, dims=64)
    build = lambda: retrieval.build_collection(
        posts, "pets", "posts", path, model, limit=5, topics=topics
    )
    build()
    collection = build()
    rows = spark.read.parquet(path)
    assert rows.count() == 5 and {r.source for r in rows.collect()} == {"posts"}
    assert {r.id for r in rows.collect()} == {"doc_n1", "doc_p19", "doc_p17", "doc_p15", "doc_p13"}
    asked = retrieval.question_frame(spark, {"q": "lonely text"}, model)
    hits = retrieval.cosine_top_k(collection, asked, 2)
    best = hits.where("rank = 1").collect()[0]
    assert best.doc_id == "doc_n1" and abs(best.distance) < 1e-6
    found = retrieval.with_documents(hits, collection.withColumnRenamed("id", "doc_id"))
    context = retrieval.retrieval_context(found).collect()[0].context
    assert context.startswith("lonely text\n\n")
    shown = retrieval.document_preview(found).where("rank = 1").collect()[0]
    assert (shown.preview, shown.relevance) == ("lonely text...", 1.0)


def test_own_model_runs_on_batches(spark, posts):
    def model(texts):
        return np.array([[len(t), 1.0] for t in texts])

    got = retrieval.embed_text(retrieval.compose_document(posts, "x"), model)
    row = got.where("id = 'doc_n1'").collect()[0]
    assert row.embedding == [11.0, 1.0]


def test_embeddings_are_unit_vectors(spark, posts):
    documents = retrieval.compose_document(posts, "x")
    got = retrieval.embed_text(documents, retrieval.fit_embedder(documents, dims=32)).collect()
    norms = {round(float(np.linalg.norm(r.embedding)), 4) for r in got}
    assert norms <= {0.0, 1.0} and all(len(r.embedding) == 32 for r in got)


def test_wordcloud_weights(spark):
    counts = spark.createDataFrame([("a", 11), ("b", 6), ("c", 1)], "term string, occurrences long")
    got = retrieval.wordcloud_weights(counts).orderBy("term").collect()
    assert [(r.font_size, r.blue) for r in got] == [(48.0, 255), (31.0, 205), (14.0, 155)]
    same = counts.withColumn("occurrences", F.lit(3).cast("long"))
    assert {r.font_size for r in retrieval.wordcloud_weights(same).collect()} == {14.0}


def test_mean_vectors(spark):
    frame = spark.createDataFrame(
        [(0, [1.0, 3.0]), (0, [3.0, 5.0]), (1, [2.0, 2.0])], "label int, embedding array<float>"
    )
    got = {r.label: list(r.embedding) for r in retrieval.mean_vectors(frame, "label").collect()}
    assert got == {0: [2.0, 4.0], 1: [2.0, 2.0]}


def test_a_collection_keeps_the_embedder_it_fitted(spark, posts, tmp_path):
    path = str(tmp_path / "c")
    topics = {"pets": {"posts": communities(["s"])}}
    collection = retrieval.build_collection(posts, "pets", "posts", path, limit=5, topics=topics)
    assert spark.read.parquet(path).count() == 5
    model = retrieval.collection_embedder(path, "posts", "pets")
    asked = retrieval.question_frame(spark, {"q": "lonely text"}, model)
    best = retrieval.cosine_top_k(collection, asked, 1).collect()[0]
    assert best.doc_id == "doc_n1"


def test_word_weights_per_question(spark):
    from murmur.operators.engagement import word_frequencies

    frame = spark.createDataFrame(
        [("q1", "cats cats dogs"), ("q2", "birds"), ("q2", "birds fish fish fish")], "query_id string, t string"
    )
    counts = word_frequencies(frame, "t", ("query_id",))
    got = retrieval.wordcloud_weights(counts, 1, group=("query_id",)).collect()
    assert sorted((r.query_id, r.term, r.occurrences) for r in got) == [("q1", "cats", 2), ("q2", "fish", 3)]
