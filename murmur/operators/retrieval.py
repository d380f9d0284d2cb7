"""Documents, embeddings and nearest neighbours."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from murmur.functions.scalars import preview, relevance
from murmur.functions.text import tokenize_words
from murmur.operators.ranking import latest_posts, most_common_terms
from murmur.operators.skew import hot_keys, top_n_per_group
from murmur.operators.topics import TOPICS, topic_filter

# Functions sent to tasks carry their code, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Questions that travel to every task in one piece; more meet the collection in blocks.
QUERIES_PER_PASS = 2_000
# Hits that are sent to the documents; more are joined as Spark sees fit.
HITS_SENT = 100_000


# --- documents ---------------------------------------------------------------------


def compose_document(
    posts: DataFrame,
    topic: str,
    key: str = "post_id",
    title_col: str | None = "cleaned_title",
    text_col: str = "cleaned_text",
    subreddit_col: str | None = "subreddit",
) -> DataFrame:
    """Document text, id and metadata. Ids come from the post key, so they do not move
    when rows do; a null title or text is skipped."""
    parts = [F.col(c) for c in (title_col, text_col) if c]
    subreddit = F.col(subreddit_col) if subreddit_col else F.lit(None).cast("string")
    return posts.select(
        F.concat(F.lit("doc_"), F.col(key).cast("string")).alias("id"),
        F.concat_ws("\n", *parts).alias("document"),
        F.struct(
            subreddit.alias("subreddit"),
            F.col(key).cast("string").alias("post_id"),
            F.lit(topic).alias("topic"),
        ).alias("metadata"),
    )


def fit_embedder(documents: DataFrame, text_col: str = "document", dims: int = 256) -> PipelineModel:
    """Default text embedder: hashed word counts, inverse document frequency, unit length."""
    stages = [
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=dims),
        IDF(inputCol="_tf", outputCol="_tfidf"),
        Normalizer(inputCol="_tfidf", outputCol="_unit"),
    ]
    return Pipeline(stages=stages).fit(_with_words(documents, text_col))


def _with_words(frame: DataFrame, text_col: str) -> DataFrame:
    return frame.withColumn(
        "_words", F.coalesce(tokenize_words(F.col(text_col)), F.array().cast("array<string>"))
    )


def embed_text(
    frame: DataFrame,
    model: PipelineModel | Callable[[pd.Series], np.ndarray],
    text_col: str = "document",
) -> DataFrame:
    """Adds `embedding array<float>`.

    `model` is a fitted embedder, or a function from a pandas batch of texts to a
    matrix (a user's own model), which runs Arrow batch by Arrow batch.
    """
    if hasattr(model, "transform"):
        unit = model.transform(_with_words(frame, text_col))
        return unit.select(
            *frame.columns, vector_to_array("_unit", "float32").alias("embedding")
        )
    embed = model

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            vectors = np.asarray(embed(part[text_col]), dtype=np.float32)
            yield part.assign(embedding=list(vectors))

    schema = ", ".join(f"`{n}` {t}" for n, t in frame.dtypes) + ", embedding array<float>"
    return frame.mapInPandas(batches, schema)


def build_collection(
    posts: DataFrame,
    topic: str,
    source: str,
    path: str,
    model: PipelineModel | Callable[[pd.Series], np.ndarray] | None = None,
    limit: int = 100,
    all_posts: DataFrame | None = None,
    topics: dict = TOPICS,
    **document_columns,
) -> DataFrame:
    """Newest documents of a topic with embeddings, written once per (source, topic).

    Running it again replaces that partition only. An embedder fitted here is stored beside
    the partition, for `collection_embedder`.
    """
    key = document_columns.get("key", "post_id")
    chosen = latest_posts(topic_filter(posts, topic, source, all_posts, topics), limit, key=key)
    documents = compose_document(chosen, topic, **document_columns)
    if model is None:
        model = fit_embedder(documents)
        model.write().overwrite().save(_embedder_path(path, source, topic))
    target = f"{path}/source={source}/topic={topic}"
    embed_text(documents, model).write.mode("overwrite").parquet(target)
    return posts.sparkSession.read.option("basePath", path).parquet(target)


def _embedder_path(path: str, source: str, topic: str) -> str:
    # Readers of the collection pass over names that begin with an underscore.
    return f"{path}/_embedders/source={source}/topic={topic}"


def collection_embedder(path: str, source: str, topic: str) -> PipelineModel:
    """The embedder that `build_collection` fitted; questions need the same one."""
    return PipelineModel.load(_embedder_path(path, source, topic))


# --- nearest neighbours ---------------------------------------------------------------


def _unit_rows(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)


def _best(distance: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k smallest by (distance, id); every tie at the edge is compared."""
    if len(distance) > k:
        edge = np.partition(distance, k - 1)[k - 1]
        near = np.flatnonzero(distance <= edge)
    else:
        near = np.arange(len(distance))
    return near[np.lexsort((ids[near], distance[near]))[:k]]


class _Nearest:
    """The k nearest documents seen so far for each question of a block."""

    def __init__(self, names: np.ndarray, matrix: np.ndarray, k: int):
        self.names, self.matrix, self.k = names, matrix, k
        self.best: list = [None] * len(names)

    def see(self, ids: np.ndarray, vectors: pd.Series) -> None:
        rows = _unit_rows(np.stack(vectors.to_numpy()).astype(np.float64))
        distances = np.round(1.0 - rows @ self.matrix.T, 12)
        for q in range(len(self.names)):
            d, i = distances[:, q], ids
            if self.best[q] is not None:
                d, i = np.concatenate([self.best[q][0], d]), np.concatenate([self.best[q][1], i])
            keep = _best(d, i, self.k)
            self.best[q] = (d[keep], i[keep])

    def found(self) -> pd.DataFrame | None:
        hits = [(n, b) for n, b in zip(self.names, self.best) if b is not None]
        if not hits:
            return None
        return pd.DataFrame(
            {
                "query_id": np.repeat([n for n, _ in hits], [len(b[0]) for _, b in hits]),
                "doc_id": np.concatenate([b[1] for _, b in hits]),
                "distance": np.concatenate([b[0] for _, b in hits]),
            }
        )


def _hit_schema(query_type: str, id_type: str) -> str:
    return f"query_id {query_type}, doc_id {id_type}, distance double"


def _scan(
    collection: DataFrame,
    names: np.ndarray,
    matrix: np.ndarray,
    k: int,
    id_col: str,
    vec_col: str,
    query_type: str,
) -> DataFrame:
    """Nearest `k` rows of each partition for each question: one matrix product per batch."""

    def partition(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        nearest = _Nearest(names, matrix, k)
        for part in parts:
            if not part.empty:
                nearest.see(part[id_col].to_numpy(), part[vec_col])
        found = nearest.found()
        if found is not None:
            yield found

    return collection.select(id_col, vec_col).mapInPandas(
        partition, _hit_schema(query_type, dict(collection.dtypes)[id_col])
    )


def cosine_top_k(
    collection: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_col: str = "id",
    vec_col: str = "embedding",
    query_id: str = "query_id",
    query_vec: str = "embedding",
    per_pass: int = QUERIES_PER_PASS,
) -> DataFrame:
    """(query_id, doc_id, distance, rank): the k nearest documents by cosine distance.

    Exact. Up to `per_pass` questions are read once and travel to the collection, which
    stays where it is: each task scans its rows against them and hands on at most k rows
    per question. More questions stay in the cluster: blocks of them meet blocks of the
    collection in its tasks, and again k rows per question leave a task.
    """
    asked = queries.select(F.col(query_id).alias("query_id"), F.col(query_vec).alias("_vec"))
    local = asked.limit(per_pass + 1).toPandas()
    if len(local) <= per_pass:
        return _closest(_scan_pass(collection, local, k, id_col, vec_col, asked.dtypes[0][1]), k)
    everywhere = F.array(F.lit("all")).alias("_cells")
    documents = collection.select(
        F.col(id_col).alias("doc_id"), F.col(vec_col).alias("_vec"), everywhere
    )
    met = _cell_join(documents, asked.select("*", everywhere), k, ROWS_PER_BLOCK, per_pass)
    return _closest(met, k)


ROWS_PER_BLOCK = 100_000


def _closest(hits: DataFrame, k: int) -> DataFrame:
    return top_n_per_group(
        hits, ["query_id"], [F.col("distance").asc(), F.col("doc_id").asc()], k, rank="rank"
    )


def _scan_pass(
    collection: DataFrame, local: pd.DataFrame, k: int, id_col: str, vec_col: str, query_type: str
) -> DataFrame:
    if local.empty:
        return collection.sparkSession.createDataFrame(
            [], _hit_schema(query_type, dict(collection.dtypes)[id_col])
        )
    names = local.iloc[:, 0].to_numpy()
    matrix = _unit_rows(np.stack(local.iloc[:, 1].to_numpy()).astype(np.float64))
    return _scan(collection, names, matrix, k, id_col, vec_col, query_type)


@dataclass(frozen=True)
class Buckets:
    """Random directions (tables x width x dimensions) and the length of a bucket along them.

    A question is compared with the cells within `reach` of its own place in each table: 0 is
    its own cell only, infinity the whole collection.
    """

    planes: np.ndarray
    length: float
    reach: float = 0.0


def random_planes(tables: int, width: int, dims: int, seed: int) -> np.ndarray:
    """Unit vectors, to six decimals. The first directions of a table do not depend on width."""
    drawn = np.random.default_rng(seed).normal(size=(tables, MOST_WIDTH, dims))[:, :width]
    return np.round(drawn / np.linalg.norm(drawn, axis=2, keepdims=True), 6)


MOST_WIDTH = 16
# Buckets that unit vectors are dealt into along one direction, about.
BUCKETS_OF_ONE = 4


def width_for(rows: int, per_cell: int) -> int:
    """Directions in a signature for about `per_cell` of `rows` documents in a cell."""
    width = 1
    while width < MOST_WIDTH and rows > per_cell * BUCKETS_OF_ONE**width:
        width += 1
    return width


# Questions that the reach of default buckets is learned on, and the share of their true
# neighbours it has to find.
TRIAL = 64
TRIAL_RECALL = 0.95
# Cells of a table that a question of the trial may reach; a narrower signature has fewer.
MOST_CELLS = 1_000
# Share of the collection from which on the plain scan is as cheap.
SCAN_SHARE = 0.5


def fit_buckets(
    collection: DataFrame,
    vec_col: str = "embedding",
    bucket_length: float = 0.25,
    tables: int = 4,
    width: int | None = None,
    per_cell: int = 64,
    seed: int = 42,
    k: int = 5,
    questions: DataFrame | None = None,
    query_vec: str = "embedding",
) -> Buckets:
    """More tables find more neighbours, a larger width leaves fewer candidates.

    By default the width grows with the logarithm of the collection, so that the documents
    in a cell stay about the same, and the reach is learned: TRIAL questions (of `questions`,
    else vectors of the collection) are answered by brute force in one scan, and the reach is
    what finds TRIAL_RECALL of their `k` nearest. A collection that would have half its rows
    compared gets an infinite reach, which is the exact scan. With a `width` given nothing is
    learned and the reach is 0.
    """
    seen = collection.agg(F.count(F.lit(1)), F.max(F.size(vec_col))).first()
    wide, dims = width or width_for(seen[0], per_cell), max(seen[1] or 0, 1)
    buckets = Buckets(random_planes(tables, wide, dims, seed), bucket_length)
    if width:
        return buckets
    vectors = collection.select(F.col(vec_col).alias("_vec"))
    asked = vectors if questions is None else questions.select(F.col(query_vec).alias("_vec"))
    trial = asked.distinct().orderBy(F.xxhash64("_vec")).limit(TRIAL).toPandas()
    if trial.empty:
        return buckets
    matrix = _unit_rows(np.stack(trial["_vec"].to_numpy()).astype(np.float64))
    return _with_reach(vectors, matrix, buckets, k, own=questions is None)


def _with_reach(
    vectors: DataFrame, matrix: np.ndarray, buckets: Buckets, k: int, own: bool
) -> Buckets:
    """`buckets`, narrower if need be, with the reach that the questions `matrix` ask for."""

    def nearest(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: list = [(np.zeros(0), np.zeros((0, buckets.planes.shape[1])))] * len(matrix)
        for rows in _unit_batches(parts):
            distance = np.round(1.0 - rows @ matrix.T, 12)
            if own:
                # A vector of the collection is no neighbour of itself, nor are its copies.
                distance[distance <= 1e-9] = np.inf
            for q in range(len(matrix)):
                top = _best(distance[:, q], np.arange(len(rows)), k)
                top = top[np.isfinite(distance[top, q])]
                gaps = np.sqrt(_gaps(matrix[q : q + 1], rows[top], buckets)[0].min(axis=1))
                every = np.concatenate([best[q][0], distance[top, q]])
                needs = np.concatenate([best[q][1], gaps])
                keep = np.argsort(every, kind="stable")[:k]
                best[q] = every[keep], needs[keep]
        found = [(q, d, n) for q, (every, needs) in enumerate(best) for d, n in zip(every, needs)]
        if found:
            yield pd.DataFrame(
                {"q": [f[0] for f in found], "distance": [f[1] for f in found], "needs": [list(f[2]) for f in found]}
            )

    hits = vectors.mapInPandas(nearest, "q int, distance double, needs array<double>")
    hits = top_n_per_group(hits, ["q"], [F.col("distance").asc()], k).select("needs").toPandas()
    if hits.empty:
        return buckets
    # By width, the distance of a neighbour's cell from the question's place.
    reaches = np.quantile(np.stack(hits["needs"].to_numpy()), TRIAL_RECALL, axis=0, method="higher")
    for width in range(len(reaches), 0, -1):
        reach = float(reaches[width - 1]) + 1e-9
        tried = Buckets(buckets.planes[:, :width], buckets.length, reach)
        if width == 1 or all(_cells_near(v, tried, MOST_CELLS) is not None for v in matrix):
            break

    def met(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _unit_batches(parts):
            near = _gaps(matrix, rows, tried)[..., -1] <= reach**2
            yield pd.DataFrame({"near": [int(near.sum())], "n": [len(rows) * len(matrix)]})

    pairs = vectors.mapInPandas(met, "near long, n long").agg(F.sum("near"), F.sum("n")).first()
    if pairs[0] >= SCAN_SHARE * pairs[1]:
        return Buckets(buckets.planes, buckets.length, float("inf"))
    return tried


def _unit_batches(parts: Iterator[pd.DataFrame]) -> Iterator[np.ndarray]:
    for part in parts:
        for at in range(0, len(part), 512):
            yield _unit_rows(np.stack(part["_vec"].iloc[at : at + 512].to_numpy()).astype(np.float64))


def _gaps(asked: np.ndarray, rows: np.ndarray, buckets: Buckets) -> np.ndarray:
    """Squared distance from the place of a question to the cell of a row, by question, row,
    table and width."""
    place = np.einsum("qd,twd->qtw", asked, buckets.planes)[:, None]
    low = np.floor(np.einsum("nd,twd->ntw", rows, buckets.planes) / buckets.length) * buckets.length
    gap = np.maximum(np.maximum(low - place, place - low - buckets.length), 0.0)
    return np.cumsum(gap**2, axis=3)


def _cells_near(vector: np.ndarray, buckets: Buckets, most: int | None = None) -> list[str] | None:
    """Signatures of the cells within reach of a unit vector; null if a table has over `most`."""
    length, found = buckets.length, []
    every = np.arange(np.floor(-1 / length) - 1, np.floor(1 / length) + 2).astype(np.int64)
    for t, table in enumerate(buckets.planes):
        cells, gaps = np.zeros((1, 0), np.int64), np.zeros(1)
        for x in table @ vector:
            gap = np.maximum(np.maximum(every * length - x, x - (every + 1) * length), 0.0) ** 2
            total = gaps[:, None] + gap[None, :]
            i, j = np.nonzero(total <= buckets.reach**2)
            cells, gaps = np.concatenate([cells[i], every[j][:, None]], axis=1), total[i, j]
            if most is not None and len(cells) > most:
                return None
        found += [f"{t}:" + ",".join(map(str, cell)) for cell in cells.tolist()]
    return found


def _with_cells_near(frame: DataFrame, buckets: Buckets, vec_col: str) -> DataFrame:
    """`_signatures` of questions: every cell within reach."""

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for at in range(0, len(part), 64):
                few = part.iloc[at : at + 64]
                units = _unit_rows(np.stack(few[vec_col].to_numpy()).astype(np.float64))
                yield few.assign(_cells=[_cells_near(v, buckets) for v in units])

    schema = ", ".join(f"`{n}` {t}" for n, t in frame.dtypes) + ", _cells array<string>"
    return frame.mapInPandas(batches, schema)


def _signatures(frame: DataFrame, buckets: Buckets, vec_col: str) -> DataFrame:
    """Adds `_cells`: the signature of each table as ``table:bucket,bucket``."""

    def dot(a: Column, b: Column) -> Column:
        products = F.zip_with(a, b, lambda x, y: x * y)
        return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)

    vector = F.transform(vec_col, lambda x: x.cast("double"))
    norm = F.sqrt(dot(vector, vector))
    planes = F.array(
        *[
            F.array(*[F.array(*[F.lit(float(x)) for x in plane]) for plane in table])
            for table in buckets.planes
        ]
    )

    def bucket(plane: Column) -> Column:
        along = F.try_divide(dot(F.col("_double"), plane), F.col("_norm"))
        return F.floor(F.coalesce(along, F.lit(0.0)) / F.lit(buckets.length)).cast("string")

    def cell(table: Column, number: Column) -> Column:
        return F.concat(
            number.cast("string"), F.lit(":"), F.array_join(F.transform(table, bucket), ",")
        )

    return (
        frame.withColumn("_double", vector)
        .withColumn("_norm", norm)
        .withColumn("_cells", F.transform(planes, cell))
        .select(*frame.columns, "_cells")
    )


def cosine_top_k_approx(
    collection: DataFrame,
    queries: DataFrame,
    buckets: Buckets,
    k: int = 5,
    id_col: str = "id",
    vec_col: str = "embedding",
    query_id: str = "query_id",
    query_vec: str = "embedding",
    rows_per_task: int = 100_000,
) -> DataFrame:
    """`cosine_top_k` over the documents whose cells are within reach of the question.

    A question is compared with the documents of these cells, however many questions are
    asked at once. Distances are exact; a neighbour beyond reach in every table is missed.
    """
    if np.isinf(buckets.reach):
        return cosine_top_k(collection, queries, k, id_col, vec_col, query_id, query_vec)
    documents = _signatures(
        collection.select(F.col(id_col).alias("doc_id"), F.col(vec_col).alias("_vec")),
        buckets,
        "_vec",
    )
    asked = (_with_cells_near if buckets.reach else _signatures)(
        queries.select(F.col(query_id).alias("query_id"), F.col(query_vec).alias("_vec")),
        buckets,
        "_vec",
    )
    met = _cell_join(documents, asked, k, rows_per_task, rows_per_task)
    return _closest(met.distinct(), k)


def _cell_join(
    documents: DataFrame, asked: DataFrame, k: int, rows_per_task: int, questions_per_task: int
) -> DataFrame:
    """Nearest documents of each question within each common signature.

    Of equal vectors only the k smallest ids can be among the k nearest, so the
    rest go first. A signature with more than `rows_per_task` documents or
    questions is split on that side and the other side repeated, so no task
    holds more than about that many of either. No pairs leave a task: a question
    hands on k documents per part.
    """
    documents = top_n_per_group(documents, ["_vec"], [F.col("doc_id").asc()], k)
    docs = documents.select(F.explode("_cells").alias("cell"), "doc_id", "_vec")
    questions = asked.select(F.explode("_cells").alias("cell"), "query_id", "_vec")
    many_docs = hot_keys(docs, ["cell"], rows_per_task, ["doc_id"])
    many_questions = hot_keys(questions, ["cell"], questions_per_task, ["query_id"])

    def split(rows: DataFrame, own: DataFrame, key: str, salt: str) -> DataFrame:
        part = F.pmod(F.xxhash64(key), F.coalesce(F.col("_parts"), F.lit(1)).cast("bigint"))
        joined = rows.join(own, "cell", "left")
        return joined.withColumn(salt, part.cast("int")).drop("_parts")

    def repeat(rows: DataFrame, other: DataFrame, salt: str) -> DataFrame:
        every = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
        joined = rows.join(other, "cell", "left")
        return joined.withColumn(salt, F.explode(every)).drop("_parts")

    left = repeat(split(docs, many_docs, "doc_id", "_d"), many_questions, "_q")
    right = repeat(split(questions, many_questions, "query_id", "_q"), many_docs, "_d")
    types = dict(asked.dtypes)["query_id"], dict(documents.dtypes)["doc_id"]

    def compare(docs_part: pd.DataFrame, asked_part: pd.DataFrame) -> pd.DataFrame:
        hits = []
        if len(docs_part) and len(asked_part):
            for q in range(0, len(asked_part), 1024):
                block = asked_part.iloc[q : q + 1024]
                matrix = _unit_rows(np.stack(block["_vec"].to_numpy()).astype(np.float64))
                nearest = _Nearest(block["query_id"].to_numpy(), matrix, k)
                for d in range(0, len(docs_part), 8192):
                    rows = docs_part.iloc[d : d + 8192]
                    nearest.see(rows["doc_id"].to_numpy(), rows["_vec"])
                hits.append(nearest.found())
        if not hits:
            return pd.DataFrame({"query_id": [], "doc_id": [], "distance": []})
        return pd.concat(hits)

    keys = ["cell", "_d", "_q"]
    return (
        left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, _hit_schema(*types))
    )


# --- answers ------------------------------------------------------------------------


def with_documents(
    hits: DataFrame, documents: DataFrame, id_col: str = "doc_id", at_most: int | None = None
) -> DataFrame:
    """The documents of the hits. `at_most` is a bound on their number, as k x questions: up
    to HITS_SENT of them go to the documents, whose text then stays where it is."""
    few = at_most is not None and at_most <= HITS_SENT
    return documents.join(F.broadcast(hits) if few else hits, id_col)


def document_preview(hits: DataFrame, document_col: str = "document") -> DataFrame:
    """First 200 characters and relevance of each hit."""
    return hits.select(
        "query_id",
        "rank",
        "doc_id",
        preview(F.col(document_col)).alias("preview"),
        relevance(F.col("distance")).alias("relevance"),
    )


def retrieval_context(hits: DataFrame, document_col: str = "document") -> DataFrame:
    """The hits of each question as one text, best first, blank lines between.

    A question has at most k hits, so the list it gathers is small.
    """
    ranked = F.array_sort(F.collect_list(F.struct("rank", F.col(document_col).alias("document"))))
    return hits.groupBy("query_id").agg(
        F.array_join(F.transform(ranked, lambda r: r["document"]), "\n\n").alias("context")
    )


def wordcloud_weights(
    counts: DataFrame,
    n: int = 50,
    min_size: float = 14.0,
    max_size: float = 48.0,
    group: tuple[str, ...] = (),
) -> DataFrame:
    """Top words with font size and blue value scaled by frequency, in the whole or in each
    `group` of the counts. A window spans n rows."""
    if group:
        order = [F.col("occurrences").desc(), F.col("term").asc()]
        top = top_n_per_group(counts, list(group), order, n)
    else:
        top = most_common_terms(counts, n)
    everything = Window.partitionBy(*group)
    low, high = F.min("occurrences").over(everything), F.max("occurrences").over(everything)
    factor = (F.col("occurrences") - low) / F.greatest(high - low, F.lit(1))
    return top.withColumn("_f", factor).select(
        *group,
        "term",
        "occurrences",
        (F.lit(min_size) + F.lit(max_size - min_size) * F.col("_f")).alias("font_size"),
        F.floor(F.lit(155) + F.lit(100) * F.col("_f")).cast("int").alias("blue"),
    )


def question_frame(
    spark: SparkSession, questions: dict[str, str], model: PipelineModel
) -> DataFrame:
    """Questions as query vectors of the collection's own embedder."""
    asked = spark.createDataFrame(list(questions.items()), "query_id string, document string")
    return embed_text(asked, model).select("query_id", "embedding")


def mean_vectors(frame: DataFrame, group: str, vec_col: str = "embedding") -> DataFrame:
    """Mean vector per group; sums are merged inside each task before the shuffle."""
    vectors = frame.select(
        group, array_to_vector(F.col(vec_col).cast("array<double>")).alias("_vector")
    )
    return vectors.groupBy(group).agg(
        vector_to_array(Summarizer.mean(F.col("_vector"))).alias(vec_col)
    )
