"""Nearest neighbours by inner product with a forest of sorted hash strings (LSH Forest)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmur.llm.common import partitions, ship, stored

ship(__name__)

TREES = 16
# Bits of a hash string that the sorted arrays are cut by; 2^MOST_BITS cells a tree at most.
MOST_BITS = 16
ROWS_PER_CELL = 8
# The hyperplanes pass through the middle of at most so many vectors, those of the
# smallest hash.
FIT_ROWS = 4096
# As many queries at most, those of the smallest hash, are answered by brute force to
# learn how many candidates reach the wanted recall.
CALIBRATED = 128
RECALL = 0.96
# Rows of a stretch of a sorted array that one step compares with its queries.
STRETCH = 8192
QUERIES_AT_ONCE = 256
# Neighbours kept besides the wanted ones until the exact scores are known.
SPARE = 8


@dataclass
class Forest:
    """Everything that is needed to hash a vector; its size does not depend on the data."""

    planes: np.ndarray  # trees x bits x (dimension + 1)
    middle: np.ndarray  # trees x bits
    top: float  # largest squared length
    bits: int

    def hashes(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        """Hash strings as integers, first bit highest: rows x trees.

        One more component makes all vectors of equal length, so that nearest by angle is
        largest inner product; it is 0 for queries.
        """
        rest = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(self.top - (vectors**2).sum(axis=1), 0))
        whole = np.concatenate([vectors, rest[:, None]], axis=1)
        trees = len(self.planes)
        out = np.zeros((len(vectors), trees), np.int64)
        for t in range(trees):
            sides = whole @ self.planes[t].T > self.middle[t]
            out[:, t] = sides @ (1 << np.arange(self.bits - 1, -1, -1, dtype=np.int64))
        return out


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector of the rows that take part, of the most frequent dimension.

    Without an id, null, zero, or with null or non-finite components: no part.
    """
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").where(
        F.col("vec_id").isNotNull()
        & F.col("embedding").isNotNull()
        & ~F.coalesce(bad, F.lit(True))
        & F.exists("embedding", lambda x: x != 0)
    )
    sizes = good.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return good.where(F.size("embedding") == (sizes["n"] if sizes else 0)).select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("vector")
    )


def fit(distinct: DataFrame, trees: int, seed: int) -> Forest | None:
    sample = distinct.select("vid", "vector").orderBy(F.xxhash64("vid"), "vid").limit(FIT_ROWS).toPandas()
    if not len(sample):
        return None
    total = distinct.agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)).alias("top"),
    ).first()
    rows = np.stack(sample["vector"].to_numpy())
    bits = int(np.clip(np.ceil(np.log2(max(total["n"] / ROWS_PER_CELL, 2))), 1, MOST_BITS))
    planes = np.random.default_rng(seed).normal(size=(trees, bits, rows.shape[1] + 1))
    forest = Forest(planes, np.zeros((trees, bits)), float(total["top"]), bits)
    rest = np.sqrt(np.maximum(forest.top - (rows**2).sum(axis=1), 0))
    whole = np.concatenate([rows, rest[:, None]], axis=1)
    forest.middle = np.stack([np.median(whole @ p.T, axis=0) for p in planes])
    return forest


def cell_starts(distinct: DataFrame, forest: Forest) -> np.ndarray:
    """Where each cell begins in its tree's sorted array: trees x (2^bits + 1).

    Counted over all vectors, in each task first; 2^MOST_BITS cells a tree at most.
    """
    trees, cells = len(forest.planes), 1 << forest.bits

    def run(batches):
        counts = np.zeros((trees, cells), np.int64)
        for batch in batches:
            if batch.num_rows:
                for t, column in enumerate(forest.hashes(matrix(batch.column("vector"))).T):
                    counts[t] += np.bincount(column, minlength=cells)
        tree, cell = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(tree, pa.int32()), pa.array(cell, pa.int32()), pa.array(counts[tree, cell])],
            ["tree", "cell", "n"],
        )

    rows = (
        distinct.select("vector")
        .mapInArrow(run, "tree int, cell int, n long")
        .groupBy("tree", "cell")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    starts = np.zeros((trees, cells + 1), np.int64)
    starts[rows["tree"], rows["cell"] + 1] = rows["n"]
    return np.cumsum(starts, axis=1)


def level_counts(hashes: np.ndarray, starts: np.ndarray, bits: int) -> np.ndarray:
    """Rows that share a prefix of each length 0..bits with a query, over all trees."""
    out = np.zeros((len(hashes), bits + 1), np.int64)
    for length in range(bits + 1):
        drop = bits - length
        low = hashes >> drop << drop
        for t in range(hashes.shape[1]):
            out[:, length] += starts[t][low[:, t] + (1 << drop)] - starts[t][low[:, t]]
    return out


def lengths_for(counts: np.ndarray, wanted: float) -> np.ndarray:
    """The synchronous ascent: the longest prefix length at which all trees together give
    `wanted` rows; 0, which is every row, if none does."""
    enough = counts >= wanted
    return np.where(enough.any(axis=1), counts.shape[1] - 1 - enough[:, ::-1].argmax(axis=1), 0)


def candidates_wanted(
    distinct: DataFrame, queries: DataFrame, forest: Forest, starts: np.ndarray, k: int, recall: float
) -> float:
    """How many candidates (counted in every tree) reach `recall`, by a brute-force trial.

    A stated number of queries meets all rows in blocks; a task hands on k rows a query. A
    neighbour is found at a prefix length if some tree shares as much with the query.
    """
    sample = queries.orderBy(F.xxhash64("qid"), "qid").limit(CALIBRATED).toPandas()
    asked, ids = np.stack(sample["vector"].to_numpy()), sample["qid"].to_numpy(np.int64)
    own = forest.hashes(asked, query=True)
    bits = forest.bits

    def run(batches):
        best = np.full((len(asked), k), -np.inf)
        shared = np.full((len(asked), k), -1, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, vids = matrix(batch.column("vector")), batch.column("vid").to_numpy()
            scores = asked @ rows.T
            scores[ids[:, None] == vids[None, :]] = -np.inf
            hashes = forest.hashes(rows)
            few = min(k, len(rows))
            top = np.argpartition(-scores, few - 1, axis=1)[:, :few]
            for i in range(len(asked)):
                differ = hashes[top[i]] ^ own[i]
                length = bits - np.ceil(np.log2(differ + 1)).astype(np.int64).min(axis=1)
                every = np.concatenate([best[i], scores[i, top[i]]])
                levels = np.concatenate([shared[i], length])
                keep = np.argsort(-every, kind="stable")[:k]
                best[i], shared[i] = every[keep], levels[keep]
        at, rank = np.nonzero(shared >= 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(best[at, rank]), pa.array(shared[at, rank])], ["at", "score", "length"]
        )

    first = F.row_number().over(Window.partitionBy("at").orderBy(F.desc("score"), F.desc("length")))
    found = (
        distinct.select("vid", "vector")
        .mapInArrow(run, "at long, score double, length long")
        .withColumn("_rank", first)
        .where(F.col("_rank") <= k)
        .select("at", "length")
        .toPandas()
    )
    if not len(found):
        return 1.0
    counts = level_counts(own, starts, bits)
    at, length = found["at"].to_numpy(), found["length"].to_numpy()
    for wanted in np.unique(np.geomspace(k, max(counts[:, 0].max(), k + 1), 60).astype(np.int64)):
        if (length >= lengths_for(counts, wanted)[at]).mean() >= recall:
            return float(wanted)
    return float(counts[:, 0].max())


def _exact(asked: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Scores as `_dot` has them: products summed in order of the components."""
    return np.add.accumulate(asked * rows, axis=-1)[..., -1]


def _top(asked: np.ndarray, rows: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, exact scores) of the `n` best rows of each query by score, then id.

    The matrix product leaves out what is surely behind; every row that may tie with the
    last place is compared exactly.
    """
    rough = asked @ rows.T
    top = np.argpartition(-rough, n - 1, axis=1)[:, :n]
    edge = np.take_along_axis(rough, top, axis=1).min(axis=1)
    length = np.linalg.norm(asked, axis=1) * np.sqrt((rows**2).sum(axis=1).max())
    near = rough >= (edge - 1e-15 * (rows.shape[1] + 4) * length)[:, None]
    for i in np.flatnonzero(near.sum(axis=1) > n):
        at = np.flatnonzero(near[i])
        top[i] = at[np.lexsort((ids[at], -_exact(asked[i], rows[at])))[:n]]
    return top, _exact(asked[:, None], rows[top])


ROWS = "tree int, stretch long, part int, kind int, id long, low long, high long, vector array<double>"


def _plan(starts: np.ndarray):
    """(stretch of each cell, parts of each stretch) by tree."""
    stretch = starts[:, :-1] // STRETCH
    parts = []
    for t in range(len(starts)):
        rows = np.bincount(stretch[t], np.diff(starts[t]), minlength=int(stretch[t].max()) + 1)
        parts.append(np.maximum(1, np.ceil(rows / (2 * STRETCH))).astype(np.int64))
    return stretch, parts


def _batch(columns: list[np.ndarray], kind: int, vectors: np.ndarray) -> pa.RecordBatch:
    tree, stretch, part, ids, low, high, at = columns
    flat = pa.array(vectors[at].ravel())
    offsets = pa.array(np.arange(len(at) + 1, dtype=np.int32) * vectors.shape[1])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(tree.astype(np.int32)), pa.array(stretch), pa.array(part.astype(np.int32)),
            pa.array(np.full(len(at), kind, np.int32)), pa.array(ids), pa.array(low), pa.array(high),
            pa.ListArray.from_arrays(offsets, flat),
        ],
        ["tree", "stretch", "part", "kind", "id", "low", "high", "vector"],
    )


def _data_rows(forest: Forest, starts: np.ndarray):
    def run(batches):
        stretch, parts = _plan(starts)
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                few = batch.slice(at, 2000)
                vectors, ids = matrix(few.column("vector")), few.column("vid").to_numpy()
                for t, cell in enumerate(forest.hashes(vectors).T):
                    where = stretch[t][cell]
                    spread = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
                    part = spread.astype(np.int64) % parts[t][where]
                    rows = np.arange(len(ids))
                    yield _batch([np.full(len(ids), t), where, part, ids, cell, cell, rows], 0, vectors)

    return run


def _query_rows(forest: Forest, starts: np.ndarray, wanted: float):
    def run(batches):
        stretch, parts = _plan(starts)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                few = batch.slice(at, 500)
                vectors, ids = matrix(few.column("vector")), few.column("qid").to_numpy()
                hashes = forest.hashes(vectors, query=True)
                length = lengths_for(level_counts(hashes, starts, forest.bits), wanted)
                drop = forest.bits - length
                for t in range(hashes.shape[1]):
                    low = hashes[:, t] >> drop << drop
                    high = low + (1 << drop)
                    rows = []
                    for i in np.flatnonzero(starts[t][high] > starts[t][low]):
                        for s in range(stretch[t][low[i]], stretch[t][high[i] - 1] + 1):
                            for p in range(parts[t][s]):
                                rows.append((t, s, p, ids[i], low[i], high[i], i))
                    if rows:
                        yield _batch(list(np.array(rows, np.int64).T), 1, vectors)

    return run


def _nearest(k: int):
    """Of rows sorted by stretch, then data before queries: the k best rows of the range of
    each query. A stretch is held at a time, 2 x STRETCH rows or so."""

    def compare(data, asked):
        if not data or not asked:
            return
        ids = np.concatenate([d[0] for d in data])
        cells = np.concatenate([d[1] for d in data])
        rows = np.concatenate([d[2] for d in data])
        order = np.argsort(cells, kind="stable")
        ids, cells, rows = ids[order], cells[order], rows[order]
        qid, low, high, vectors = (np.concatenate([a[i] for a in asked]) for i in range(4))
        for span in np.unique(np.stack([low, high], axis=1), axis=0):
            begin, end = np.searchsorted(cells, span)
            if begin == end:
                continue
            mine = np.flatnonzero((low == span[0]) & (high == span[1]))
            for at in range(0, len(mine), QUERIES_AT_ONCE):
                few = mine[at : at + QUERIES_AT_ONCE]
                n = min(k, end - begin)
                top, scores = _top(vectors[few], rows[begin:end], ids[begin:end], n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(qid[few], n)),
                        pa.array(ids[begin:end][top].ravel()),
                        pa.array(scores.ravel()),
                    ],
                    ["qid", "vid", "rough"],
                )

    def run(batches):
        data, asked, here = [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("tree", "stretch", "part")], axis=1)
            new = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
            for begin, end in zip(new, [*new[1:], len(keys)]):
                key = tuple(keys[begin])
                if key != here:
                    yield from compare(data, asked)
                    data, asked, here = [], [], key
                part = batch.slice(int(begin), int(end - begin))
                kind = part.column("kind").to_numpy()
                vectors = matrix(part.column("vector"))
                ids, low, high = (part.column(c).to_numpy() for c in ("id", "low", "high"))
                rows = kind == 0
                if rows.any():
                    data.append((ids[rows], low[rows], vectors[rows]))
                if not rows.all():
                    asked.append((ids[~rows], low[~rows], high[~rows], vectors[~rows]))
        yield from compare(data, asked)

    return run


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    trees: int = TREES,
    recall: float = RECALL,
    seed: int = 11,
    name: str = "forest",
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of each query found, nearest first.

    `vectors` has vec_id and embedding; `is_query` tells the queries. Candidates are all
    rows but the query's own. Equal vectors are searched once, as data and as queries; of a
    vector's copies the k + 1 smallest ids can be in an answer and no more are carried. Rows
    equal in vec_id and vector count once; several vectors of one vec_id are several rows.
    Of candidates that tie, those of the smallest vec_id are taken.

    Each tree is a sorted array of hash strings, kept as stretches of rows in range order.
    A query descends to the rows that share its longest prefix; all trees then ascend
    together, a bit at a time, until they hold the wanted number of candidates, which is a
    stretch of rows in each tree. That number is learned on a fixed number of queries, so
    that it suits the data: few for clustered vectors, many for structureless ones.
    Scores are sums of products in double precision, in order of the components.
    """
    rows = usable(vectors)
    copies = Window.partitionBy("vector").orderBy("vec_id")
    members = stored(
        rows.distinct().withColumn("copy", F.row_number().over(copies))
        .where(F.col("copy") <= k + 1)
        .withColumn("vid", F.first("vec_id").over(copies)),
        f"{name}-members",
    )
    distinct = members.where("copy = 1").select("vid", "vector")
    asked = rows.where(is_query).distinct()
    queries = stored(asked.groupBy("vector").agg(F.min("vec_id").alias("qid")).select("qid", "vector"), f"{name}-queries")
    forest = fit(distinct, trees, seed)
    empty = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if forest is None or queries.isEmpty():
        return empty
    starts = cell_starts(distinct, forest)
    wanted = candidates_wanted(distinct, queries, forest, starts, k, recall)
    met = distinct.mapInArrow(_data_rows(forest, starts), ROWS).unionAll(
        queries.mapInArrow(_query_rows(forest, starts, wanted), ROWS)
    )
    found = (
        met.repartition(partitions(vectors.sparkSession), "tree", "stretch", "part")
        .sortWithinPartitions("tree", "stretch", "part", "kind")
        .mapInArrow(_nearest(k + 1 + SPARE), "qid long, vid long, rough double")
        .groupBy("qid", "vid")
        .agg(F.max("rough").alias("rough"))
    )
    few = Window.partitionBy("qid").orderBy(F.desc("rough"), "vid")
    best = found.withColumn("_rank", F.row_number().over(few)).where(F.col("_rank") <= k + 1 + SPARE)
    scored = (
        best.select("qid", "vid")
        .join(queries.withColumnRenamed("vector", "asked"), "qid")
        .join(distinct, "vid")
        .select("qid", "vid", _dot("asked", "vector").alias("score"))
    )
    answer = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    each = (
        scored.join(members.select("vid", "vec_id"), "vid")
        .withColumn("_rank", F.row_number().over(answer))
        .where(F.col("_rank") <= k + 1)
        .select("qid", "vec_id", "score")
    )
    every = asked.join(queries, "vector").select(F.col("vec_id").alias("query_id"), "qid")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        every.join(each, "qid")
        .where("vec_id != query_id")
        .withColumn("rank", F.row_number().over(final))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def search_embeddings(embeddings: DataFrame, k: int = 20, **options) -> DataFrame:
    """The nearest of every row whose vec_id is divisible by 20, among all rows."""
    return search(embeddings, F.col("vec_id") % 20 == 0, k, **options)
