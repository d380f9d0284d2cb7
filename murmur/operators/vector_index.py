"""Approximate nearest neighbours: trained cells, product codes of residuals, exact distances.

Cells are the regions around centres that a bounded sample trains. In its cell a vector has
a code: its difference from the centre is cut into parts, and each part named by the nearest
of a few trained words. A question looks into the cells whose centres are nearest to it,
orders the vectors there by what their codes say, and compares the first ones exactly.

How many cells and how many codes that takes is learned from questions answered by brute
force, so that the share of true neighbours found is about the same for any collection. Where
vectors have no structure it takes most cells; then the exact scan answers.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.operators import retrieval
from murmur.operators.retrieval import _best, _cell_join, _closest, _hit_schema, _unit_rows

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Vectors that centres and words are trained on, those of the smallest hash of the vector.
SAMPLE = 32_768
# A cell has about this many vectors of the sample; there are at most SAMPLE / of these.
PER_CENTRE = 32
PARTS, WORDS = 8, 256
ROUNDS = 12
# Questions answered by brute force, and the share of their neighbours to be found.
TRIAL, RECALL = 128, 0.97
# A smaller collection, and one in which a question would meet this share, is scanned whole.
SCAN_ROWS, SCAN_SHARE = 4_096, 0.4


@dataclass(frozen=True)
class VectorIndex:
    """centres: cells x dimensions. words: parts x words x dimensions of a part.

    probe: cells a question looks into, 0 for a scan of everything. depth: vectors of a batch
    that are compared exactly for a question, those whose codes are nearest.
    """

    centres: np.ndarray
    words: np.ndarray
    probe: int = 0
    depth: int = 1

    @property
    def width(self) -> int:
        return self.words.shape[0] * self.words.shape[2]

    def cells_near(self, units: np.ndarray, probe: int | None = None) -> np.ndarray:
        """The cells that each vector looks into, nearest centre first."""
        order = np.argsort(-(units @ self.centres.T), axis=1, kind="stable")
        return order[:, : probe or self.probe]

    def codes(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, word of each part) of unit vectors."""
        cell = np.argmax(units @ self.centres.T, axis=1)
        rest = _parts(units - self.centres[cell], self.words.shape[0])
        return cell, np.stack([_nearest(rest[:, p], self.words[p]) for p in range(len(self.words))], axis=1)


def _parts(rows: np.ndarray, parts: int) -> np.ndarray:
    """rows x parts x dimensions of a part, zeros at the end where it does not come out even."""
    size = -(-rows.shape[1] // parts)
    padded = np.zeros((len(rows), parts * size))
    padded[:, : rows.shape[1]] = rows
    return padded.reshape(len(rows), parts, size)


def _nearest(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    out = np.empty(len(rows), np.int64)
    half = (points**2).sum(axis=1) / 2
    for at in range(0, len(rows), 4096):
        out[at : at + 4096] = np.argmax(rows[at : at + 4096] @ points.T - half, axis=1)
    return out


def _means(rows: np.ndarray, n: int, rng: np.random.Generator, unit: bool = False) -> np.ndarray:
    """n points by Lloyd's rounds; one that loses all its rows is put upon a row."""
    points = rows[np.sort(rng.choice(len(rows), n, replace=False))].copy()
    for _ in range(ROUNDS):
        own = _nearest(rows, points)
        count = np.bincount(own, minlength=n)
        total = np.zeros_like(points)
        np.add.at(total, own, rows)
        points = total / np.maximum(count, 1)[:, None]
        empty = np.flatnonzero(count == 0)
        points[empty] = rows[rng.choice(len(rows), len(empty), replace=False)]
        if unit:
            points = _unit_rows(points)
    return points


def train(
    collection: DataFrame, vec_col: str = "embedding", rows: int | None = None, seed: int = 7
) -> VectorIndex:
    """Centres and words from a sample of at most SAMPLE vectors, however large the collection.

    There are about as many cells as the square root of its rows.
    """
    rows = collection.count() if rows is None else rows
    vectors = collection.select(F.col(vec_col).alias("_vec"))
    sample = vectors.orderBy(F.xxhash64("_vec"), "_vec").limit(SAMPLE).toPandas()
    units = _unit_rows(np.stack(sample["_vec"].to_numpy()).astype(np.float64))
    rng = np.random.default_rng(seed)
    cells = max(1, min(int(rows**0.5), len(units) // PER_CENTRE))
    centres = _means(units, cells, rng, unit=True)
    rest = _parts(units - centres[np.argmax(units @ centres.T, axis=1)], PARTS)[:8192]
    words = max(1, min(WORDS, len(rest) // 4))
    return VectorIndex(centres, np.stack([_means(rest[:, p], words, rng) for p in range(PARTS)]))


def _units(column: pd.Series) -> np.ndarray:
    return _unit_rows(np.stack(column.to_numpy()).astype(np.float64))


def _guesses(index: VectorIndex, asked: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
    """What codes in `cell` say of the inner products with the questions: questions x rows."""
    said = np.broadcast_to((asked @ index.centres[cell])[:, None], (len(asked), len(codes))).copy()
    for p, part in enumerate(np.moveaxis(_parts(asked, len(index.words)), 1, 0)):
        said += (part @ index.words[p].T)[:, codes[:, p]]
    return said


def fit_index(
    collection: DataFrame,
    id_col: str = "id",
    vec_col: str = "embedding",
    k: int = 5,
    questions: DataFrame | None = None,
    query_vec: str = "embedding",
    recall: float = RECALL,
) -> VectorIndex:
    """A trained index with as many cells to look into, and codes to compare, as find `recall`
    of the k nearest of TRIAL questions (`questions`, else vectors of the collection).

    The trial scans the collection twice; nothing but its neighbours and counts comes to
    the driver. Up to SCAN_ROWS rows, or where a question would meet SCAN_SHARE of them,
    `probe` is 0.
    """
    rows = collection.count()
    if rows <= SCAN_ROWS:
        return VectorIndex(np.zeros((1, 1)), np.zeros((1, 1, 1)))
    index = train(collection, vec_col, rows)
    vectors = collection.select(F.col(id_col).alias("_id"), F.col(vec_col).alias("_vec"))
    asked = vectors.select("_vec") if questions is None else questions.select(F.col(query_vec).alias("_vec"))
    trial = asked.distinct().orderBy(F.xxhash64("_vec"), "_vec").limit(TRIAL).toPandas()
    units = _units(trial["_vec"])
    # One more for a question that is a vector of the collection and so its own nearest.
    local = pd.DataFrame({"query_id": np.arange(len(units)), "_vec": list(units)})
    hits = _closest(retrieval._scan_pass(vectors, local, k + 1, "_id", "_vec", "bigint"), k + 1)
    found = hits.join(vectors, hits["doc_id"] == vectors["_id"]).select("query_id", "_vec").toPandas()
    if found.empty:
        return index
    near = _units(found["_vec"])
    of = found["query_id"].to_numpy()
    cell, codes = index.codes(near)
    order = index.cells_near(units, len(index.centres))
    place = np.argsort(order, axis=1)[of, cell]
    probe = int(np.quantile(place, recall, method="higher")) + 1
    index = replace(index, probe=probe)
    said = np.array([_guesses(index, units[q : q + 1], c, code[None])[0, 0] for q, c, code in zip(of, cell, codes)])
    ranks, met = _trial_ranks(vectors, index, units, of, said, place < probe)
    if met >= SCAN_SHARE * rows * len(units):
        return replace(index, probe=0)
    return replace(index, depth=max(4 * k, int(np.quantile(ranks, recall, method="higher")) + 1))


def _trial_ranks(
    vectors: DataFrame, index: VectorIndex, units: np.ndarray, of: np.ndarray, said: np.ndarray, inside: np.ndarray
) -> tuple[np.ndarray, int]:
    """(for each neighbour inside the cells looked into, vectors there whose codes say more;
    vectors met by all questions)."""
    chosen = np.flatnonzero(inside)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        more, met = np.zeros(len(chosen), np.int64), 0
        for part in parts:
            for cell, asked, codes, _ in _met(index, units, _units(part["_vec"])):
                said_here = _guesses(index, units[asked], cell, codes)
                met += said_here.size
                row = {q: i for i, q in enumerate(asked.tolist())}
                for i, n in enumerate(chosen.tolist()):
                    at = row.get(int(of[n]))
                    if at is not None:
                        more[i] += int((said_here[at] > said[n] + 1e-9).sum())
        yield pd.DataFrame({"place": np.append(np.arange(len(chosen)), -1), "n": np.append(more, met)})

    counted = vectors.select("_vec").mapInPandas(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    total = {r["place"]: r["n"] for r in counted.collect()}
    return np.array([total[i] for i in range(len(chosen))] or [0]), total[-1]


def _met(index: VectorIndex, asked: np.ndarray, rows: np.ndarray, cells: np.ndarray | None = None, codes=None):
    """(cell, questions that look into it, codes, places of its rows) of a batch of vectors."""
    if cells is None:
        cells, codes = index.codes(rows)
    looks = index.cells_near(asked)
    for cell in np.unique(cells).tolist():
        questions = np.flatnonzero((looks == cell).any(axis=1))
        if len(questions):
            at = np.flatnonzero(cells == cell)
            yield cell, questions, codes[at], at


def encode_collection(
    collection: DataFrame, index: VectorIndex, id_col: str = "id", vec_col: str = "embedding"
) -> DataFrame:
    """doc_id, vec, cell, code of every row; null vectors are left out."""
    ids = dict(collection.dtypes)[id_col]
    kind = dict(collection.dtypes)[vec_col]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if len(part):
                cell, codes = index.codes(_units(part["vec"]))
                yield part.assign(cell=cell, code=[c.tobytes() for c in codes.astype(np.uint8)])

    rows = collection.select(F.col(id_col).alias("doc_id"), F.col(vec_col).alias("vec")).where("vec is not null")
    return rows.mapInPandas(run, f"doc_id {ids}, vec {kind}, cell int, code binary")


def write_collection(encoded: DataFrame, path: str, files_per_cell: int = 4) -> None:
    """Stores an encoded collection by cell, so that a search opens only cells it looks into.

    A cell that holds much of the collection is dealt to `files_per_cell` tasks.
    """
    part = F.pmod(F.xxhash64("doc_id"), F.lit(files_per_cell))
    encoded.repartition("cell", part).write.partitionBy("cell").parquet(path)


def cosine_top_k_indexed(
    encoded: DataFrame,
    queries: DataFrame,
    index: VectorIndex,
    k: int = 5,
    query_id: str = "query_id",
    query_vec: str = "embedding",
    per_pass: int = retrieval.QUERIES_PER_PASS,
    rows_per_task: int = retrieval.ROWS_PER_BLOCK,
) -> DataFrame:
    """(query_id, doc_id, distance, rank): near documents of the cells that a question looks
    into. Distances are exact; a neighbour in another cell, or whose code is far off, is missed.

    `encoded` is what `encode_collection` gives, or what `write_collection` stored. Up to
    `per_pass` questions travel to the collection, of which only their cells are read. More
    questions meet the cells they look into in the tasks of these; large cells are split.
    """
    if index.probe == 0:
        return retrieval.cosine_top_k(encoded, queries, k, "doc_id", "vec", query_id, query_vec, per_pass)
    asked = queries.select(F.col(query_id).alias("query_id"), F.col(query_vec).alias("_vec"))
    types = asked.dtypes[0][1], dict(encoded.dtypes)["doc_id"]
    local = asked.limit(per_pass + 1).toPandas()
    if local.empty:
        return _closest(encoded.sparkSession.createDataFrame([], _hit_schema(*types)), k)
    if len(local) <= per_pass:
        units = _units(local["_vec"])
        wanted = np.unique(index.cells_near(units)).tolist()
        near = encoded.where(F.col("cell").isin(wanted)) if len(wanted) < len(index.centres) else encoded
        return _closest(_search(near, local["query_id"].to_numpy(), units, index, k, types), k)

    def looks(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if len(part):
                cells = index.cells_near(_units(part["_vec"])).astype(str)
                yield part.assign(_cells=list(cells))

    schema = ", ".join(f"`{n}` {t}" for n, t in asked.dtypes) + ", _cells array<string>"
    documents = encoded.select(
        "doc_id", F.col("vec").alias("_vec"), F.array(F.col("cell").cast("string")).alias("_cells")
    )
    return _closest(_cell_join(documents, asked.mapInPandas(looks, schema), k, rows_per_task, per_pass), k)


def _search(
    encoded: DataFrame, names: np.ndarray, units: np.ndarray, index: VectorIndex, k: int, types: tuple[str, str]
) -> DataFrame:
    """At most k rows of each task for each question."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: list = [None] * len(names)
        for part in parts:
            if part.empty:
                continue
            ids, vectors = part["doc_id"].to_numpy(), part["vec"].to_numpy()
            codes = np.frombuffer(b"".join(part["code"]), np.uint8).reshape(len(part), -1).astype(np.int64)
            guessed: list[list] = [[] for _ in names]
            for cell, asked, own, at in _met(index, units, part, part["cell"].to_numpy(), codes):
                said = _guesses(index, units[asked], cell, own)
                for q, row in zip(asked.tolist(), said):
                    guessed[q].append((row, at))
            for q, found in enumerate(guessed):
                if not found:
                    continue
                said, at = (np.concatenate(x) for x in zip(*found))
                if len(said) > index.depth:
                    at = at[np.argpartition(-said, index.depth)[: index.depth]]
                rows = _unit_rows(np.stack(vectors[at]).astype(np.float64))
                d, i = np.round(1.0 - rows @ units[q], 12), ids[at]
                if best[q] is not None:
                    d, i = np.concatenate([best[q][0], d]), np.concatenate([best[q][1], i])
                keep = _best(d, i, k)
                best[q] = (d[keep], i[keep])
        hits = [(n, b) for n, b in zip(names, best) if b is not None]
        if hits:
            yield pd.DataFrame(
                {
                    "query_id": np.repeat([n for n, _ in hits], [len(b[0]) for _, b in hits]),
                    "doc_id": np.concatenate([b[1] for _, b in hits]),
                    "distance": np.concatenate([b[0] for _, b in hits]),
                }
            )

    return encoded.select("doc_id", "vec", "cell", "code").mapInPandas(run, _hit_schema(*types))
