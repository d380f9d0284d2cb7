"""Vector codes: parts of vectors replaced by the number of the nearest codebook entry.

All arithmetic is on integers, so codes, codebooks and errors are exact and do not depend
on how rows are dealt. The nearest entry is found by memoised grid cells: the space of a
part is cut into cells; for a cell that was not met before, entries are kept unless one
lies farther from all of the cell than another one's farthest point (its least distance
to the box exceeds the least of all greatest distances). Only what is kept is evaluated,
exactly, for the parts in that cell.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import ship, stored

ship(__name__)

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
# Components are held within this, so that no square or sum leaves 64 bits: it stands for
# components beyond 524,288, which the 64-bit errors could not tell apart either.
MOST = 1 << 27
# Cells per codebook range along each axis: finer cells keep fewer entries, coarser ones
# are met again more often.
CELLS = 8
# Cells remembered for one part in one task; a full memory is begun anew.
REMEMBERED = 50_000
ROWS = 4096


class Grid:
    """Nearest entries of one part's codebook."""

    def __init__(self, book: np.ndarray):
        self.book = book
        spread = int((book.max(axis=0) - book.min(axis=0)).max()) if book.size else 0
        self.side = max(spread // CELLS, 1)
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        # Entries kept for cell k: flat[starts[k] : starts[k] + sizes[k]], ascending.
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int64)

    def _learn(self, cells: np.ndarray) -> None:
        low = (cells * self.side)[:, None, :]
        high = low + (self.side - 1)
        book = self.book[None, :, :]
        least = (np.maximum(np.maximum(low - book, book - high), 0) ** 2).sum(axis=2)
        greatest = (np.maximum(np.abs(book - low), np.abs(book - high)) ** 2).sum(axis=2)
        kept = least <= greatest.min(axis=1, keepdims=True)
        sizes = kept.sum(axis=1)
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, np.nonzero(kept)[1]])

    def cells_of(self, x: np.ndarray) -> np.ndarray:
        """Number of each part's cell in the memory; cells met for the first time are learned."""
        cells = np.ascontiguousarray(x // self.side)
        keys = cells.view(np.dtype((np.void, cells.shape[1] * 8)))[:, 0]
        distinct, first, back = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > REMEMBERED:
            self.forget()
        names = [k.tobytes() for k in distinct]
        fresh = [i for i, k in enumerate(names) if k not in self.known]
        for at in range(0, len(fresh), 512):
            self._learn(cells[first[fresh[at : at + 512]]])
        for i in fresh:
            self.known[names[i]] = len(self.known)
        return np.array([self.known[k] for k in names], np.int64)[back]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each row of x; ties go to the lower entry."""
        cell = self.cells_of(x)
        sizes = self.sizes[cell]
        begins = np.cumsum(sizes) - sizes
        row = np.repeat(np.arange(len(x)), sizes)
        entry = self.flat[np.repeat(self.starts[cell] - begins, sizes) + np.arange(len(row))]
        distance = ((x[row] - self.book[entry]) ** 2).sum(axis=1)
        best = np.minimum.reduceat(distance, begins)
        hits = np.flatnonzero(distance == best[row])
        _, at = np.unique(row[hits], return_index=True)
        return entry[hits[at]], best


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def whole_vectors(embeddings: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id, label, x: rows with a vector of finite components; x is floor(scale * component).

    Float times a power of two is exact. Rows whose vector is null or holds null or
    non-finite components go; an empty vector stays.
    """

    def finite(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))

    scaled = F.transform(
        F.col(vector),
        lambda c: F.floor(
            F.least(F.greatest(c.cast("double") * F.lit(float(scale)), F.lit(float(-MOST))), F.lit(float(MOST)))
        ),
    )
    return embeddings.where(
        F.col(vector).isNotNull() & F.forall(vector, lambda c: F.coalesce(finite(c), F.lit(False)))
    ).select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", scaled.alias("x"))


def common_width(vectors: DataFrame) -> int:
    """The most frequent length, the greater of two; 0 for an empty table."""
    row = (
        vectors.groupBy(F.size("x").alias("width"))
        .count()
        .orderBy(F.desc("count"), F.desc("width"))
        .limit(1)
        .collect()
    )
    return row[0]["width"] if row else 0


def first_books(vectors: DataFrame, width: int, parts: int, entries: int) -> np.ndarray:
    """[part, entry, component]: the parts of the rows with the smallest vec_ids.

    Rows of one vec_id go in the order of their vectors, null ids last.
    """
    rows = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()
    x = np.array([r["x"] for r in rows], np.int64).reshape(len(rows), parts, width // parts)
    return np.ascontiguousarray(x.transpose(1, 0, 2))


def assigned(batches, books: np.ndarray, width: int):
    """Batches of at most ROWS rows with (entries, distances), both [part, row]."""
    grids = [Grid(book) for book in books]
    size = width // len(books)
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            x = _vectors(part.column("x"), width)
            found = [g.nearest(x[:, p * size : (p + 1) * size]) for p, g in enumerate(grids)]
            yield part, x, np.stack([f[0] for f in found]), np.stack([f[1] for f in found])


def moved_books(vectors: DataFrame, books: np.ndarray, width: int) -> np.ndarray:
    """Each entry replaced by the floored mean of the parts assigned to it; unused ones stay.

    A task adds its parts up and hands on one row for each entry and component.
    """
    parts, entries, size = books.shape

    def run(batches):
        total, count = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for _, x, entry, _ in assigned(batches, books, width):
            for p in range(parts):
                np.add.at(total[p], entry[p], x[:, p * size : (p + 1) * size])
                count[p] += np.bincount(entry[p], minlength=entries)
        at = np.flatnonzero(np.repeat(count.reshape(-1), size))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(total.reshape(-1)[at]), pa.array(np.repeat(count.reshape(-1), size)[at])],
            ["place", "total", "n"],
        )

    sums = (
        vectors.select("x")
        .mapInArrow(run, "place bigint, total bigint, n bigint")
        .groupBy("place")
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        .collect()  # as many rows as the codebooks have numbers
    )
    moved = books.reshape(-1).copy()
    for row in sums:
        moved[row["place"]] = row["total"] // row["n"]
    return moved.reshape(books.shape)


def learn_books(
    vectors: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> np.ndarray:
    books = first_books(vectors, width, parts, entries)
    for _ in range(rounds):
        books = moved_books(vectors, books, width)
    return books


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, comma between."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def encode_vectors(vectors: DataFrame, books: np.ndarray, width: int) -> DataFrame:
    """vec_id, label, code (two hex digits a part), error (squared distances over all parts)."""

    def run(batches):
        for part, _, entry, distance in assigned(batches, books, width):
            code = np.ascontiguousarray(entry.T.astype(np.uint8))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("vec_id"),
                    part.column("label"),
                    pa.array([row.tobytes().hex() for row in code], pa.string()),
                    pa.array(distance.sum(axis=0)),
                ],
                ["vec_id", "label", "code", "error"],
            )

    kind = vectors.schema["label"].dataType.simpleString()
    return vectors.select("vec_id", "label", "x").mapInArrow(
        run, f"vec_id bigint, label {kind}, code string, error bigint"
    )


def decoded_vectors(codes: DataFrame, books: np.ndarray, scale: int = SCALE) -> DataFrame:
    """Adds `vector`, what the code stands for: the middle of each entry's integer step."""
    parts = [[[(v + 0.5) / scale for v in entry] for entry in book] for book in books.tolist()]

    def run(batches):
        for batch in batches:
            rows = [
                [v for p, e in enumerate(bytes.fromhex(code)) for v in parts[p][e]] if code is not None else None
                for code in batch.column("code").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rows, pa.list_(pa.float64()))], [*batch.schema.names, "vector"]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in codes.schema)
    return codes.mapInArrow(run, f"{fields}, vector array<double>")


def compress_embeddings(
    embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every row with a finite vector.

    Vectors have the most frequent length, which `parts` has to divide. Rows of other
    lengths (and all, where it does not divide it) stay with null code and error and
    teach nothing. With fewer than `entries` rows the codebooks are as small; an empty
    table gives no rows. Repeated rows each give a row and count each; rows of one vec_id
    are told apart by their vectors. Nulls of `label` are one label; a label without a
    code has a null sum. Only vec_id, embedding and label are read.

    Between rounds only sums travel. Labels are summed before they meet the rows again, a
    join in which Spark may split a label that holds much of the table.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an entry's number has two hex digits")
    vectors = stored(whole_vectors(embeddings), "whole-vectors")
    width = common_width(vectors)
    fits = F.lit(bool(width) and width % parts == 0) & (F.size("x") == width)
    kept = vectors.where(fits)
    others = vectors.where(~fits).select(
        "vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error")
    )
    coded, digest = others, books_digest(np.zeros(0, np.int64))
    if width and width % parts == 0:
        books = learn_books(kept, width, parts, entries, rounds)
        coded = stored(encode_vectors(kept, books, width).unionByName(others), "codes")
        digest = books_digest(books)
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )


def _sql(rounds: int = ROUNDS) -> str:
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
far{k} AS (
    SELECT x.vec_id, x.p, b.e, sum((x.v - b.v) * (x.v - b.v)) AS d
    FROM x JOIN book{k} AS b ON x.p = b.p AND x.i = b.i GROUP BY x.vec_id, x.p, b.e
), near{k} AS (
    SELECT vec_id, p, e, d FROM far{k}
    QUALIFY row_number() OVER (PARTITION BY vec_id, p ORDER BY d, e) = 1
)""")
        if k < rounds:
            steps.append(f"""
sum{k} AS (
    SELECT x.p, n.e, x.i, sum(x.v) AS s, count(*) AS n
    FROM x JOIN near{k} AS n ON x.vec_id = n.vec_id AND x.p = n.p GROUP BY x.p, n.e, x.i
), book{k + 1} AS (
    SELECT b.p, b.e, b.i, CAST(coalesce((s - ((s % n) + n) % n) // n, b.v) AS BIGINT) AS v
    FROM book{k} AS b LEFT JOIN sum{k} AS t ON b.p = t.p AND b.e = t.e AND b.i = t.i
)""")
    return f"""
WITH kept AS (
    SELECT vec_id, label, [CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT) FOR c IN embedding] AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0
), flat AS (
    SELECT vec_id, len(v) // {PARTS} AS size, unnest(v) AS v, unnest(range(len(v))) AS i FROM kept
), x AS MATERIALIZED (
    SELECT vec_id, CAST(i // size AS INTEGER) AS p, CAST(i % size AS INTEGER) AS i, v FROM flat
), book0 AS (
    SELECT x.p, f.e, x.i, x.v
    FROM x JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept
                 QUALIFY e < {ENTRIES}) AS f ON x.vec_id = f.vec_id
), {", ".join(s.strip() for s in steps)}, coded AS (
    SELECT k.vec_id, k.label,
           string_agg(lower(printf('%02x', CAST(n.e AS INTEGER))), '' ORDER BY n.p) AS code,
           CAST(sum(n.d) AS BIGINT) AS error
    FROM kept AS k JOIN near{rounds} AS n ON k.vec_id = n.vec_id GROUP BY k.vec_id, k.label
)
SELECT vec_id, code, error,
       CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY p, e, i)) FROM book{rounds}) AS codebooks_sha256
FROM coded
"""


SQL = _sql()
