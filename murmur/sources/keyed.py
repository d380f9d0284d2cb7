"""Keyed tables fed batch by batch: a base dealt into buckets, and the batches since.

A stream adds each batch beside the table (`sinks.write_batch`). From time to time `compact`
folds batches into the base: rows are dealt into buckets by a hash of some key columns, and
only buckets that the batches touch are written anew, into a folder of their own. Then one
row set, the pointer, names the folder of each bucket and the last batch folded of each
stream. The pointer appears in one step, and readers take the highest one, so they see the
table before or after a compaction and never in between; one that ends early leaves
folders that no pointer names.

What is read to look up keys is the buckets that they are in and the batches not folded
yet. Buckets double in number when they outgrow `bucket_rows`, so neither grows with the
table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.sources.sinks import read_batches, read_or_empty

POINTER = (
    "buckets int, bucket int, folder string, rows bigint, stream string, batch_id bigint, version bigint"
)
BUCKET_ROWS = 500_000
# Batches between two compactions.
EVERY = 20


@dataclass(frozen=True)
class Keyed:
    """A keyed table under `path`, whose base lies under `path` + "_base".

    rows: schema of the rows that batches hold (a stored batch may have further columns).
    deal: columns that say in which bucket a row is; all rows of a key have to agree on them.
    merge: rows to fewer rows that mean the same, seen key by key. It has to be associative:
    merging merged rows with others gives what merging all at once gives.
    """

    path: str
    rows: str
    deal: tuple[str, ...]
    merge: Callable[[DataFrame], DataFrame]
    bucket_rows: int = BUCKET_ROWS

    @property
    def base(self) -> str:
        return f"{self.path}_base"


@dataclass(frozen=True)
class Pointer:
    version: int
    buckets: int
    folders: dict[int, str]  # bucket -> folder
    rows: dict[int, int]  # bucket -> rows
    folded: dict[str, int]  # stream -> last batch in the base


def pointer(spark: SparkSession, table: Keyed) -> Pointer:
    """The state that readers see: the last compaction that came to its end."""
    stored = read_or_empty(spark, f"{table.base}/pointer", f"{POINTER}, name string")
    last = stored.agg(F.max(F.struct("version", "name")).alias("last")).collect()[0]["last"]
    if last is None:
        return Pointer(0, 1, {}, {}, {})
    # As many rows as buckets and streams.
    rows = stored.where((F.col("name") == last["name"]) & (F.col("version") == last["version"])).collect()
    held = [r for r in rows if r["bucket"] is not None]
    return Pointer(
        last["version"],
        rows[0]["buckets"],
        {r["bucket"]: r["folder"] for r in held},
        {r["bucket"]: r["rows"] for r in held},
        {r["stream"]: r["batch_id"] for r in rows if r["stream"] is not None},
    )


def bucket_of(table: Keyed, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*table.deal), F.lit(buckets)).cast("int")


def read_base(
    spark: SparkSession, table: Keyed, at: Pointer, buckets: set[int] | None = None
) -> DataFrame:
    """Rows of the base, of some buckets only if these are named."""
    paths = [
        f"{table.base}/data/{folder}/bucket={b}"
        for b, folder in at.folders.items()
        if buckets is None or b in buckets
    ]
    if not paths:
        return spark.createDataFrame([], table.rows)
    return spark.read.schema(table.rows).parquet(*paths)


def read_since(
    spark: SparkSession, table: Keyed, at: Pointer, without: tuple[str, int] | None = None
) -> DataFrame:
    """Rows of the batches that are not in the base, with `stream` and `batch_id`.

    Folders of folded batches are not opened: the names of the folders say which they are.
    """
    batches = read_batches(spark, table.path, table.rows, without)
    for stream, last in at.folded.items():
        batches = batches.where((F.col("stream") != stream) | (F.col("batch_id") > last))
    return batches


def read_rows(spark: SparkSession, table: Keyed, without: tuple[str, int] | None = None) -> DataFrame:
    """All rows, not merged: the base and the batches since."""
    at = pointer(spark, table)
    since = read_since(spark, table, at, without).drop("stream", "batch_id")
    return read_base(spark, table, at).unionByName(since)


def read_merged(spark: SparkSession, table: Keyed) -> DataFrame:
    return table.merge(read_rows(spark, table))


def touched_buckets(table: Keyed, frame: DataFrame, at: Pointer) -> set[int]:
    """Buckets in which rows with the keys of `frame` are, at most as many as there are."""
    if not at.folders:
        return set()
    found = frame.select(bucket_of(table, at.buckets).alias("b")).distinct().collect()
    return {r["b"] for r in found}


def look_up(
    spark: SparkSession, table: Keyed, wanted: DataFrame, without: tuple[str, int] | None = None
) -> DataFrame:
    """Stored rows, not merged, that may have a key of `wanted` (it has the `deal` columns):
    the buckets that the keys are in and the batches since. `without` as in `read_batches`."""
    at = pointer(spark, table)
    since = read_since(spark, table, at, without).drop("stream", "batch_id")
    return read_base(spark, table, at, touched_buckets(table, wanted, at)).unionByName(since)


def due(batch_id: int, every: int = EVERY) -> bool:
    return every > 0 and batch_id % every == every - 1


def compact(spark: SparkSession, table: Keyed, buckets: int | None = None) -> Pointer:
    """Folds the stored batches into the base and returns the new pointer.

    The newest batch of each stream stays out, as a stream that starts anew may write it
    again. Buckets that no batch touches keep their folder. `buckets` sets their number;
    by default it doubles until the fullest has room. A compaction beside another one is
    safe: each writes folders of its own, and whichever pointer counts last is complete.
    """
    at = pointer(spark, table)
    stored = read_since(spark, table, at)
    # One row for each stream.
    newest = {
        r["stream"]: r["last"]
        for r in stored.groupBy("stream").agg(F.max("batch_id").alias("last")).collect()
    }
    ripe = F.lit(False)
    for stream, last in newest.items():
        ripe = ripe | ((F.col("stream") == stream) & (F.col("batch_id") < last))
    fold = stored.where(ripe).drop("stream", "batch_id")
    folded = {**at.folded}
    for stream, last in newest.items():
        older = stored.where((F.col("stream") == stream) & (F.col("batch_id") < last))
        upto = older.agg(F.max("batch_id").alias("m")).collect()[0]["m"]
        if upto is not None:
            folded[stream] = upto
    if folded == at.folded:
        return at
    counted = {
        r["b"]: r["n"]
        for r in fold.groupBy(bucket_of(table, at.buckets).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
    }
    fullest = max((at.rows.get(b, 0) + n for b, n in counted.items()), default=0)
    number = buckets or at.buckets
    while buckets is None and fullest > table.bucket_rows:
        number, fullest = number * 2, fullest / 2
    touched = set(counted) if number == at.buckets else None
    merged = table.merge(read_base(spark, table, at, touched).unionByName(fold))
    name = f"{at.version + 1:09d}-{uuid.uuid4().hex}"
    data = f"{table.base}/data/{name}"
    merged.withColumn("bucket", bucket_of(table, number)).repartition("bucket").write.partitionBy(
        "bucket"
    ).parquet(data)
    written = read_or_empty(spark, data, f"{table.rows}, bucket int")
    rows = {r["bucket"]: r["n"] for r in written.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
    folders = {b: name for b in rows}
    if touched is not None:
        kept = {b: f for b, f in at.folders.items() if b not in touched}
        folders, rows = {**kept, **folders}, {**{b: at.rows[b] for b in kept}, **rows}
    new = Pointer(at.version + 1, number, folders, rows, folded)
    write_pointer(spark, table, new, name)
    return new


def write_pointer(spark: SparkSession, table: Keyed, new: Pointer, name: str) -> None:
    """One file, which its writer renames into place when it is whole."""
    lines = [(new.buckets, b, f, new.rows[b], None, None, new.version) for b, f in sorted(new.folders.items())]
    lines += [(new.buckets, None, None, None, s, i, new.version) for s, i in sorted(new.folded.items())]
    frame = spark.createDataFrame(lines, POINTER).coalesce(1)
    frame.write.parquet(f"{table.base}/pointer/name={name}")


def expire(spark: SparkSession, table: Keyed) -> list[str]:
    """Deletes the folders of the base that the pointer does not name, and older pointers.

    For a time when nobody reads an older state and no compaction runs. Batches stay: they
    are the table's record. Returns the names of the folders deleted.
    """
    at = pointer(spark, table)
    keep = set(at.folders.values())
    jvm = spark._jvm
    gone = []
    for part in ("data", "pointer"):
        root = jvm.org.apache.hadoop.fs.Path(f"{table.base}/{part}")
        files = root.getFileSystem(spark._jsc.hadoopConfiguration())
        if not files.exists(root):
            continue
        for status in files.listStatus(root):
            name = status.getPath().getName().removeprefix("name=")
            old = int(name[:9]) < at.version if part == "pointer" else name not in keep
            if old and name[:9].isdigit():
                files.delete(status.getPath(), True)
                gone.append(f"{part}/{name}")
    return gone
