"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import re
import sys
import types

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from murmur.session import scratch_path

# Words are the longest runs without ASCII white space (contract of the queries).
WORD = r"[^\x20\x09-\x0D]+"


def ship(name: str) -> None:
    """Task functions of module `name` travel with their code, so executors need no copy of it."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


def worker_store() -> dict:
    """Lives as long as the Python worker, so that tasks after one another share what is in it.

    Code that travels with a task is made anew for each task, and so are its globals.
    """
    name = "_murmur_worker_store"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__.setdefault("held", {})


def lean(run):
    """`run`, a function for mapInArrow, that at its end gives what malloc holds back to the system.

    Workers outlive their tasks, and what one stage has touched would add to what all later
    ones need.
    """

    def task(batches):
        try:
            yield from run(batches)
        finally:
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim is not None:
                trim(0)

    return task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rows go to Python in batches of about so many bytes; tasks hold a few batches at once.
BATCH_BYTES = 8 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def _bytes(setting: str) -> int:
    """A size as Spark writes it: 67108864, 64m, 64MB."""
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([a-z]?)[a-z]*\s*", setting.lower()).groups()
    return int(number) << {"k": 10, "m": 20, "g": 30, "t": 40, "p": 50}.get(unit, 0)


def small_batches(spark: SparkSession, most: int = BATCH_BYTES) -> str:
    """From now on rows go to Python in batches of at most `most` bytes or one row; a smaller
    limit that is set stays.

    Returns what held before.
    """
    before = spark.conf.get(_BATCH_CONF)
    if not 0 < _bytes(before) <= most:
        spark.conf.set(_BATCH_CONF, str(most))
    return before


def stored(frame: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write `frame` to the shared scratch folder and read it back.

    Cuts the lineage: an executor lost later costs a read, not the work before. Used
    where a table is read more than once or where row placement has to stay fixed.
    """
    path = scratch_path(frame.sparkSession, name)
    before = small_batches(frame.sparkSession)
    try:
        frame.write.parquet(path, compression=compression)
    finally:
        frame.sparkSession.conf.set(_BATCH_CONF, before)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(frame: DataFrame, order: list[str], name: str) -> DataFrame:
    """Adds `row` (0, 1, ...) in ascending order of the columns `order`, without one big sort.

    Rows are range-partitioned and stored, so a row keeps its part; parts are counted,
    and a row's number is its place in its part plus the rows of the parts before. The
    parts are as many as shuffle partitions, so the table of counts is small. Rows equal
    in all of `order` are numbered in any order among themselves. Nulls come first.
    """
    spark = frame.sparkSession
    parts = stored(
        frame.repartitionByRange(partitions(spark), *order).withColumn(
            "_part", F.spark_partition_id()
        ),
        name,
    )
    counts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"),
    )
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (
        parts.withColumn("_place", place)
        .join(F.broadcast(before), "_part")
        .withColumn("row", (F.col("_before") + F.col("_place") - 1).cast("bigint"))
        .drop("_part", "_place", "_before")
    )


def clean_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


ship(__name__)
