"""Writers: unique append, keyed upserts, metric files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def append_new_posts(
    target: DataFrame, incoming: DataFrame, keys: list[str], order: str
) -> DataFrame:
    """Incoming rows whose key is not in the target, one per key (the earliest by `order`).

    Repeats are merged before the shuffle, so a key repeated many times costs
    one row per task.
    """
    rest = [c for c in incoming.columns if c not in keys]
    first = incoming.groupBy(*keys).agg(_pick(rest, [F.col(order)], earliest=True).alias("_row"))
    unique = first.select(*keys, "_row.row.*").select(*incoming.columns)
    return unique.join(target.select(*keys), keys, "left_anti")


def _pick(columns: list[str], order: list[Column], earliest: bool = False) -> Column:
    """Struct aggregate that keeps `columns` of the first or last row by `order`."""
    names = [o.alias(f"o{i}") for i, o in enumerate(order)]
    row = F.struct(*names, F.struct(*columns).alias("row"))
    return F.min(row) if earliest else F.max(row)


def upsert_latest(
    target: DataFrame, updates: DataFrame, keys: list[str], order: str
) -> DataFrame:
    """Last write wins per key; at equal `order` the update beats the target.

    One partial aggregation over both inputs, no window and no join.
    """
    columns = target.columns
    rest = [c for c in columns if c not in keys]
    both = target.withColumn("_new", F.lit(0)).unionByName(
        updates.select(*columns).withColumn("_new", F.lit(1))
    )
    merged = both.groupBy(*keys).agg(_pick(rest, [F.col(order), F.col("_new")]).alias("_row"))
    return merged.select(*keys, "_row.row.*").select(*columns)


def upsert_partial(
    target: DataFrame,
    updates: DataFrame,
    keys: list[str],
    update_cols: list[str],
    frozen_cols: list[str],
    order: str,
) -> DataFrame:
    """Keyed upsert where `frozen_cols` keep the first value ever written.

    As if the updates were applied one by one in `order`: a new key takes every
    column of its first update, later updates replace `update_cols` only.
    """
    columns = [*keys, *update_cols, *frozen_cols]
    both = target.select(*columns).withColumns(
        {"_new": F.lit(0), "_order": F.lit(None).cast(dict(updates.dtypes)[order])}
    ).unionByName(
        updates.select(*columns, F.col(order).alias("_order")).withColumn("_new", F.lit(1))
    )
    sequence = [F.col("_new"), F.col("_order")]
    merged = both.groupBy(*keys).agg(
        _pick(update_cols, sequence).alias("_last"),
        _pick(frozen_cols, sequence, earliest=True).alias("_first"),
    )
    return merged.select(*keys, "_last.row.*", "_first.row.*").select(*columns)


def write_daily_metrics(daily: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Daily metric table, parquet by default or CSV with a header."""
    writer = daily.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def write_posts(new_rows: DataFrame, path: str, partition_col: str = "board") -> None:
    new_rows.write.mode("append").partitionBy(partition_col).parquet(path)


def latest_rows(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row of each key that is last by `order`: what `upsert_latest` keeps of `rows`."""
    rest = [c for c in rows.columns if c not in (*keys, order)]
    last = rows.groupBy(*keys).agg(_pick(rest, [F.col(order)]).alias("_row"))
    return last.select(*keys, F.col("_row.o0").alias(order), "_row.row.*").select(*rows.columns)


def first_and_latest_rows(
    rows: DataFrame, keys: list[str], update_cols: list[str], frozen_cols: list[str], order: str
) -> DataFrame:
    """Two rows of each key that stand for all in `upsert_partial`: that with its frozen
    columns and that with its updated ones. Rows equal in all columns are one."""
    both = rows.groupBy(*keys).agg(
        _pick([*update_cols, *frozen_cols], [F.col(order)]).alias("_last"),
        _pick([*frozen_cols, *update_cols], [F.col(order)], earliest=True).alias("_first"),
    )
    ends = [
        F.struct(F.col(f"{c}.o0").alias(order), *(F.col(f"{c}.row.{n}").alias(n) for n in (*update_cols, *frozen_cols)))
        for c in ("_first", "_last")
    ]
    each = both.select(*keys, F.explode(F.array_distinct(F.array(*ends))).alias("_row"))
    return each.select(*keys, "_row.*").select(*rows.columns)


# --- keyed tables fed batch by batch ---------------------------------------------------


def write_batch(frame: DataFrame, path: str, stream: str, batch_id: int) -> None:
    """Store the rows of a micro-batch under its stream and id; a repeated batch replaces itself.

    Batch ids start anew with every checkpoint, so the stream tells them apart.
    """
    frame.write.mode("overwrite").parquet(f"{path}/stream={stream}/batch_id={batch_id}")


def read_batch(
    spark: SparkSession, path: str, schema: str, stream: str, batch_id: int
) -> DataFrame:
    """The rows one batch stored, none if it has not run."""
    return read_or_empty(spark, f"{path}/stream={stream}/batch_id={batch_id}", schema)


def read_batches(
    spark: SparkSession, path: str, schema: str, without: tuple[str, int] | None = None
) -> DataFrame:
    """All stored rows with their `stream` and `batch_id`.

    `without` names the stream and batch at hand: what it and later batches of its stream
    stored, in a run that did not end, is left out.
    """
    stored = read_or_empty(spark, path, f"{schema}, stream string, batch_id bigint")
    if without is None:
        return stored
    stream, batch_id = without
    return stored.where((F.col("stream") != stream) | (F.col("batch_id") < batch_id))


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The stored rows, none if nothing was stored yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
