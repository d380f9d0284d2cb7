"""Joins and group limits that survive one key holding much of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_000_000


# A key above the limit has about this many rows among those that are counted.
ROWS_TO_NOTICE = 10_000


def hot_keys(
    frame: DataFrame,
    keys: list[str],
    rows_per_task: int = ROWS_PER_TASK,
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Keys with more than `rows_per_task` rows, and into how many parts to split each.

    The answer only steers how rows are spread; a join is right whichever keys it
    names. So with a large limit the rows are not all counted but every n-th by
    hash, which keeps the count a small fraction of the join it prepares. The
    hash is of the row itself: the answer is the same whenever it is worked out.
    About rows / rows_per_task keys can qualify, so the result is small by
    construction.
    """
    every = max(1, rows_per_task // ROWS_TO_NOTICE)
    counted = frame
    if every > 1:
        spread = spread_by or frame.columns
        counted = frame.where(F.pmod(F.xxhash64(*spread), F.lit(every)) == 0)
    return (
        counted.groupBy(*keys)
        .agg((F.count(F.lit(1)) * every).alias("_rows"))
        .where(F.col("_rows") > rows_per_task)
        .select(*keys, F.ceil(F.col("_rows") / F.lit(rows_per_task)).cast("int").alias("_parts"))
    )


def salted_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: list[str],
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Join many rows per key (`facts`) with one row per key (`dim`).

    Rows of a hot key are split by a hash of their other columns, and the one
    matching `dim` row is repeated for each part. Other keys are not touched.
    `how` is inner, left or left_semi, seen from `facts`. The split is a pure
    function of the row, so a task run again after a lost executor gives the
    same rows.
    """
    spread = spread_by or [c for c in facts.columns if c not in keys] or keys
    hot = hot_keys(facts.where(_all_not_null(keys)), keys, rows_per_task, spread)
    salted = (
        facts.join(hot, keys, "left")
        .withColumn(
            "_salt",
            F.coalesce(
                F.pmod(F.xxhash64(*spread), F.col("_parts").cast("bigint")), F.lit(0)
            ).cast("int"),
        )
        .drop("_parts")
    )
    repeated = (
        dim.join(hot, keys, "left")
        .withColumn(
            "_salt",
            F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts") - 1, F.lit(0)))),
        )
        .drop("_parts")
    )
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")


def _all_not_null(keys: list[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).isNotNull()
    return condition


def top_n_per_group(
    frame: DataFrame,
    keys: list[str],
    order: list[Column],
    n: int,
    parts: int = 1,
    rank: str | None = None,
) -> DataFrame:
    """First `n` rows of each group.

    Spark limits each group inside a task before the shuffle, so one task at the
    end sees at most tasks * n rows of a group. Where that is still much (large
    n), `parts` > 1 adds a step between: input partitions are dealt into parts,
    a group is limited per part, and the last step sees parts * n rows of it.
    The answer is the same.
    """
    out = frame
    if parts > 1:
        out = out.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(parts)))
        window = Window.partitionBy(*keys, "_part").orderBy(*order)
        out = (
            out.withColumn("_rn", F.row_number().over(window))
            .where(F.col("_rn") <= n)
            .drop("_rn", "_part")
        )
    window = Window.partitionBy(*keys).orderBy(*order)
    name = rank or "_rn"
    out = out.withColumn(name, F.row_number().over(window)).where(F.col(name) <= n)
    return out if rank else out.drop("_rn")
