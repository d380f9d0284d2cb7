"""Connected components of a large graph by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import stored


def _stars(edges: DataFrame, up: bool) -> DataFrame:
    """One star step on undirected edges (a < b), returned as such edges.

    `up`: each node ties its larger neighbours to the smallest of itself and its
    neighbours (large star). Else it ties itself and its smaller neighbours to the
    smallest of these (small star).
    """
    if up:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    else:
        around = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    tied = around.join(least, "u")
    if up:
        out = tied.where("v > u").select(F.col("v").alias("x"), F.col("m"))
    else:
        out = tied.select(F.col("v").alias("x"), "m").unionAll(least.select(F.col("u").alias("x"), "m"))
    return (
        out.where("x != m")
        .select(F.least("x", "m").alias("a"), F.greatest("x", "m").alias("b"))
        .distinct()
    )


def components(edges: DataFrame, name: str) -> DataFrame:
    """node, component (its smallest node) of every node that has an edge (a, b).

    Each round is written, so the plan stays short and a lost executor costs one round.
    Rounds grow with the logarithm of the nodes. Only counts come to the driver.
    """
    now = stored(
        edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        f"{name}-0",
    )
    at, before = 0, None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()
        if mark == before or mark[0] == 0:
            break
        before, at = mark, at + 1
        now = stored(_stars(_stars(now, up=True), up=False), f"{name}-{at}")
    # All edges now lead from a node to the smallest of its component.
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).unionAll(
        now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )
