"""Reproducible shuffle into shards by a Feistel permutation of global row numbers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import clean_text, numbered

ROUNDS = 6
# The domain is less than sqrt(total) + 1 larger than the rows, so a walk is longer
# than one step for about one row in sqrt(total).
WALKS = 24
OVERHEAD = 16


def _step(x: Column, sides: tuple[int, int], seed: int) -> Column:
    """One pass of an alternating Feistel network on Z_a x Z_b."""
    a, b = (F.lit(s).cast("bigint") for s in sides)
    halves = F.struct(F.floor(x / b).cast("bigint").alias("l"), F.pmod(x, b).alias("r"))

    def round_(state: Column, key: Column) -> Column:
        left = F.pmod(
            state["l"] + F.pmod(F.xxhash64(state["r"], key * 2 + F.lit(seed)), a), a
        )
        # The new left half feeds the right one.
        return F.transform(
            F.array(left),
            lambda l: F.struct(
                l.alias("l"),
                F.pmod(
                    state["r"] + F.pmod(F.xxhash64(l, key * 2 + F.lit(seed + 1)), b), b
                ).alias("r"),
            ),
        )[0]

    keys = F.sequence(F.lit(0).cast("bigint"), F.lit(ROUNDS - 1).cast("bigint"))
    return F.aggregate(keys, halves, round_, lambda s: s["l"] * b + s["r"])


def sides_of(total: int) -> tuple[int, int]:
    """Smallest near-square grid with at least `total` cells."""
    a = max(1, math.isqrt(max(total - 1, 0)) + 1)
    return a, max(1, -(-total // a))


def permuted(row: Column, total: int, seed: int = 0) -> Column:
    """Place of row number `row` in a shuffle of 0 .. total-1; a bijection.

    A value outside the rows is fed in again until it falls inside (cycle walking). A
    walk of more than WALKS steps, which has a chance below (1/sqrt(total))^WALKS, ends
    the job instead of giving a wrong place.
    """
    sides = sides_of(total)
    walk = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALKS)),
        _step(row, sides, seed),
        lambda x, _: F.when(x >= F.lit(total), _step(x, sides, seed)).otherwise(x),
    )
    return F.transform(
        F.array(walk),
        lambda x: F.when(x < F.lit(total), x).otherwise(
            F.raise_error(F.lit("cycle walk too long; raise WALKS")).cast("bigint")
        ),
    )[0]


def shard_rows(
    frame: DataFrame, order: list[str], shards: int, seed: int = 0, name: str = "shards"
) -> DataFrame:
    """Adds `row`, `shard` and `slot`: the row's number, its shard and its place there.

    `row` is the global number in ascending order of `order` (nulls first). The shuffled
    place p gives shard p mod shards and slot p div shards, so row counts of shards
    differ by at most one, slots have no gaps, and both follow from (row, total, seed)
    alone. An empty table gives no rows; with fewer rows than shards some stay empty.
    """
    rows = numbered(frame, order, name)
    total = rows.count()
    place = permuted(F.col("row"), total, seed)
    return (
        rows.withColumn("_p", place)
        .withColumn("shard", F.pmod(F.col("_p"), F.lit(shards)).cast("int"))
        .withColumn("slot", F.floor(F.col("_p") / F.lit(shards)).cast("bigint"))
        .drop("_p")
    )


def shard_documents(documents: DataFrame, shards: int = 40, seed: int = 7) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and row of every document.

    The law is `rows`: shard sizes differ by one row at most. `grown_shard` is null, as
    this law moves most rows when a shard is added. Null text counts as empty: size 16,
    crc32 of nothing. Rows with the same doc_id are told apart by text; equal rows may
    swap places, which changes nothing in the result. Columns other than doc_id and text
    are not read.
    """
    text = F.encode(clean_text(), "UTF-8")
    narrow = documents.select(
        "doc_id",
        (F.octet_length(clean_text()) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    out = shard_rows(narrow, ["doc_id", "text_crc32", "size"], shards, seed)
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "row",
    )
