"""CSV exports with line breaks inside quoted cells, read in many byte ranges a file.

Whether a byte range begins inside a quoted cell depends on all quotes before it: an odd
number means inside. So quotes are counted per range first, the parities of the ranges
before are added up, and then ranges are cut into records side by side. A record that
runs over the end of a range is put together from the pieces on either side.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Task functions travel with their code, so executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bytes of a range: the work of a task. Long enough for a long record, short enough to spread.
RANGE_BYTES = 64 << 20
PIECE = "file bigint, start bigint, step int, first boolean, record string"
# Steps of a piece: it ends a record begun earlier, is inside one, or begins one.
ENDS, INSIDE, BEGINS = 0, 1, 2


def _lines(spark: SparkSession, path: str, range_bytes: int) -> DataFrame:
    """file (a hash of its path), start (of the byte range), value: lines in file order.

    Read in a session of its own whose range size is fixed: ranges then depend on the files
    alone, not on how many cores there are at the moment.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", str(range_bytes))
    session.conf.set("spark.sql.files.minPartitionNum", "1")
    # Only line feeds end a line here: a carriage return may be part of a cell.
    return session.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
    )


def range_parities(lines: DataFrame, quote: str = '"') -> dict[int, dict[int, tuple[bool, bool]]]:
    """file -> start of range -> (begins, ends inside a cell). One entry for each range."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    counted = lines.groupBy("file", "start").agg(F.sum(quotes).alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("start")) - F.col("n")
    rows = counted.select("file", "start", F.pmod(before, F.lit(2)).alias("odd"), "n").collect()
    found: dict[int, dict[int, tuple[bool, bool]]] = {}
    for r in rows:
        found.setdefault(r["file"], {})[r["start"]] = (bool(r["odd"]), bool((r["odd"] + r["n"]) % 2))
    return found


class RangeCutter:
    """Cuts the lines of one range, given batch by batch, into records and pieces."""

    def __init__(self, file: int, start: int, inside: bool, quote: str):
        self.file, self.start, self.inside, self.quote = file, start, inside, quote
        self.headless = inside  # what comes first belongs to a record begun earlier
        self.first = start == 0  # the next record is the file's first
        self.rest: list[pa.Array] = []  # lines of the open record
        self.whole, self.pieces = [], []

    def take(self, lines: pa.Array) -> None:
        odd = pc.count_substring(lines, self.quote).to_numpy(zero_copy_only=False) % 2
        inside = (np.cumsum(odd) + self.inside) % 2 == 1
        closes = np.flatnonzero(~inside)  # lines after which no cell is open
        if not len(closes):
            self.rest.append(lines)
            self.inside = self.inside or bool(len(lines))
            return
        cut = int(closes[-1]) + 1
        if self.rest:
            begun = int(closes[0]) + 1
            self._record(pa.concat_arrays([*self.rest, lines.slice(0, begun)]))
            closes, lines = closes[1:] - begun, lines.slice(begun)
            cut -= begun
        elif self.headless:
            begun = int(closes[0]) + 1
            self._record(lines.slice(0, begun))
            closes, lines = closes[1:] - begun, lines.slice(begun)
            cut -= begun
        self.rest = [lines.slice(cut)] if cut < len(lines) else []
        self.inside = bool(self.rest)
        if len(closes):
            ends = np.concatenate([[0], closes + 1]).astype(np.int32)
            grouped = pa.ListArray.from_arrays(pa.array(ends), lines.slice(0, cut))
            self._records(pc.binary_join(grouped, "\n"))

    def _record(self, lines: pa.Array) -> None:
        text = "\n".join(lines.to_pylist())
        if self.headless:
            self.pieces.append((ENDS, False, text))
            self.headless = False
        else:
            self._records(pa.array([text], pa.string()))

    def _records(self, records: pa.Array) -> None:
        records = pc.utf8_rtrim(records, "\r")
        records = records.filter(pc.not_equal(records, ""))
        if self.first and len(records):
            self.first = False
            self.whole.append((True, records.slice(0, 1)))
            records = records.slice(1)
        if len(records):
            self.whole.append((False, records))

    def finish(self) -> None:
        if self.rest:
            text = "\n".join(pa.concat_arrays(self.rest).to_pylist())
            self.pieces.append((INSIDE if self.headless else BEGINS, self.first, text))
            self.rest = []


def _batch(file: int, start: int, step: int | None, first: bool, records: pa.Array) -> pa.RecordBatch:
    n = len(records)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([file] * n, pa.int64()),
            pa.array([start] * n, pa.int64()),
            pa.array([step] * n, pa.int32()),
            pa.array([first] * n, pa.bool_()),
            records.cast(pa.string()),
        ],
        ["file", "start", "step", "first", "record"],
    )


def cut_ranges(lines: DataFrame, parities: dict, pieces: bool, quote: str = '"') -> DataFrame:
    """Whole records of every range, or its `pieces` of records that cross its ends."""

    def run(batches):
        cutter = None

        def found():
            for first, records in cutter.whole:
                if not pieces:
                    yield _batch(cutter.file, cutter.start, None, first, records)
            if pieces:
                for step, first, text in cutter.pieces:
                    yield _batch(cutter.file, cutter.start, step, first, pa.array([text]))
            cutter.whole, cutter.pieces = [], []

        for batch in batches:
            file = batch.column("file").to_numpy()
            start = batch.column("start").to_numpy()
            value = batch.column("value").cast(pa.string())
            new = np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1
            bounds = [0, *new.tolist(), len(value)]
            for a, b in zip(bounds[:-1], bounds[1:]):
                if a == b:
                    continue
                here = (int(file[a]), int(start[a]))
                if cutter is None or (cutter.file, cutter.start) != here:
                    if cutter is not None:
                        cutter.finish()
                        yield from found()
                    # A range that was not counted: the files have changed since.
                    cutter = RangeCutter(*here, parities[here[0]][here[1]][0], quote)
                cutter.take(value.slice(a, b - a))
                yield from found()
        if cutter is not None:
            cutter.finish()
            yield from found()

    return lines.mapInArrow(run, PIECE)


def joined_records(pieces: DataFrame) -> DataFrame:
    """first, record: pieces put together. Each range gives two at most, so they are few.

    The pieces of a record follow one another in their file; each one that begins a record
    begins a new group.
    """
    inside_file = Window.partitionBy("file").orderBy("start", "step")
    number = F.sum(F.when(F.col("step") == BEGINS, 1).otherwise(0)).over(inside_file)
    parts = F.array_sort(F.collect_list(F.struct("start", "step", "record")))
    return (
        pieces.withColumn("number", number)
        .groupBy("file", "number")
        .agg(F.max("first").alias("first"), parts.alias("parts"))
        .select("first", F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"))
        .withColumn("record", F.rtrim("record", F.lit("\r")))
    )


def csv_records(
    spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, quote: str = '"'
) -> DataFrame:
    """first, record: every record of the files as text; `first` marks the first of a file.

    Two passes over the lines: one that counts, one that cuts. Ranges that neither begin
    nor end inside a cell have no pieces; if there are others, those alone are read once
    more for theirs. Blank lines outside cells are left out.
    """
    lines = _lines(spark, path, range_bytes)
    parities = range_parities(lines, quote)
    whole = cut_ranges(lines, parities, False, quote).select("first", "record")
    crossing = [(f, s) for f, starts in parities.items() for s, ends in starts.items() if any(ends)]
    if not crossing:
        return whole
    wanted = spark.createDataFrame(crossing, "file bigint, start bigint")
    few = lines.join(F.broadcast(wanted), ["file", "start"], "left_semi").select("file", "start", "value")
    return whole.unionByName(joined_records(cut_ranges(few, parities, True, quote)))


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str,
    header: bool = True,
    range_bytes: int = RANGE_BYTES,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Typed rows of CSV files whose cells may hold commas, doubled quotes and line breaks.

    Quotes stand at either end of a cell or doubled inside a quoted one (RFC 4180); a quote
    inside an unquoted cell would be taken for one that opens. Files are UTF-8. Compressed
    files are one range each.
    """
    records = csv_records(spark, path, range_bytes)
    if header:
        records = records.where(~F.col("first"))
    text = F.when(F.col("first"), F.ltrim("record", F.lit("﻿"))).otherwise(F.col("record"))
    options = {"quote": '"', "escape": '"', "mode": mode, "multiLine": "true"}
    return records.select(F.from_csv(text, schema, options).alias("row")).select("row.*")
