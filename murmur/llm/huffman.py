"""Token ids in a file format of canonical length-limited Huffman codes."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmur.llm.common import clean_text, partitions, ship, stored
from murmur.llm.units import ByteBpe

ship(__name__)

END = 2
MAX_BITS = 18
# Ids in a block, and ids between two checkpoints inside it.
BLOCK = 1 << 18
STRIDE = 128
# Texts handed to the tokenizer at once.
BATCH_ROWS = 1000

PLAIN = "part int, block long, first_doc long, doc_ids array<long>, lengths array<long>, ids binary"
BLOCKS = (
    "part int, block long, first_doc long, doc_ids array<long>, lengths array<long>, "
    "n long, bits long, checkpoints binary, payload binary"
)


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Best prefix code lengths of at most `limit` bits (package-merge); 0 where the count is 0.

    The work is symbols x limit, bounded by the vocabulary and not by the corpus.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    limit = max(limit, math.ceil(math.log2(len(used))))
    used = used[np.argsort(counts[used], kind="stable")]
    leaf = counts[used].astype(np.float64)
    # Each level is the merge of the leaves with pairs of the level below.
    levels = []
    packages = np.zeros(0)
    for _ in range(limit):
        weights = np.concatenate([leaf, packages])
        order = np.argsort(weights, kind="stable")
        levels.append(order < len(leaf))
        weights = weights[order]
        pairs = len(weights) // 2
        packages = weights[: 2 * pairs : 2] + weights[1 : 2 * pairs : 2]
    take, depth = 2 * len(used) - 2, np.zeros(len(used), np.int64)
    for is_leaf in reversed(levels):
        leaves = int(is_leaf[:take].sum())
        depth[:leaves] += 1
        take = 2 * (take - leaves)
    lengths[used] = depth
    return lengths


def _in_order(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Used symbols in order of (length, symbol), the share of the code space of each, and its bits."""
    used = np.flatnonzero(lengths)
    order = used[np.argsort(lengths[used], kind="stable")]
    width = int(lengths.max()) if len(used) else 1
    return order, np.int64(1) << (width - lengths[order].astype(np.int64)), width


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, symbol), counted up as in canonical Huffman codes."""
    order, share, width = _in_order(lengths)
    codes = np.zeros(len(lengths), np.uint32)
    codes[order] = (np.cumsum(share) - share) >> (width - lengths[order].astype(np.int64))
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Symbol and code length for every window of as many bits as the longest code."""
    order, share, width = _in_order(lengths)
    symbols = np.zeros(1 << width, np.uint32)
    steps = np.zeros(1 << width, np.uint8)
    symbols[: share.sum()] = np.repeat(order, share)
    steps[: share.sum()] = np.repeat(lengths[order], share)
    return symbols, steps, width


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray, stride: int = STRIDE):
    """(payload, bit offset of every `stride`-th id, bits). Most significant bit first."""
    if not len(ids):
        return b"", np.zeros(0, np.uint32), 0
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    starts = ends - size
    word = starts >> 6
    code = codes[ids].astype(np.uint64)
    # Left-justify the code in 64 bits, then move it to its place in its word.
    left = code << (np.uint64(64) - size.astype(np.uint64))
    shift = (starts & 63).astype(np.uint64)
    out = np.zeros((int(ends[-1]) >> 6) + 2, np.uint64)
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    out[word[first]] = np.bitwise_or.reduceat(left >> shift, first)
    over = np.flatnonzero((starts & 63) + size > 64)
    out[word[over] + 1] |= left[over] << (np.uint64(64) - shift[over])
    bits = int(ends[-1])
    payload = out.astype(">u8").tobytes()[: (bits + 7) // 8]
    return payload, starts[::stride].astype(np.uint32), bits


def unpack(
    payload: bytes, checkpoints: np.ndarray, n: int, table, stride: int = STRIDE
) -> np.ndarray:
    """The `n` ids of a block. All stretches between checkpoints are read side by side."""
    symbols, steps, width = table
    if not n:
        return np.zeros(0, np.uint32)
    data = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint32)
    # Four bytes from any byte on: a window of at most 25 bits starts in the first.
    four = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
    at = checkpoints.astype(np.int64)
    out = np.zeros((len(at), stride), np.uint32)
    last = len(four) - 1
    drop = np.uint32(32 - width)
    for k in range(stride):
        here = four[np.minimum(at >> 3, last)] << (at & 7).astype(np.uint32)
        found = here >> drop
        out[:, k] = symbols[found]
        at += steps[found]
    return out.ravel()[:n]


def _encoder(tokenizer_path: str, end: int, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe.of(tokenizer_path)
        held: list[bytes] = []
        docs: list[int | None] = []
        size = block = first = 0
        part = -1

        def row() -> pa.RecordBatch:
            lengths = [len(x) // 4 for x in held]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([block], pa.int64()),
                    pa.array([first], pa.int64()),
                    pa.array([docs], pa.list_(pa.int64())),
                    pa.array([lengths], pa.list_(pa.int64())),
                    pa.array([narrow(b"".join(held))], pa.binary()),
                ],
                ["part", "block", "first_doc", "doc_ids", "lengths", "ids"],
            )

        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                few = batch.slice(at, BATCH_ROWS)
                part = few.column("part")[0].as_py()
                for doc, ids in zip(
                    few.column("doc_id").to_pylist(),
                    bpe.encode(few.column("text").to_pylist(), end),
                ):
                    if held and size + len(ids) // 4 > block_ids:
                        yield row()
                        block, first = block + 1, first + len(held)
                        held, docs, size = [], [], 0
                    held.append(ids)
                    docs.append(doc)
                    size += len(ids) // 4
        if held:
            yield row()

    return run


def narrow(ids: bytes) -> bytes:
    """One byte for the width of an id, then the ids in that width."""
    wide = np.frombuffer(ids, "<u4")
    if len(wide) and wide.max() >= 1 << 16:
        return b"\x04" + ids
    return b"\x02" + wide.astype("<u2").tobytes()


def widened(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, f"<u{ids[0]}", offset=1)


def encode_ids(
    documents: DataFrame, tokenizer_path: str, end: int = END, block_ids: int = BLOCK
) -> DataFrame:
    """Blocks of plain ids of whole texts in ascending doc_id order.

    Parts are ranges of doc_id, and within a part documents are in order. `end` follows
    each document. Null text counts as empty. Rows of one doc_id are ordered by text,
    null doc_ids come first.
    """
    spark = documents.sparkSession
    ordered = (
        documents.select("doc_id", clean_text().alias("text"))
        .repartitionByRange(partitions(spark), "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .withColumn("part", F.spark_partition_id())
    )
    return ordered.mapInArrow(_encoder(tokenizer_path, end, block_ids), PLAIN)


def id_counts(plain: DataFrame) -> DataFrame:
    """id, n over all documents. A task hands on one row per distinct id it saw."""

    def count(batches):
        total = np.zeros(1, np.int64)
        for batch in batches:
            for cell in batch.column("ids"):
                here = np.bincount(widened(cell.as_py()), minlength=len(total))
                here[: len(total)] += total
                total = here
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"]
        )

    return (
        plain.select("ids")
        .mapInArrow(count, "id long, n long")
        .groupBy("id")
        .agg(F.sum("n").alias("n"))
    )


def _packer(lengths: np.ndarray, stride: int):
    def run(batches):
        codes = canonical_codes(lengths)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                ids = widened(row.column("ids")[0].as_py())
                payload, checkpoints, bits = pack(ids, codes, lengths, stride)
                kept = [row.column(c) for c in ("part", "block", "first_doc", "doc_ids", "lengths")]
                made = [
                    pa.array([len(ids)], pa.int64()),
                    pa.array([bits], pa.int64()),
                    pa.array([checkpoints.astype("<u4").tobytes()], pa.binary()),
                    pa.array([payload], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(
                    kept + made,
                    ["part", "block", "first_doc", "doc_ids", "lengths", "n", "bits", "checkpoints", "payload"],
                )

    return run


def write_ids(
    documents: DataFrame,
    tokenizer_path: str,
    end: int = END,
    max_bits: int = MAX_BITS,
    block_ids: int = BLOCK,
    stride: int = STRIDE,
    name: str = "token-ids",
) -> tuple[DataFrame, np.ndarray]:
    """Writes the ids of all documents; returns the file table and the code lengths.

    The format: one row per block, which stands alone: `part` and `block` give the order
    (ascending doc_id), `payload` the codes bit after bit, `checkpoints` the bit offset of
    every `stride`-th id, `doc_ids` and `lengths` the documents in it. A block has at most
    `block_ids` ids, more only for one longer document. With the code lengths (the header,
    one byte per id of the vocabulary) it is all that is needed to read the ids back. The
    blocks are Parquet rows, so any store that Spark writes to will do.

    Texts are tokenised once: blocks of plain ids are stored between counting and packing,
    and packing a block needs no other block, so the only shuffle is the one by doc_id.
    """
    plain = stored(encode_ids(documents, tokenizer_path, end, block_ids), f"{name}-plain", "zstd")
    counts = id_counts(plain).toPandas()
    totals = np.zeros(int(counts["id"].max()) + 1 if len(counts) else 1, np.int64)
    totals[counts["id"].to_numpy(np.int64)] = counts["n"].to_numpy(np.int64)
    lengths = code_lengths(totals, max_bits)
    return stored(plain.mapInArrow(_packer(lengths, stride), BLOCKS), name), lengths


def read_ids(blocks: DataFrame, lengths: np.ndarray, stride: int = STRIDE) -> DataFrame:
    """part, block, at, doc_id, n_tokens, ids_crc32 of each document, decoded block by block."""

    def run(batches):
        table = decode_table(lengths)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                checkpoints = np.frombuffer(row["checkpoints"], "<u4")
                ids = unpack(row["payload"], checkpoints, row["n"], table, stride).astype("<u4")
                data = ids.tobytes()
                ends = np.cumsum(row["lengths"]) * 4
                crcs = [zlib.crc32(data[e - 4 * n : e]) for e, n in zip(ends.tolist(), row["lengths"])]
                rows = len(crcs)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * rows, pa.int32()),
                        pa.array(np.arange(rows) + row["first_doc"], pa.int64()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(row["lengths"], pa.int64()),
                        pa.array(crcs, pa.int64()),
                    ],
                    ["part", "at", "doc_id", "n_tokens", "ids_crc32"],
                )

    return blocks.mapInArrow(run, "part int, at long, doc_id long, n_tokens long, ids_crc32 long")


def token_digest(
    documents: DataFrame, tokenizer_path: str, end: int = END, **options
) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the files.

    `start` counts the ids of all documents before in ascending doc_id order: ids of the
    parts before (one row per part, a small table) plus those before in the part.
    """
    blocks, lengths = write_ids(documents, tokenizer_path, end, **options)
    read = read_ids(blocks, lengths, options.get("stride", STRIDE))
    parts = blocks.groupBy("part").agg(F.sum("n").alias("_n"))
    before = parts.select(
        "part", (F.sum("_n").over(Window.orderBy("part")) - F.col("_n")).alias("_before")
    )
    here = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    return (
        read.withColumn("_in", F.sum("n_tokens").over(here) - F.col("n_tokens"))
        .join(F.broadcast(before), "part")
        .select(
            "doc_id",
            (F.col("_before") + F.col("_in")).cast("bigint").alias("start"),
            "n_tokens",
            "ids_crc32",
        )
    )
