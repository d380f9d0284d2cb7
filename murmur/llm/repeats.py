"""Removal of byte strings that also start in a document with a smaller id, exactly.

Every window of `size` bytes is dealt by the smallest hash among its grams (its anchor), so
equal windows meet in one shard wherever they stand. Neighbouring windows with one anchor
travel as one segment.

1. Documents are packed into blocks of some megabytes, stored compressed.
2. Blocks tell shards their anchors. What two documents share has an anchor that both
   have, so only those are told back: the rest of the text goes nowhere.
3. Blocks send the segments of shared anchors, each distinct one once. A shard joins what
   may be equal (text around an anchor that another segment has, too) into one text, sorts
   its suffixes by induction, and windows are equal where permuted common prefixes of
   neighbours reach `size`. Each window gets its smallest document.
4. Shards tell blocks, segment by segment, the windows that a smaller document has, and
   blocks cut the bytes that these cover.

Hot places: a segment that many documents share is one entry a block. An anchor that very
many different segments share (a common line in many surroundings) is dealt anew, window
by window, by the whole window. So no shard gets a row for each document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import ship, stored
from murmur.llm.suffixes import permuted_prefixes, suffix_array
from murmur.llm.words import mixed, utf8

ship(__name__)

SIZE = 50
GRAM = 16
# Text of a block and of a shard, in bytes; a longer document is a block of its own.
BLOCK_BYTES = 4 << 20
SHARD_BYTES = 4 << 20
# Starts of windows that are hashed together.
CHUNK = 1 << 18
# Windows are compared by what all those have in common whose anchor stands in one of so
# many ranges of places.
RANGES = 5
# An anchor with more segments than this, each counted once a block, is dealt by windows.
HOT = 4000
# Compression of what travels once, and of texts, which are stored and travel twice.
LEVEL, TEXT_LEVEL = 3, 6
# Stands for a null doc_id, which comes before every other.
NO_ID = np.iinfo(np.int64).min

PLACE = np.uint64((1 << 20) - 1)
A, B, C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
BLOCK = (
    "block bigint, kind int, ids array<bigint>, sizes array<bigint>, payload binary"
)
SENT = "shard int, block bigint, payload binary"
TOLD = "block bigint, payload binary"


def packed(*arrays: np.ndarray, level: int = LEVEL) -> bytes:
    """Arrays in one compressed string. Numbers are stored as differences, their first bytes
    together, then their second ones and so on: rising numbers leave little."""
    parts = []
    for a in arrays:
        if a.itemsize > 1:
            a = np.diff(a, prepend=a.dtype.type(0))
            a = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T
        parts.append(np.ascontiguousarray(a).tobytes())
    body = b"".join(parts)
    sizes = np.array([len(body), *map(len, parts)], np.int64)
    return sizes.tobytes() + pa.Codec("zstd", level).compress(body, asbytes=True)


def unpacked(payload: bytes, *types) -> list[np.ndarray]:
    head = 8 * (len(types) + 1)
    whole, *sizes = np.frombuffer(payload[:head], np.int64).tolist()
    body = pa.Codec("zstd").decompress(payload[head:], whole, asbytes=True)
    out, at = [], 0
    for size, kind in zip(sizes, map(np.dtype, types)):
        a = np.frombuffer(body, np.uint8, size, at)
        if kind.itemsize > 1:
            a = np.ascontiguousarray(a.reshape(kind.itemsize, -1).T).view(kind)[:, 0]
            a = np.cumsum(a, dtype=kind)
        out.append(a)
        at += size
    return out


def gram_hashes(body: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each place on."""
    words = np.ndarray((len(body) - 7,), "<u8", body, strides=(1,)).astype(np.uint64)
    return gram_hash(words[:-8], words[8:])


def gram_hash(head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    x = head * A
    x ^= x >> np.uint64(29)
    x += tail * B
    x ^= x >> np.uint64(32)
    x *= C
    x ^= x >> np.uint64(29)
    return x


def segments(body: np.ndarray, offsets: np.ndarray, size: int):
    """Yields (start, number of windows, anchor) of the segments of a block, as arrays.

    body: all texts one after another; text i is body[offsets[i] : offsets[i + 1]].
    """
    n = len(body) - size + 1
    if n <= 0:
        return
    reach = size - GRAM + 1
    ends = offsets[1:]
    for low in range(0, n, CHUNK):
        high = min(low + CHUNK, n)
        part = np.ascontiguousarray(body[low : high + size - 1])
        hashes = gram_hashes(part)
        # Ties of the smallest hash go to the first gram.
        least = (hashes & ~PLACE) | np.arange(len(hashes), dtype=np.uint64)
        width = 1
        while width * 2 <= reach:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < reach:
            least = np.minimum(least[: width - reach], least[reach - width :])
        place = (least & PLACE).astype(np.int64)
        # Windows that would run over the end of their text are none.
        whole = np.ones(len(place), bool)
        near = ends[(ends > low) & (ends < high + size)] - low
        begins = np.concatenate([[0], near[:-1]]) if len(near) else near
        for a, b in zip(np.maximum(near - size + 1, begins).tolist(), near.tolist()):
            whole[a:b] = False
        new = np.ones(len(place), bool)
        new[1:] = place[1:] != place[:-1]
        # Windows on either side of an end never are neighbours, as some lie between.
        new[1:] |= ~whole[:-1]
        starts = np.flatnonzero(new & whole)
        if not len(starts):
            continue
        stop = np.ones(len(place), bool)
        stop[:-1] = new[1:] | ~whole[1:]
        counts = np.flatnonzero(stop & whole) - starts + 1
        # 48 bits name an anchor: two of one name are only compared for nothing.
        yield starts + low, counts, hashes[place[starts]] >> np.uint64(16)


def all_segments(body: np.ndarray, offsets: np.ndarray, size: int):
    found = list(segments(body, offsets, size))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


class Block:
    """A block's rows in a task: texts, ids and what was told."""

    def __init__(self, table: pa.Table):
        kinds = table.column("kind").to_numpy()
        (own,) = np.flatnonzero(kinds == 0)
        self.block = table.column("block")[int(own)].as_py()
        self.ids = table.column("ids")[int(own)].values
        sizes = table.column("sizes")[int(own)].values.to_numpy()
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        (self.body,) = unpacked(table.column("payload")[int(own)].as_py(), np.uint8)
        self.keys = self.ids.fill_null(NO_ID).to_numpy()
        told = {k: [table.column("payload")[int(i)].as_py() for i in np.flatnonzero(kinds == k)] for k in (1, 2)}
        self.told, self.answers = told[1], told[2]

    def shared(self, size: int):
        """Segments with a shared anchor: (start, windows, number of the distinct string, text)
        of each, then (first segment, hash by which it is dealt) of each distinct string."""
        anchors, hot = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint8)]
        for payload in self.told:
            a, b = unpacked(payload, np.uint64, np.uint8)
            anchors.append(a)
            hot.append(b)
        anchors, hot = np.concatenate(anchors), np.concatenate(hot)
        order = np.argsort(anchors)
        anchors, hot = anchors[order], hot[order].astype(bool)
        starts, counts, dealt, by_window = [], [], [], []
        if len(anchors):
            for s, c, h in segments(self.body, self.offsets, size):
                at = np.minimum(np.searchsorted(anchors, h), len(anchors) - 1)
                told = anchors[at] == h
                whole, split = told & ~hot[at], told & hot[at]
                n = c[split]
                each = np.repeat(s[split] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                starts += [s[whole], each]
                counts += [c[whole], np.ones(len(each), np.int64)]
                dealt += [h[whole], np.zeros(len(each), np.uint64)]
                by_window += [np.zeros(int(whole.sum()), bool), np.ones(len(each), bool)]
        if not sum(map(len, starts)):
            none = np.zeros(0, np.int64)
            return none, none, none, none, none, none.astype(np.uint64)
        starts, counts = np.concatenate(starts), np.concatenate(counts)
        dealt, by_window = np.concatenate(dealt), np.concatenate(by_window)
        text = np.searchsorted(self.offsets, starts, side="right") - 1
        content = content_hashes(self.body, starts, counts + size - 1)
        dealt[by_window] = content[by_window]
        number, first = distinct(self.body, starts, counts, content, size)
        return starts, counts, number, text, first, mixed(dealt[first])


def content_hashes(body: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each string of at least 8 bytes: 8 at a time, the last 8 anew."""
    words = np.ndarray((len(body) - 7,), "<u8", body, strides=(1,))
    x = mixed(sizes.astype(np.uint64))
    for at in range(0, int(sizes.max(initial=0)), 8):
        open_ = np.flatnonzero(sizes > at)
        place = starts[open_] + np.minimum(at, sizes[open_] - 8)
        x[open_] = mixed((x[open_] ^ words[place]) * A + C)
    return x


def same_bytes(body: np.ndarray, a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the strings of `sizes` bytes at a and at b are equal, byte for byte."""
    words = np.ndarray((len(body) - 7,), "<u8", body, strides=(1,))
    same = np.ones(len(a), bool)
    for at in range(0, int(sizes.max(initial=0)), 8):
        open_ = np.flatnonzero(same & (sizes > at))
        skip = np.minimum(at, sizes[open_] - 8)
        same[open_] = words[a[open_] + skip] == words[b[open_] + skip]
    return same


def distinct(body, starts, counts, content, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of each segment's distinct string, first segment of each number).

    Segments of one hash are held together only where their bytes are equal; unequal ones
    that fall between equal ones cost a number more, which does no harm.
    """
    order = np.lexsort((counts, content))
    a, b = order[:-1], order[1:]
    like = np.flatnonzero((content[a] == content[b]) & (counts[a] == counts[b]))
    equal = np.zeros(max(len(order) - 1, 0), bool)
    equal[like] = same_bytes(body, starts[a[like]], starts[b[like]], counts[a[like]] + size - 1)
    number = np.empty(len(order), np.int64)
    number[order] = np.concatenate([[0], np.cumsum(~equal)]) if len(order) else 0
    first = order[np.flatnonzero(np.concatenate([[True], ~equal]))] if len(order) else order
    return number, first


def gathered(body: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The strings at `starts`, one after another."""
    begins = np.cumsum(sizes) - sizes
    return body[np.repeat(starts - begins, sizes) + np.arange(int(sizes.sum()))]


def by_group(values: np.ndarray):
    """(order that sorts, first place of each group in it, its value)."""
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(order) else order
    return order, first, ranked[first]


def pack_blocks(documents: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows of `documents` (doc_id, text) in blocks of about `block_bytes`; no text is cut."""

    def run(batches):
        part, k = TaskContext.get().partitionId(), 0
        ids, texts, held = [], [], 0

        def block():
            body, offsets = utf8(pa.concat_arrays(texts))
            names = pa.concat_arrays(ids)
            row = [
                pa.array([part << 32 | k], pa.int64()),
                pa.array([0], pa.int32()),
                pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names),
                pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), pa.array(np.diff(offsets))),
                pa.array([packed(body, level=TEXT_LEVEL)], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(row, ["block", "kind", "ids", "sizes", "payload"])

        for batch in batches:
            _, offsets = utf8(batch.column("text"))
            first = 0
            while first < batch.num_rows:
                room = offsets[first] + max(block_bytes - held, 0)
                last = int(np.searchsorted(offsets, room, side="right")) - 1
                last = min(max(last, first + (not held)), batch.num_rows)
                if last > first:
                    piece = batch.slice(first, last - first)
                    ids.append(pa.concat_arrays([piece.column("doc_id").cast(pa.int64())]))
                    texts.append(pa.concat_arrays([piece.column("text").cast(pa.large_string())]))
                    held += int(offsets[last] - offsets[first])
                if last < batch.num_rows:
                    yield block()
                    k += 1
                    ids, texts, held = [], [], 0
                first = last
        if ids:
            yield block()

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, BLOCK)


def anchors_of_blocks(blocks: DataFrame, shards: int, size: int) -> DataFrame:
    """One row per block and shard: the block's distinct anchors, how many segments each has,
    and whether two documents of the block have it."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(pa.Table.from_batches([batch.slice(i, 1)]))
                starts, _, anchor = all_segments(block.body, block.offsets, size)
                text = np.searchsorted(block.offsets, starts, side="right") - 1
                order, first, names = by_group(anchor)
                if not len(order):
                    continue
                key = block.keys[text[order]]
                several = np.minimum.reduceat(key, first) != np.maximum.reduceat(key, first)
                n = np.diff(np.concatenate([first, [len(order)]])).astype(np.uint32)
                shard = mixed(names) % np.uint64(shards)
                order, first, names_of = by_group(shard)
                cuts = np.concatenate([first, [len(order)]])
                rows = [
                    packed(names[at], n[at], several[at].astype(np.uint8))
                    for at in (order[cuts[j] : cuts[j + 1]] for j in range(len(first)))
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names_of.astype(np.int32)),
                        pa.array(np.full(len(rows), block.block)),
                        pa.array(rows, pa.binary()),
                    ],
                    ["shard", "block", "payload"],
                )

    return blocks.mapInArrow(run, SENT)


def shared_anchors(table: pa.Table, hot: int) -> pa.Table:
    """In a shard: tells each block which of its anchors another document may have, too."""
    blocks = table.column("block").to_numpy()
    payloads = [unpacked(x, np.uint64, np.uint32, np.uint8) for x in table.column("payload").to_pylist()]
    anchor, n, several = (np.concatenate(x) for x in zip(*payloads))
    owner = np.repeat(np.arange(len(blocks)), [len(x[0]) for x in payloads])
    order, first, _ = by_group(anchor)
    sizes = np.diff(np.concatenate([first, [len(order)]]))
    shared = (sizes > 1) | (np.maximum.reduceat(several[order], first) > 0)
    many = np.add.reduceat(n[order].astype(np.int64), first) > hot
    kept = np.repeat(shared, sizes)
    told, crowded = order[kept], np.repeat(many, sizes)[kept]
    at, first, owners = by_group(owner[told])
    cuts = np.concatenate([first, [len(at)]])
    rows = [
        packed(anchor[told[k]], crowded[k].astype(np.uint8))
        for k in (at[cuts[j] : cuts[j + 1]] for j in range(len(first)))
    ]
    return pa.table({"block": pa.array(blocks[owners]), "payload": pa.array(rows, pa.binary())})


def segments_of_block(table: pa.Table, shards: int, size: int) -> pa.Table:
    """A block's distinct segments with shared anchors, one row per shard: windows of each, its
    number in the block, its smallest and largest document, and the bytes."""
    block = Block(table)
    starts, counts, number, text, first, spread = block.shared(size)
    order, begin, _ = by_group(number)
    key = block.keys[text]
    low = np.minimum.reduceat(key[order], begin) if len(begin) else key
    high = np.maximum.reduceat(key[order], begin) if len(begin) else key
    starts, counts = starts[first], counts[first]
    order, begin, shard = by_group(spread % np.uint64(shards))
    cuts = np.concatenate([begin, [len(order)]])
    rows = [
        packed(
            counts[at].astype(np.uint16),
            at.astype(np.uint32),
            low[at],
            high[at],
            gathered(block.body, starts[at], counts[at] + size - 1),
        )
        for at in (order[cuts[j] : cuts[j + 1]] for j in range(len(begin)))
    ]
    return pa.table(
        {
            "shard": pa.array(shard.astype(np.int32)),
            "block": pa.array(np.full(len(rows), block.block)),
            "payload": pa.array(rows, pa.binary()),
        }
    )


def anchor_places(body: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Where the anchor of the window at each start begins."""
    words = np.ndarray((len(body) - 7,), "<u8", body, strides=(1,))
    places, least = starts.copy(), np.full(len(starts), ~np.uint64(0))
    for step in range(size - GRAM + 1):
        here = starts + step
        hashes = gram_hash(words[here], words[here + 8]) & ~PLACE
        less = hashes < least
        places[less], least[less] = here[less], hashes[less]
    return places


def alike(body: np.ndarray, starts: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first window, number of windows) of each segment that may be equal to another's.

    Equal windows have their anchor at one place. All windows whose anchor stands at places
    a to b of them hold the same `size - (b - a)` bytes around it: where no other segment
    has these bytes, none of those windows is in another one.
    """
    places = anchor_places(body, starts, size)
    most = places - starts
    least = most - counts + 1
    low, high = np.full(len(starts), size), np.full(len(starts), -1)
    ranges = np.array_split(np.arange(size - GRAM + 1), min(RANGES, size - GRAM + 1))
    for a, b in ((int(r[0]), int(r[-1])) for r in ranges):
        has = np.flatnonzero((least <= b) & (most >= a))
        around = content_hashes(body, places[has] - a, np.full(len(has), size - (b - a)))
        order, first, _ = by_group(around)
        group = np.diff(np.concatenate([first, [len(order)]]))
        shared = has[order[np.repeat(group > 1, group)]]
        low[shared] = np.minimum(low[shared], a)
        high[shared] = b
    low, high = np.maximum(low, least), np.minimum(high, most)
    return most - high, np.maximum(high - low + 1, 0)


def smallest_documents(
    body: np.ndarray, starts: np.ndarray, counts: np.ndarray, low: np.ndarray, size: int
) -> np.ndarray:
    """For every window of every segment, in order: the smallest document that has it.

    low: the smallest document of each segment. Windows that may be equal to another
    segment's become one text, those of a segment ended by 0; equal windows are neighbours
    among its sorted suffixes. The rest is equal to nothing else.
    """
    skip, windows = alike(body, starts, counts, size)
    some = np.flatnonzero(windows)
    out = np.repeat(low, counts)
    if len(some):
        skip, windows = skip[some], windows[some]
        begins = (np.cumsum(counts) - counts)[some] + skip
        at = np.repeat(begins - (np.cumsum(windows) - windows), windows) + np.arange(int(windows.sum()))
        out[at] = sorted_windows(body, starts[some] + skip, windows, low[some], size)
    return out


def sorted_windows(
    body: np.ndarray, starts: np.ndarray, counts: np.ndarray, low: np.ndarray, size: int
) -> np.ndarray:
    """`smallest_documents` by the suffix array of all segments given."""
    sizes = counts + size - 1
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    t = np.zeros(int((sizes + 1).sum()), np.int64)
    at = np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    t[at] = gathered(body, starts, sizes).astype(np.int64) + 1
    sa = suffix_array(t, 257)
    common = permuted_prefixes(t, sa, begins, counts, size)
    first = np.flatnonzero(common[sa] < size)
    owner = np.repeat(low, sizes + 1)
    least = np.minimum.reduceat(owner[sa], first)
    out = np.empty(len(t), np.int64)
    out[sa] = np.repeat(least, np.diff(np.concatenate([first, [len(t)]])))
    return gathered(out, begins, counts)


def repeats_of_shard(table: pa.Table, size: int) -> pa.Table:
    """Tells each block which windows of its segments start in a smaller document than its
    largest one: number of the segment, first window, windows, smallest document."""
    blocks = table.column("block").to_numpy()
    payloads = [
        unpacked(x, np.uint16, np.uint32, np.int64, np.int64, np.uint8)
        for x in table.column("payload").to_pylist()
    ]
    counts, names, low, high, body = (np.concatenate(x) for x in zip(*payloads))
    owner = np.repeat(np.arange(len(blocks)), [len(x[0]) for x in payloads])
    del payloads
    counts = counts.astype(np.int64)
    sizes = counts + size - 1
    starts = np.cumsum(sizes) - sizes
    number, first = distinct(body, starts, counts, content_hashes(body, starts, sizes), size)
    order, begin, _ = by_group(number)
    windows = counts[first]
    least = smallest_documents(body, starts[first], windows, np.minimum.reduceat(low[order], begin), size)
    # Windows after one another with the same document are one run.
    segment = np.repeat(np.arange(len(first)), windows)
    new = np.ones(len(least), bool)
    new[1:] = (segment[1:] != segment[:-1]) | (least[1:] != least[:-1])
    run = np.flatnonzero(new)
    run_size = np.diff(np.concatenate([run, [len(least)]]))
    of = segment[run]
    run_first = run - (np.cumsum(windows) - windows)[of]
    runs = np.bincount(of, minlength=len(first))
    run_begin = np.cumsum(runs) - runs
    # Each block gets the runs that concern it.
    asks = np.flatnonzero(np.minimum.reduceat(least, np.cumsum(windows) - windows)[number] < high)
    n = runs[number[asks]]
    at = np.repeat(run_begin[number[asks]] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    asks = np.repeat(asks, n)
    told = least[run[at]] < high[asks]
    at, asks = at[told], asks[told]
    order, begin, owners = by_group(owner[asks])
    cuts = np.concatenate([begin, [len(order)]])
    rows = [
        packed(
            names[asks[k]],
            run_first[at[k]].astype(np.uint16),
            run_size[at[k]].astype(np.uint16),
            least[run[at[k]]],
        )
        for k in (order[cuts[j] : cuts[j + 1]] for j in range(len(begin)))
    ]
    return pa.table({"block": pa.array(blocks[owners]), "payload": pa.array(rows, pa.binary())})


def covered(block: Block, size: int) -> np.ndarray:
    """Which bytes of the block's texts go."""
    gone = np.zeros(len(block.body) + 1, np.int32)
    if block.answers:
        starts, _, number, text, first, _ = block.shared(size)
        told = [unpacked(x, np.uint32, np.uint16, np.uint16, np.int64) for x in block.answers]
        names, skip, windows, least = (np.concatenate(x) for x in zip(*told))
        order = np.argsort(names, kind="stable")
        skip, windows, least = skip[order].astype(np.int64), windows[order].astype(np.int64), least[order]
        runs = np.bincount(names, minlength=len(first))
        n = runs[number]
        at = np.repeat((np.cumsum(runs) - runs)[number] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        segment = np.repeat(np.arange(len(number)), n)
        cut = least[at] < block.keys[text[segment]]
        at, begin = at[cut], starts[segment[cut]] + skip[at[cut]]
        np.add.at(gone, begin, 1)
        np.add.at(gone, begin + windows[at] + size - 1, -1)
    return np.cumsum(gone[:-1]) > 0


CUT = "doc_id bigint, n_bytes bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"


def cut_block(table: pa.Table, size: int) -> pa.Table:
    block = Block(table)
    gone, offsets = covered(block, size), block.offsets
    edge = np.zeros(len(gone) + 1, bool)
    edge[offsets] = True
    begin, end = gone & edge[:-1], gone & edge[1:]
    begin[1:] |= gone[1:] & ~gone[:-1]
    end[:-1] |= gone[:-1] & ~gone[1:]
    begin, end = np.flatnonzero(begin), np.flatnonzero(end) + 1
    text = np.searchsorted(offsets, begin, side="right") - 1
    rows = np.searchsorted(text, np.arange(len(offsets)))
    spans = pa.StructArray.from_arrays(
        [pa.array(begin - offsets[text]), pa.array(end - offsets[text])], ["start", "end"]
    )
    removed = np.concatenate([[0], np.cumsum(gone)])[offsets]
    kept = pa.Array.from_buffers(
        pa.large_binary(),
        len(offsets) - 1,
        [None, pa.py_buffer(offsets - removed), pa.py_buffer(block.body[~gone].tobytes())],
    )
    return pa.table(
        {
            "doc_id": block.ids,
            "n_bytes": pa.array(np.diff(offsets)),
            "n_removed": pa.array(np.diff(removed)),
            "spans": pa.ListArray.from_arrays(pa.array(rows, pa.int32()), spans),
            "kept": kept.cast(pa.binary()),
        }
    )


def remove_repeats(
    documents: DataFrame,
    size: int = SIZE,
    block_bytes: int = BLOCK_BYTES,
    shard_bytes: int = SHARD_BYTES,
    hot: int = HOT,
) -> DataFrame:
    """One row per row of `documents`: doc_id, n_bytes, n_removed, spans, kept.

    Texts are their UTF-8 bytes, null is empty. A byte goes if a string of `size` bytes
    over it also starts in a document with a smaller doc_id, judged on the texts as they
    came. Rows of one doc_id take nothing from one another; a null doc_id comes before all
    others. spans are the maximal removed ranges in bytes, kept is the rest joined. A text
    shorter than `size` stays. Only doc_id and text are read; an empty table gives no rows.
    The result does not depend on `block_bytes`, `shard_bytes` and `hot`, which say how
    much a task holds at once; a task holds a longest text whole.
    """
    if size < GRAM:
        raise ValueError(f"strings of at least {GRAM} bytes")
    blocks = stored(pack_blocks(documents, block_bytes), "blocks", "uncompressed")
    total = F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, b: a + b))
    total = blocks.select(total.alias("n")).collect()[0]["n"] or 0
    shards = max(1, -(-total // shard_bytes))

    def told(frame: DataFrame, kind: int) -> DataFrame:
        return frame.select(
            "block",
            F.lit(kind).alias("kind"),
            F.lit(None).cast("array<bigint>").alias("ids"),
            F.lit(None).cast("array<bigint>").alias("sizes"),
            "payload",
        )

    anchors = anchors_of_blocks(blocks, shards, size).groupBy("shard")
    shared = stored(anchors.applyInArrow(lambda t: shared_anchors(t, hot), TOLD), "shared-anchors", "uncompressed")
    asking = blocks.unionByName(told(shared, 1))
    sent = asking.groupBy("block").applyInArrow(lambda t: segments_of_block(t, shards, size), SENT)
    answers = sent.groupBy("shard").applyInArrow(lambda t: repeats_of_shard(t, size), TOLD)
    return (
        asking.unionByName(told(answers, 2)).groupBy("block").applyInArrow(lambda t: cut_block(t, size), CUT)
    )


def repeats_digest(documents: DataFrame, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return remove_repeats(documents, **options).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


SQL = """
WITH docs AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS body FROM documents
), pieces AS (
    SELECT doc_id, o, body[2 * o + 1:2 * o + 2 * (256 + 49)] AS piece
    FROM (SELECT doc_id, body, unnest(range(0, length(body) // 2, 256)) AS o FROM docs)
), windows AS (
    SELECT doc_id, o + p AS p, piece[2 * p + 1:2 * p + 100] AS s
    FROM (SELECT doc_id, o, piece, unnest(range(0, least(256, length(piece) // 2 - 49))) AS p FROM pieces) AS t
), shared AS (
    SELECT s, min(doc_id) AS doc FROM windows GROUP BY s HAVING min(doc_id) <> max(doc_id)
), hits AS (
    SELECT w.doc_id, w.p FROM windows AS w JOIN shared AS l ON w.s = l.s AND l.doc < w.doc_id
), marked AS (
    SELECT doc_id, p, coalesce(p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50, true) AS new
    FROM hits
), numbered AS (
    SELECT doc_id, p, sum(CAST(new AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM marked
), spans AS (
    SELECT doc_id, min(p) AS b, max(p) + 50 AS e FROM numbered GROUP BY doc_id, span
), rest AS (
    SELECT doc_id, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY b) AS x, b AS y FROM spans
    UNION ALL
    SELECT d.doc_id, coalesce(max(s.e), 0), any_value(length(d.body) // 2)
    FROM docs AS d LEFT JOIN spans AS s USING (doc_id) GROUP BY d.doc_id
), kept AS (
    SELECT r.doc_id, string_agg(d.body[2 * r.x + 1:2 * r.y], '' ORDER BY r.x) AS body
    FROM rest AS r JOIN docs AS d USING (doc_id) GROUP BY r.doc_id
)
SELECT d.doc_id, length(d.body) // 2 AS n_bytes,
       CAST(coalesce((SELECT sum(e - b) FROM spans AS s WHERE s.doc_id = d.doc_id), 0) AS BIGINT) AS n_removed,
       (SELECT count(*) FROM spans AS s WHERE s.doc_id = d.doc_id) AS n_spans,
       sha256(unhex(k.body)) AS kept_sha256
FROM docs AS d JOIN kept AS k USING (doc_id)
"""
