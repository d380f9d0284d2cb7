"""Exact Jaccard join of word shingle sets: size-banded tiles, bitmaps, then sorted arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from murmur.llm.common import lean, partitions, ship, stored
from murmur.llm.components import components
from murmur.llm.words import mixed, shingle_sets

ship(__name__)

# Two sets link when PART_OF * intersection >= PART * union, here 0.8.
PART, PART_OF = 4, 5
# Sizes of a band go up to this many times its smallest; a set near the upper end also
# visits the next band, so that sets that can link always meet in one.
BAND = 4.0
# The most frequent shingles, at most this many, come last in every set's order. The list
# only steers which shingles make tiles; the result is the same with any list.
FREQUENT = 1 << 16
# Sets that one task compares with one another, of BLOCK_SHINGLES each on average; more, or
# larger ones, are cut into pairs of blocks.
BLOCK, BLOCK_SHINGLES = 4096, 1024
# Rounds in which classes of large groups are tested against HEADS classes of the largest
# component there. They end before when a round links less than one in FEW of its pairs.
ROUNDS, HEADS, FEW = 3, 4, 50
# Up to so many sets in a group, pairs are taken by size alone, so a set makes fewer of them
# than that; larger groups are compared where they are, and only what they link leaves them.
SMALL = 16
# Bits of a bitmap for each shingle, of those that travel and of those made in the task.
COARSE, FINE = 2, 16
# Pairs that a task hands on at once.
PAIRS = 1 << 16


def frequent_shingles(documents: DataFrame, most: int = FREQUENT) -> np.ndarray:
    """Hashes of shingles that many documents have, ascending by frequency; at most `most`.

    Every document is counted. A task hands on the shingles that two and at least one in a
    thousand of its documents have: what is frequent in the whole is frequent in some task.
    """

    def run(batches):
        for batch in batches:
            sets = list(shingle_sets(batch.column("text")))
            every = np.concatenate([*sets, np.zeros(0, np.uint64)])
            values, counts = np.unique(every, return_counts=True)
            many = counts >= max(2, len(sets) // 1000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values[many].view(np.int64)), pa.array(counts[many])], ["shingle", "n"]
            )

    rows = (
        documents.select("text")
        .mapInArrow(lean(run), "shingle long, n long")
        .groupBy("shingle")
        .agg(F.sum("n").alias("n"))
        .where("n >= 8")
        .orderBy(F.desc("n"), "shingle")
        .limit(most)
        .toPandas()
    )
    rows = rows.sort_values(["n", "shingle"])
    return rows["shingle"].to_numpy(np.int64).view(np.uint64)


def class_of(shingles: np.ndarray) -> int:
    """One 64-bit id for all equal sets."""
    return int(mixed(mixed(shingles).sum(dtype=np.uint64) + np.uint64(len(shingles))).view(np.int64))


def prefix_of(shingles: np.ndarray, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first shingles in the common order, as many that two linked sets must share one.

    A set of n that links to another has ceil(0.8 n) shingles in common with it, so it
    cannot miss all of its first n - ceil(0.8 n) + 1. `frequent` is sorted by value and
    `rank` gives the place in the order; other shingles come first, by value.
    """
    n = len(shingles)
    size = n + (-PART * n // PART_OF) + 1
    if not len(frequent):
        return shingles[:size]
    at = np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)
    late = frequent[at] == shingles
    plain = shingles[~late]
    if len(plain) >= size:
        return plain[:size]
    rest = shingles[late][np.argsort(rank[at[late]], kind="stable")]
    return np.concatenate([plain, rest[: size - len(plain)]])


def bands_of(n: int) -> list[int]:
    """The band of a set of n shingles, and the next if a larger set there can link to it."""
    band = int(np.log(n) / np.log(BAND) + 1e-9)
    above = int(np.log(n * PART_OF / PART) / np.log(BAND) + 1e-9)
    return [band] if above == band else [band, band + 1]


def bitmap_of(shingles: np.ndarray, each: int = COARSE) -> bytes:
    """Bit h mod m for each shingle, with m the power of two from `each` n on (64 at least)."""
    bits = max(64, 1 << int(each * len(shingles) - 1).bit_length())
    out = np.zeros(bits, np.uint8)
    out[(shingles & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(out, bitorder="little").tobytes()


def folded(bitmap: np.ndarray, size: int) -> np.ndarray:
    """The same set's bitmap of `size` bytes."""
    while len(bitmap) > size:
        half = len(bitmap) // 2
        bitmap = bitmap[:half] | bitmap[half:]
    return bitmap


def enough(common, a, b):
    """Whether `common` shingles of sets of a and b are a link: PART_OF I >= PART (a + b - I)."""
    return (PART + PART_OF) * common >= PART * (a + b)


def overlap_bound(x: bytes, y: bytes, a: int, b: int) -> int:
    """Most shingles two sets can share: each bit that differs is one that only one has."""
    size = min(len(x), len(y))
    left, right = (folded(np.frombuffer(v, np.uint8), size) for v in (x, y))
    return (a + b - int(np.bitwise_count(left ^ right).sum())) // 2


def _classes(batches):
    """(doc_id, number of shingles, class) of each text; its bitmap where the task first meets the class."""
    seen: set[int] = set()
    for batch in batches:
        n, node, bitmaps = [], [], []
        for shingles in shingle_sets(batch.column("text")):
            here = class_of(shingles) if len(shingles) else None
            fresh = here is not None and here not in seen
            n.append(len(shingles))
            node.append(here)
            bitmaps.append(bitmap_of(shingles) if fresh else None)
            if fresh:
                seen.add(here)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(bitmaps, pa.binary())],
            ["doc_id", "n", "node", "bitmap"],
        )


def _tiles(frequent: np.ndarray):
    """(tile, node) for each shingle of the prefix and band of the size."""
    by_value = np.sort(frequent)
    rank = np.argsort(frequent)  # place in the order of each, by value

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            tiles, nodes = [], []
            for shingles in shingle_sets(batch.column("text")):
                node = class_of(shingles) if len(shingles) else None
                # A set that this task has seen before makes no tiles anew.
                if node is None or node in seen:
                    continue
                seen.add(node)
                prefix = prefix_of(shingles, by_value, rank)
                for band in bands_of(len(shingles)):
                    tiles.append(mixed(prefix + np.uint64(band)))
                    nodes.append(np.full(len(prefix), node, np.int64))
            if tiles:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tiles).view(np.int64)), pa.array(np.concatenate(nodes))],
                    ["tile", "node"],
                )

    return run


def _shared(batches):
    """Of rows sorted by tile and node, those of tiles with two nodes or more, with the first.

    Only one row is held back between batches, so a tile of any size streams through.
    """
    held: tuple | None = None  # a row alone in its tile so far
    last = (None, None)
    lead = (None, None)  # tile and its first node
    for batch in batches:
        tile, node = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("tile", "node"))
        if not len(tile):
            continue
        again = np.zeros(len(tile), bool)
        again[1:] = (tile[1:] == tile[:-1]) & (node[1:] == node[:-1])
        again[0] = (tile[0], node[0]) == last
        last = (tile[-1], node[-1])
        tile, node = tile[~again], node[~again]
        if held is not None:
            tile, node = (np.concatenate([[h], x]) for h, x in zip(held, (tile, node)))
            held = None
        if not len(tile):
            continue
        new = np.ones(len(tile), bool)
        new[1:] = tile[1:] != tile[:-1]
        begin = np.flatnonzero(new)
        count = np.diff(np.append(begin, len(tile)))
        leader = node[np.repeat(begin, count)]
        keep = np.repeat(count > 1, count)
        if tile[0] == lead[0]:
            leader[: count[0]] = lead[1]
            keep[: count[0]] = True
        if count[-1] == 1 and not keep[-1]:
            held = (tile[-1], node[-1])
            lead = (None, None)
        else:
            lead = (tile[-1], leader[-1])
        if keep.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[keep]) for x in (tile, node, leader)], ["tile", "node", "leader"]
            )


SHARED = "tile long, node long, leader long"


def _arrays(batches):
    for batch in batches:
        nodes, arrays = [], []
        for want, shingles in zip(batch.column("node").to_pylist(), shingle_sets(batch.column("text"))):
            if len(shingles) and class_of(shingles) == want:
                nodes.append(want)
                arrays.append(shingles.tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array(arrays, pa.binary())], ["node", "shingles"]
        )


def _possible(batches):
    """Pairs whose bitmaps leave room for a link."""
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("bitmap_a", "bitmap_b", "n_a", "n_b")))
        keep = pa.array([bool(enough(overlap_bound(x, y, a, b), a, b)) for x, y, a, b in rows], pa.bool_())
        yield batch.select(["a", "b"]).filter(keep)


def are_linked(left: np.ndarray, right: np.ndarray) -> bool:
    """Whether two sorted sets have enough in common."""
    if len(left) > len(right):
        left, right = right, left
    at = np.searchsorted(right, left)
    common = int((right[np.minimum(at, len(right) - 1)] == left).sum())
    return bool(enough(common, len(left), len(right)))


def _linked(batches):
    """Pairs whose sorted arrays have enough in common."""
    for batch in batches:
        sets = ([np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column(c)] for c in ("shingles_a", "shingles_b"))
        keep = [are_linked(x, y) for x, y in zip(*sets)]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _side(sets: DataFrame, side: str, *columns: str) -> DataFrame:
    return sets.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns])


# Ids of texts that are sent to all executors at once (16 bytes each); more are joined.
IDS_SENT = 500_000


def arrays_of(nodes: DataFrame, texts: DataFrame, names: DataFrame, name: str) -> DataFrame:
    """node, shingles of each of the classes `nodes` (repeated or not).

    `names` has one doc_id for each class. Up to IDS_SENT of them go to the texts, which then
    stay where they are; beyond that, the texts are shuffled to meet them.
    """
    wanted = stored(nodes.distinct().join(names, "node"), f"{name}-wanted")
    few = wanted.count() <= IDS_SENT
    return stored(
        texts.join(F.broadcast(wanted) if few else wanted, "doc_id")
        .select("node", "text")
        .mapInArrow(_arrays, "node long, shingles binary"),
        f"{name}-arrays",
    )


def verified(pairs: DataFrame, maps: DataFrame, texts: DataFrame, names: DataFrame, name: str) -> DataFrame:
    """The pairs (a, b) that are links: bitmaps first, then the exact intersection.

    Only the texts of classes that the bitmaps leave in are read into arrays.
    """
    possible = stored(
        pairs.join(_side(maps, "a", "n", "bitmap"), "a")
        .join(_side(maps, "b", "n", "bitmap"), "b")
        .mapInArrow(_possible, "a long, b long"),
        f"{name}-possible",
    )
    nodes = possible.select(F.col("a").alias("node")).unionAll(possible.select(F.col("b").alias("node")))
    arrays = arrays_of(nodes, texts, names, name)
    return (
        possible.join(_side(arrays, "a", "shingles"), "a")
        .join(_side(arrays, "b", "shingles"), "b")
        .mapInArrow(_linked, "a long, b long")
    )


def _ordered(a: str, b: str):
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def _pair_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"]
    )


def _near_sizes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return PART_OF * np.minimum(a, b) >= PART * np.maximum(a, b)


def _by_block(batches):
    """The rows of each (leader, i, j), by which they come sorted, as one table by size."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in ("leader", "i", "j")], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            here = tuple(keys[lo])
            if held and here != last:
                yield pa.Table.from_batches(held).sort_by("n")
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = here
    if held:
        yield pa.Table.from_batches(held).sort_by("n")


def _candidates(rows: pa.Table, bitmaps: list[bytes], component: np.ndarray):
    """(row, later rows) of a block that sizes, tiles and bitmaps leave as possible links.

    Rows come by size. `component` is read anew for each row, so that the caller can join.
    """
    n, block, tiles = (rows.column(c).to_numpy() for c in ("n", "block", "tiles"))
    within = rows.column("i")[0] == rows.column("j")[0]
    sizes = np.array([len(b) for b in bitmaps])
    ends = np.searchsorted(n, n * PART_OF // PART, side="right")
    size, first, maps = 0, 0, None
    for at in range(len(n)):
        if sizes[at] != size:
            # A set that can link to one of these has a bitmap of this size or twice it.
            size, first = sizes[at], at
            last = np.searchsorted(sizes, 2 * size, side="right")
            maps = np.stack([folded(np.frombuffer(b, np.uint8), size) for b in bitmaps[at:last]]).view(np.uint64)
        to = np.arange(at + 1, ends[at])
        to = to[(component[to] != component[at]) & (tiles[to] & tiles[at] != 0)]
        if not within:
            to = to[block[to] != block[at]]
        if len(to):
            differ = np.bitwise_count(maps[to - first] ^ maps[at - first]).sum(axis=1, dtype=np.int64)
            to = to[enough((n[to] + n[at] - differ) // 2, n[to], n[at])]
        if len(to):
            yield at, to


BLOCKS = "leader long, i int, j int, block int, node long, component long, tiles long, n long"


def _near(batches):
    """Of rows sorted by (leader, i, j): those that may link to another of theirs, of another
    component. At most one row for each, however many pairs there are."""
    columns = [c.split()[0] for c in BLOCKS.split(", ")]
    for rows in _by_block(batches):
        near = np.zeros(len(rows), bool)
        for at, to in _candidates(rows, rows.column("bitmap").to_pylist(), rows.column("component").to_numpy()):
            near[at] = True
            near[to] = True
        if near.any():
            yield from rows.select(columns).filter(pa.array(near)).combine_chunks().to_batches()


def _joined(batches):
    """Of rows sorted by (leader, i, j): links (a, b) that join their components. What earlier
    links have joined is not looked at again, so there are fewer links than rows."""
    for rows in _by_block(batches):
        sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in rows.column("shingles")]
        component, node = (rows.column(c).to_numpy().copy() for c in ("component", "node"))
        found = []
        for at, to in _candidates(rows, [bitmap_of(s, FINE) for s in sets], component):
            for x in to.tolist():
                if component[x] != component[at] and are_linked(sets[at], sets[x]):
                    component[component == component[x]] = component[at]
                    found.append((at, x))
        if found:
            yield _pair_batch(*node[np.array(found).T])


def _compare_small(batches):
    """Of rows sorted by (leader, tile), with at most SMALL rows a tile: pairs in different
    components that sizes allow, each once for all tiles with the same leader. The rows of one
    leader are held at a time."""
    columns = ("leader", "tile", "node", "component", "n")

    def pairs(leader, tile, node, component, n):
        found = []
        for step in range(1, min(SMALL, len(tile))):
            at = np.flatnonzero(tile[step:] == tile[:-step])
            at = at[(component[at] != component[at + step]) & _near_sizes(n[at], n[at + step])]
            found.append(np.stack([node[at], node[at + step]], axis=1))
        if found:
            every = np.sort(np.concatenate(found), axis=1)
            every = every[np.lexsort((every[:, 1], every[:, 0]))]
            new = np.ones(len(every), bool)
            new[1:] = (every[1:] != every[:-1]).any(axis=1)
            every = every[new]
            for at in range(0, len(every), PAIRS):
                yield _pair_batch(every[at : at + PAIRS, 0], every[at : at + PAIRS, 1])

    held = [np.zeros(0, np.int64)] * len(columns)
    for batch in batches:
        held = [np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, columns)]
        if len(held[0]):
            last = int(np.searchsorted(held[0], held[0][-1]))
            yield from pairs(*(h[:last] for h in held))
            held = [h[last:] for h in held]
    yield from pairs(*held)


def link_documents(documents: DataFrame, block: int = BLOCK, name: str = "jaccard") -> DataFrame:
    """doc_id, n_shingles, component_id (class_id, component) of every row of `documents`.

    1. Each whole text becomes its sorted set of distinct shingle hashes. Equal sets are one
       class, named by a 64-bit hash; what follows works on classes, so copies cost one row.
    2. The first shingles of a set in a common order, rarest first, and the band of its size
       make its tiles: linked sets share one. Tiles with a single class are dropped in the
       stream of sorted rows. Those with the same first class are one group, since near copies
       share many tiles: a class is one row there, with a bit for each of its tiles.
    3. Each class is tested against the class that comes first in most of its tiles; those in
       groups of more than SMALL classes then against some of the largest component there, in
       a few rounds. A round is linear in the classes, and joins large groups of near copies
       into components.
    4. Groups that still hold several components are compared, across components only; nothing
       linked is missed, and nothing already joined is compared again. Small groups hand on
       their pairs, fewer than SMALL a class. Large ones are compared in blocks, in the task:
       by bitmaps, which leaves the classes that may link to another, and again by the arrays
       of these. Only links that join something leave it, fewer than it has classes.
    Bitmaps bound each overlap from above before the sorted arrays are intersected.

    A row without words or text, or without doc_id, is linked with nothing; it has its own
    doc_id as component_id (null if it has none). Repeated rows get equal results.
    """
    spark = documents.sparkSession
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    frequent = frequent_shingles(texts)
    sets = stored(
        texts.mapInArrow(lean(_classes), "doc_id long, n long, node long, bitmap binary"), f"{name}-classes"
    )
    rows = sets.select("doc_id", "n", "node")
    place = F.pmod(F.xxhash64("tile"), F.lit(64)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
    groups = stored(
        texts.where("doc_id is not null")
        .select("text")
        .mapInArrow(lean(_tiles(frequent)), "tile long, node long")
        .repartition(partitions(spark), "tile")
        .sortWithinPartitions("tile", "node")
        .mapInArrow(_shared, SHARED)
        .groupBy("leader", "node")
        .agg(F.count(F.lit(1)).alias("seen"), F.bit_or(bit).alias("tiles")),
        f"{name}-groups",
    )
    named = rows.where("node is not null and doc_id is not null")
    names = named.groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    maps = stored(
        sets.where("bitmap is not null")
        .join(groups.select("node").distinct(), "node", "left_semi")
        .groupBy("node")
        .agg(F.first("n").alias("n"), F.first("bitmap").alias("bitmap")),
        f"{name}-maps",
    )
    # The first class of most of a class's tiles: one test for each class.
    first = (
        groups.where("node != leader")
        .groupBy("node")
        .agg(F.max_by("leader", F.struct("seen", "leader")).alias("leader"))
        .select(*_ordered("node", "leader"))
        .distinct()
    )
    links = stored(verified(first, maps, texts, names, f"{name}-first"), f"{name}-links")
    labels = components(links, f"{name}-components")

    def with_components(rows: DataFrame, now: DataFrame) -> DataFrame:
        joined = rows.join(now, "node", "left")
        return joined.withColumn("component", F.coalesce("component", "node"))

    # Classes apart from the largest component of a group meet some of its classes.
    many = groups.groupBy("leader").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > SMALL)
    big = stored(groups.join(many.select("leader"), "leader", "left_semi"), f"{name}-big")
    for at in range(1, ROUNDS):
        owned = with_components(big, labels)
        drawn = [F.min(F.struct(F.xxhash64("node", F.lit(at * HEADS + h)), "node", "tiles")) for h in range(HEADS)]
        heads = (
            owned.groupBy("leader", "component")
            .agg(
                F.count(F.lit(1)).alias("rows"),
                F.array_distinct(F.array(*[F.struct(d["node"].alias("node"), d["tiles"].alias("tiles")) for d in drawn])).alias("heads"),
            )
            .groupBy("leader")
            .agg(F.max(F.struct("rows", "component", "heads")).alias("most"))
            .select("leader", F.col("most.component").alias("largest"), "most.heads")
        )
        met = (
            owned.join(heads, "leader")
            .where("component != largest")
            .withColumn("heads", F.filter("heads", lambda head: head["tiles"].bitwiseAND(F.col("tiles")) != 0))
            .where(F.size("heads") > 0)
            .groupBy("node")
            .agg(F.max_by("heads", F.struct("seen", "leader")).alias("heads"))
            .select("node", F.explode("heads.node").alias("head"))
        )
        apart = stored(met.select(*_ordered("node", "head")).distinct(), f"{name}-apart-{at}")
        tested = apart.count()
        if not tested:
            break
        found = stored(verified(apart, maps, texts, names, f"{name}-round-{at}"), f"{name}-links-{at}")
        linked = found.count()
        if linked:
            links = links.unionAll(found)
            labels = components(links, f"{name}-components-{at}")
        if linked * FEW < tested:
            break
    # What is left: groups whose classes are in more than one component.
    small = (
        with_components(groups.join(many.select("leader"), "leader", "left_anti"), labels)
        .join(maps.select("node", "n"), "node")
        .select("leader", F.col("leader").alias("tile"), "node", "component", "n")
        .repartition(partitions(spark), "leader")
        .sortWithinPartitions("leader", "node")
        .mapInArrow(_compare_small, "a long, b long")
        .distinct()
    )
    of_leader = with_components(big, labels).join(maps.select("node", "n"), "node")
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum("n") / (block * BLOCK_SHINGLES)))
    cuts = (
        of_leader.groupBy("leader")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"), blocks.cast("int").alias("blocks"))
        .where("lo != hi")
        .select("leader", "blocks")
    )

    def by_block(rows: DataFrame) -> DataFrame:
        return rows.repartition(partitions(spark), "leader", "i", "j").sortWithinPartitions("leader", "i", "j")

    columns = [c.split()[0] for c in BLOCKS.split(", ")]
    near = stored(
        by_block(
            of_leader.join(cuts, "leader")
            .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("i", F.least("block", "other"))
            .withColumn("j", F.greatest("block", "other"))
            .select(*columns)
            .join(maps.select("node", "bitmap"), "node")
        ).mapInArrow(_near, BLOCKS),
        f"{name}-near",
    )
    arrays = arrays_of(near.select("node"), texts, names, f"{name}-large")
    large = by_block(near.join(arrays, "node")).mapInArrow(_joined, "a long, b long")
    more = stored(
        verified(small, maps, texts, names, f"{name}-second").unionAll(large), f"{name}-more-links"
    )
    if not more.isEmpty():
        labels = components(links.unionAll(more), f"{name}-all-components")
    whole = (
        rows.join(labels, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .withColumnRenamed("n", "n_shingles")
    )
    smallest = named.join(labels, "node", "left").groupBy(F.coalesce("component", "node").alias("component")).agg(
        F.min("doc_id").alias("component_id")
    )
    return whole.join(smallest, "component", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        F.col("node").alias("class_id"),
        "component",
    )


def representatives(documents: DataFrame, **options) -> DataFrame:
    """The documents with one row of each group left: that of the smallest doc_id, and of two
    texts of one doc_id that of the smaller class. Same columns.

    A group is a component, so unlike texts of one doc_id both stay. Rows without words, or
    without doc_id, are linked with nothing and stay, repeated ones too.
    """
    linked = stored(
        link_documents(documents, **options).where("doc_id is not null").select("doc_id", "class_id", "component"),
        "jaccard-linked",
    )
    chosen = (
        linked.where("class_id is not null")
        .groupBy("component")
        .agg(F.min(F.struct("doc_id", "class_id")).alias("w"))
        .select("w.*")
    )
    alone = linked.where("class_id is null").select("doc_id")
    repeated = linked.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    ids = chosen.select("doc_id").unionAll(alone).distinct().join(repeated, "doc_id", "left_anti")
    rows = documents.select(F.struct(*documents.columns).alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"))
    kept = rows.join(ids, "doc_id").select("row.*")
    none = rows.where("doc_id is null").select("row.*")
    if repeated.isEmpty():
        return kept.unionAll(none)
    # A doc_id that stands in several rows: their classes tell which of them stay.
    several = (
        rows.join(repeated, "doc_id")
        .select("row", "doc_id", F.col("row.text").alias("text"))
        .mapInArrow(_with_class, StructType([*rows.schema.fields, StructField("class_id", LongType())]))
    )
    first = Window.partitionBy("doc_id", "class_id").orderBy(F.xxhash64("row"))
    one = (
        several.join(chosen, ["doc_id", "class_id"], "left_semi")
        .withColumn("_no", F.row_number().over(first))
        .where("_no = 1")
        .select("row.*")
    )
    return kept.unionAll(one).unionAll(several.where("class_id is null").select("row.*")).unionAll(none)


def _with_class(batches):
    """The class of each row's text in place of the text."""
    for batch in batches:
        found = [class_of(s) if len(s) else None for s in shingle_sets(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("doc_id"), pa.array(found, pa.int64())], ["row", "doc_id", "class_id"]
        )
