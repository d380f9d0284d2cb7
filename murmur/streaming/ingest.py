"""Structured Streaming forms: payload files in, tables out.

Files dropped into a folder take the place of polling. Every query runs with an
``availableNow`` trigger by default, so it drains what is there and stops; pass
another trigger for a query that stays up. Batches are stored under the id of
their stream (kept in its checkpoint) and their own, and replace themselves when
run again: restarts do not repeat rows, and another stream or a new checkpoint
adds to what is stored. Payloads that cannot be read are stored beside the
table, under its path with ``_unreadable`` at the end.
"""

from __future__ import annotations

import json

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from murmur.functions.text import clean_html_text
from murmur.operators.nested import flatten_comment_tree, new_comments_since, next_markers
from murmur.schemas import CATALOG_FILE, LISTING_FILE, POST_FIELDS, THREAD_FILE
from murmur.session import use_utc
from murmur.sources import keyed
from murmur.sources.keyed import Keyed
from murmur.sources.payloads import explode_catalog_threads, explode_listing, explode_thread_posts
from murmur.sources.sinks import (
    append_new_posts,
    first_and_latest_rows,
    latest_rows,
    read_batch,
    read_batches,
    upsert_latest,
    upsert_partial,
    write_batch,
)
from murmur.sources.tables import expose_json_fields

THREAD_KEYS = ["board", "thread_number", "post_number"]
DRAIN = {"availableNow": True}
FILE_AGE = "36500d"


def _files(
    spark: SparkSession, path: str, schema: str, fmt: str = "json", per_batch: int | None = None
) -> DataFrame:
    # Spark leaves out files that are much older than the newest; copies and backfills are.
    reader = use_utc(spark).readStream.format(fmt).schema(schema).option("maxFileAge", FILE_AGE)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.load(path)


def _each_batch(frame: DataFrame, checkpoint: str, work, trigger: dict, mode: str = "append"):
    """Runs `work(batch, stream, batch_id)` on each micro-batch, which is read once however
    often it is used."""
    known: list[str] = []

    def held(batch: DataFrame, batch_id: int) -> None:
        if not known:
            known.append(stream_id(batch.sparkSession, checkpoint))
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            work(batch, known[0], batch_id)
        finally:
            batch.unpersist()

    return (
        frame.writeStream.outputMode(mode)
        .foreachBatch(held)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave to the stream of this checkpoint; it lasts over restarts."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def _keep_unreadable(
    rows: DataFrame, unreadable: Column, out_path: str, stream: str, batch_id: int
) -> DataFrame:
    """Stores the rows that cannot be read beside the table and returns the others."""
    flag = F.coalesce(unreadable, F.lit(False))
    write_batch(rows.where(flag), f"{out_path}_unreadable", stream, batch_id)
    return rows.where(~flag)


# --- posts from threads ------------------------------------------------------------------


THREAD_KEY_ROWS = "board string, thread_number bigint, post_number bigint"


def post_keys(out_path: str) -> Keyed:
    """The keys of the stored posts. A thread's keys are in one bucket."""
    return Keyed(out_path, THREAD_KEY_ROWS, ("board", "thread_number"), lambda keys: keys.distinct())


def stream_ingest_posts(
    spark: SparkSession,
    threads_path: str,
    out_path: str,
    checkpoint: str,
    per_batch: int | None = None,
    trigger: dict = DRAIN,
    compact_every: int = keyed.EVERY,
) -> StreamingQuery:
    """Thread files to cleaned posts, each post once, whenever and in whatever file it comes.

    A batch is held against the keys stored of its threads, so neither the age of a file
    nor that of a post matters, and no post is stored twice. The keys lie in an index of
    buckets, of which a batch reads those of its threads, besides the batches that came
    after the last compaction; so what it reads does not grow with the table.
    """
    table = post_keys(out_path)

    def work(batch: DataFrame, stream: str, batch_id: int) -> None:
        readable = _keep_unreadable(
            batch, F.try_parse_json("payload").isNull(), out_path, stream, batch_id
        )
        posts = explode_thread_posts(readable, ["board", "thread_number", "ingested_at"])
        held = keyed.look_up(batch.sparkSession, table, readable, (stream, batch_id))
        write_batch(append_new_posts(held, posts, THREAD_KEYS, "ingested_at"), out_path, stream, batch_id)
        if keyed.due(batch_id, compact_every):
            keyed.compact(batch.sparkSession, table)

    threads = _files(spark, threads_path, THREAD_FILE, per_batch=per_batch)
    arrived = threads.withColumn("ingested_at", F.col("_metadata.file_modification_time"))
    return _each_batch(arrived, checkpoint, work, trigger)


# --- keyed tables from listings --------------------------------------------------------------

POST_ROWS = "post_id string, subreddit string, data string, fetched_at bigint"
COMMENT_ROWS = (
    "id string, post_id string, parent_id string, data string, cleaned_text string, "
    "fetched_at bigint"
)


def posts_table(out_path: str) -> Keyed:
    """Of every post the version fetched last."""
    return Keyed(
        out_path, POST_ROWS, ("post_id",), lambda rows: latest_rows(rows, ["post_id"], "fetched_at")
    )


def comments_table(out_path: str) -> Keyed:
    """Of every comment what was fetched first and last."""
    return Keyed(
        out_path,
        COMMENT_ROWS,
        ("id",),
        lambda rows: first_and_latest_rows(
            rows, ["id"], ["post_id", "parent_id", "data"], ["cleaned_text"], "fetched_at"
        ),
    )


def stream_upsert_posts(
    spark: SparkSession,
    listings_path: str,
    out_path: str,
    checkpoint: str,
    per_batch: int | None = None,
    trigger: dict = DRAIN,
    compact_every: int = keyed.EVERY,
) -> StreamingQuery:
    """Post listings (children of kind ``t3``) into a keyed post table.

    A batch adds its own rows only, and every `compact_every` batches the older ones are
    folded into the base, touched buckets only. `read_posts` merges the base and the few
    batches since.
    """
    table = posts_table(out_path)

    def work(batch: DataFrame, stream: str, batch_id: int) -> None:
        readable = _keep_unreadable(
            batch, F.try_parse_json("payload").isNull(), out_path, stream, batch_id
        )
        rows = explode_listing(readable, ["subreddit", "fetched_at"], "t3").select(
            F.col("id").alias("post_id"), "subreddit", "data", "fetched_at"
        )
        write_batch(rows, out_path, stream, batch_id)
        if keyed.due(batch_id, compact_every):
            keyed.compact(batch.sparkSession, table)

    listings = _files(spark, listings_path, LISTING_FILE, per_batch=per_batch)
    return _each_batch(listings, checkpoint, work, trigger)


def read_posts(spark: SparkSession, path: str) -> DataFrame:
    """Latest version of every post, with typed columns."""
    stored = keyed.read_rows(spark, posts_table(path))
    latest = upsert_latest(stored.limit(0), stored, ["post_id"], "fetched_at")
    return expose_json_fields(latest, POST_FIELDS)


def stream_upsert(
    spark: SparkSession,
    listings_path: str,
    out_path: str,
    checkpoint: str,
    per_batch: int | None = None,
    trigger: dict = DRAIN,
    compact_every: int = keyed.EVERY,
) -> StreamingQuery:
    """Comment listings (children of kind ``t1``, with nested replies) into a keyed table,
    compacted like that of `stream_upsert_posts`.

    Spark's JSON parser takes about 200 levels of replies; deeper listings are stored whole
    beside the table.
    """
    table = comments_table(out_path)

    def work(batch: DataFrame, stream: str, batch_id: int) -> None:
        readable = _keep_unreadable(
            batch, F.try_parse_json("payload").isNull(), out_path, stream, batch_id
        )
        trees = explode_listing(readable, ["post_id", "fetched_at"], "t1")
        rows = flatten_comment_tree(trees, "data", keep=("fetched_at",))
        cleaned = clean_html_text(F.col("comment_text")).alias("cleaned_text")
        write_batch(
            rows.select("id", "post_id", "parent_id", "data", cleaned, "fetched_at"),
            out_path,
            stream,
            batch_id,
        )
        if keyed.due(batch_id, compact_every):
            keyed.compact(batch.sparkSession, table)

    listings = _files(spark, listings_path, LISTING_FILE, per_batch=per_batch)
    return _each_batch(listings, checkpoint, work, trigger)


def read_comments(spark: SparkSession, path: str) -> DataFrame:
    """Every comment once: latest data, text as first stored."""
    stored = keyed.read_rows(spark, comments_table(path))
    return upsert_partial(
        stored.limit(0),
        stored,
        ["id"],
        ["post_id", "parent_id", "data"],
        ["cleaned_text"],
        "fetched_at",
    )


# --- threads that disappear ---------------------------------------------------------------------


# What a stream says of a snapshot: a row for each thread that it lacks of the one before,
# and one without a thread, so that a snapshot that lacks nothing is said, too.
DEAD_ROWS = "board string, snapshot_at bigint, thread_number bigint, turn bigint"
# Threads of a snapshot, and a row without a thread, as it may be empty.
SNAPSHOT_ROWS = DEAD_ROWS
# Snapshots up to so many seconds behind the newest of their board are still put in order.
LATENESS = 7 * 86400


def dead_between_snapshots(catalogs: DataFrame) -> DataFrame:
    """Threads of each catalog snapshot that the next one of the same board lacks.

    `catalogs` has board, snapshot_at and payload; catalogs of one board and
    time together are one snapshot. `snapshot_at` of the result is the snapshot
    without the thread.
    """
    listed = explode_catalog_threads(catalogs, ["board", "snapshot_at"])
    times = catalogs.select("board", "snapshot_at", F.lit(None).cast("bigint").alias("thread_number"))
    return dead_threads_of(listed.unionByName(times)).where(F.col("thread_number").isNotNull())


def dead_threads_of(snapshots: DataFrame) -> DataFrame:
    """Of board, snapshot_at, thread_number (one row a snapshot without a thread): the threads
    that each snapshot lacks of the one before, and a row without a thread for each snapshot
    that has one before."""
    rows = snapshots.select("board", "snapshot_at", "thread_number").distinct()
    after = F.lead("snapshot_at").over(Window.partitionBy("board").orderBy("snapshot_at"))
    times = rows.select("board", "snapshot_at").distinct()
    pairs = times.withColumn("next_at", after).where(F.col("next_at").isNotNull())
    threads = rows.where(F.col("thread_number").isNotNull())
    before = threads.join(pairs, ["board", "snapshot_at"]).select(
        "board", F.col("next_at").alias("snapshot_at"), "thread_number"
    )
    dead = before.join(threads, ["board", "snapshot_at", "thread_number"], "left_anti")
    said = pairs.select(
        "board", F.col("next_at").alias("snapshot_at"), F.lit(None).cast("bigint").alias("thread_number")
    )
    return dead.unionByName(said)


def _last_turn(rows: DataFrame) -> DataFrame:
    """Of each board and snapshot what was said last."""
    last = rows.groupBy("board", "snapshot_at").agg(F.max("turn").alias("turn"))
    return rows.join(last, ["board", "snapshot_at", "turn"], "left_semi").select(*rows.columns).distinct()


def said_table(out_path: str) -> Keyed:
    """What was said last of each snapshot."""
    return Keyed(out_path, DEAD_ROWS, ("board",), _last_turn)


def _kept_snapshots(rows: DataFrame, lateness: int) -> DataFrame:
    """Snapshots within the lateness of the newest of their board, and the one before these.

    Of a thread listed in several pieces of a snapshot one row is left.
    """
    once = rows.groupBy("board", "snapshot_at", "thread_number").agg(F.max("turn").alias("turn"))
    times = once.groupBy("board", "snapshot_at").agg(F.max("turn").alias("_turn"))
    newest = F.max("snapshot_at").over(Window.partitionBy("board"))
    after = F.lead("snapshot_at").over(Window.partitionBy("board").orderBy("snapshot_at"))
    kept = (
        times.withColumn("_from", newest - lateness)
        .withColumn("_after", after)
        .where((F.col("snapshot_at") >= F.col("_from")) | (F.col("_after") >= F.col("_from")))
        .select("board", "snapshot_at")
    )
    return once.join(kept, ["board", "snapshot_at"], "left_semi").select(*rows.columns)


def snapshots_table(state_path: str, lateness: int = LATENESS) -> Keyed:
    """The snapshots to which a later file may still be a neighbour."""
    return Keyed(state_path, SNAPSHOT_ROWS, ("board",), lambda rows: _kept_snapshots(rows, lateness))


def stream_dead_threads(
    spark: SparkSession,
    catalogs_path: str,
    out_path: str,
    state_path: str,
    checkpoint: str,
    per_batch: int | None = None,
    trigger: dict = DRAIN,
    lateness: int = LATENESS,
    compact_every: int = keyed.EVERY,
) -> StreamingQuery:
    """Catalog files to the threads that disappeared between consecutive snapshots.

    Files may come in any order: a snapshot that arrives between two others corrects what was
    said of the later one, and a further piece of a snapshot corrects what was said of it.
    So `read_dead_threads` gives after any order what `dead_between_snapshots` gives of all
    files. The watermark of a board is `lateness` seconds behind its newest snapshot; files
    older than that when their batch begins are stored beside the table, under its path with
    ``_late`` at the end, and change nothing.

    A batch reads the kept snapshots of its own boards and writes what changed for these.
    A new stream goes on from what an earlier one left.
    """
    state, said = snapshots_table(state_path, lateness), said_table(out_path)

    def work(batch: DataFrame, stream: str, batch_id: int) -> None:
        spark = batch.sparkSession
        # A catalog that cannot be read must not pass for an empty one.
        readable = _keep_unreadable(
            batch, F.try_parse_json("payload").isNull(), out_path, stream, batch_id
        )
        boards = readable.select("board").distinct()
        stored = keyed.look_up(spark, state, boards, (stream, batch_id)).join(boards, "board", "left_semi")
        held = _kept_snapshots(stored, lateness)
        marks = held.groupBy("board").agg(
            (F.max("snapshot_at") - lateness).alias("_mark"), (F.max("turn") + 1).alias("_turn")
        )
        dated = readable.join(marks, "board", "left")
        late = F.col("snapshot_at") < F.coalesce("_mark", "snapshot_at")
        write_batch(dated.where(late).select(*batch.columns), f"{out_path}_late", stream, batch_id)
        timely = dated.where(~late).withColumn("turn", F.coalesce("_turn", F.lit(1).cast("bigint")))
        listed = explode_catalog_threads(timely, ["board", "snapshot_at", "turn"])
        times = timely.select("board", "snapshot_at", "turn", F.lit(None).cast("bigint").alias("thread_number"))
        write_batch(listed.unionByName(times).distinct(), state_path, stream, batch_id)
        fresh = read_batch(spark, state_path, SNAPSHOT_ROWS, stream, batch_id)
        # Of a board all kept snapshots are said anew but for the oldest, whose neighbour is gone.
        turns = fresh.groupBy("board").agg(F.max("turn").alias("turn"))
        now = dead_threads_of(held.unionByName(fresh).join(turns.select("board"), "board", "left_semi"))
        write_batch(now.join(turns, "board").select("board", "snapshot_at", "thread_number", "turn"), out_path, stream, batch_id)
        if keyed.due(batch_id, compact_every):
            keyed.compact(spark, state)
            keyed.compact(spark, said)

    catalogs = _files(spark, catalogs_path, CATALOG_FILE, per_batch=per_batch)
    return _each_batch(catalogs, checkpoint, work, trigger)


def read_dead_threads(spark: SparkSession, out_path: str, state_path: str | None = None) -> DataFrame:
    """board, snapshot_at, thread_number of all dead threads, as far as files have come.

    The newest snapshot of a board counts, whole or not. `state_path` is not needed any more.
    """
    said = _last_turn(keyed.read_rows(spark, said_table(out_path)))
    return said.where(F.col("thread_number").isNotNull()).select("board", "snapshot_at", "thread_number")


# --- comments since the last crawl ------------------------------------------------------------------

MARKER_ROWS = "post_id string, last_comment_id string, move bigint"
NEW_ROWS = "post_id string, id string, pos bigint, data string"


def stream_new_comments(
    spark: SparkSession,
    listings_path: str,
    out_path: str,
    state_path: str,
    checkpoint: str,
    per_batch: int | None = None,
    trigger: dict = DRAIN,
) -> StreamingQuery:
    """Comment listings to the comments ahead of each post's stored marker.

    A batch holds at most one listing per post, newest comment first.
    """

    def work(batch: DataFrame, stream: str, batch_id: int) -> None:
        spark = batch.sparkSession
        held = read_batches(spark, state_path, MARKER_ROWS, (stream, batch_id))
        state = current_markers(held)
        readable = _keep_unreadable(
            batch, F.try_parse_json("payload").isNull(), out_path, stream, batch_id
        )
        listed = explode_listing(readable, ["post_id"]).select(
            "post_id", "id", F.col("pos").cast("bigint").alias("pos"), "data"
        )
        fresh = new_comments_since(listed, state)
        write_batch(fresh, out_path, stream, batch_id)
        stored = read_batch(spark, out_path, NEW_ROWS, stream, batch_id)
        touched = state.join(stored.select("post_id").distinct(), "post_id", "left_semi")
        # A move is one later than the last of its post, whichever stream made that.
        moves = held.groupBy("post_id").agg((F.max("move") + 1).alias("move"))
        moved = next_markers(stored, touched).join(moves, "post_id", "left")
        write_batch(
            moved.withColumn("move", F.coalesce("move", F.lit(0).cast("bigint"))),
            state_path,
            stream,
            batch_id,
        )

    listings = _files(spark, listings_path, LISTING_FILE, per_batch=per_batch)
    return _each_batch(listings, checkpoint, work, trigger)


def current_markers(held: DataFrame) -> DataFrame:
    """Marker of each post after its last move."""
    return held.groupBy("post_id").agg(
        F.max(F.struct("move", "last_comment_id"))["last_comment_id"].alias("last_comment_id")
    )


# --- hourly counts ------------------------------------------------------------------------------------

HOUR_ROWS = "board string, hour timestamp_ntz, post_count bigint"


def stream_hourly_counts(
    posts: DataFrame,
    out_path: str,
    checkpoint: str,
    time_col: str = "ts",
    lateness: str | None = None,
    trigger: dict = DRAIN,
) -> StreamingQuery:
    """Posts per board and hour of a stream of posts with an event time.

    Counts are stored as they change, hours still open included; `read_hourly_counts`
    takes the last value of each. The state is one number per board and hour. With
    `lateness` a watermark lets Spark forget hours older than that, and rows that
    come later still are left out, so set it above the disorder of the source.
    """
    timed = posts.withColumn("_time", F.col(time_col).cast("timestamp"))
    if lateness:
        timed = timed.withWatermark("_time", lateness)
    counts = (
        timed.groupBy(F.window("_time", "1 hour").alias("_w"), "board")
        .agg(F.count(F.lit(1)).alias("post_count"))
        .select("board", F.col("_w.start").cast("timestamp_ntz").alias("hour"), "post_count")
    )

    def work(batch: DataFrame, stream: str, batch_id: int) -> None:
        write_batch(batch, out_path, stream, batch_id)

    return _each_batch(counts, checkpoint, work, trigger, mode="update")


def read_hourly_counts(spark: SparkSession, path: str) -> DataFrame:
    """Last value of each stream, added up over streams: each counts what it has read."""
    stored = read_batches(spark, path, HOUR_ROWS)
    last = stored.groupBy("stream", "board", "hour").agg(
        F.max(F.struct("batch_id", "post_count"))["post_count"].alias("post_count")
    )
    return last.groupBy("board", "hour").agg(F.sum("post_count").alias("post_count"))
