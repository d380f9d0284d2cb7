"""Queries that run a stream over files made from the tables and return its table."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from murmur.plans.registry import query
from murmur.session import scratch_path, use_utc
from murmur.sources import adapters
from murmur.streaming import ingest


def _drain(stream) -> None:
    stream.awaitTermination()


def _paths(spark, name, *parts):
    root = scratch_path(spark, name)
    return [f"{root}/{part}" for part in parts]


@query(r"""
with p as (select *, regexp_extract(url, '^https?://([^/]+)/', 1) board,
                  1704067200 + page_id * 60 created_at from pages)
select board, page_id thread_number, page_id * 2 post_number, created_at, length(html) chars from p
union all
select board, page_id, page_id * 2 + 1, created_at, 0 from p
""")
def stream_ingest_posts(spark, folder):
    """Every thread file arrives twice."""
    threads, out, checkpoint = _paths(spark, "ingest", "threads", "posts", "checkpoint")
    payloads = adapters.thread_payloads(spark, folder)
    payloads.write.json(threads)
    payloads.write.mode("append").json(threads)
    _drain(ingest.stream_ingest_posts(spark, threads, out, checkpoint))
    return spark.read.parquet(out).select(
        "board",
        "thread_number",
        "post_number",
        "created_at",
        F.length("com").cast("bigint").alias("chars"),
    )


@query("""
select conv_id || '-' || turn id, cast(conv_id as varchar) post_id,
       cast(conv_id as varchar) parent_id, text body
from conversations
""")
def stream_upsert(spark, folder):
    """Every listing arrives twice; a comment is stored once."""
    listings, out, checkpoint = _paths(spark, "upsert", "listings", "comments", "checkpoint")
    payloads = adapters.listing_payloads(spark, folder)
    payloads.write.json(listings)
    payloads.withColumn("fetched_at", F.col("fetched_at") + 100).write.mode("append").json(listings)
    _drain(ingest.stream_upsert(spark, listings, out, checkpoint))
    return ingest.read_comments(spark, out).select(
        "id", "post_id", "parent_id", F.get_json_object("data", "$.body").alias("body")
    )


@query("""
with seen as (
  select distinct board, cast(make_timestamp(created * 1000000) as date) d, t thread_number
  from (select board, created, thread_number t from chan_posts
        union all select board, created, post_number from chan_posts)),
times as (select board, d, lead(d) over (partition by board order by d) next_d
          from (select distinct board, d from seen))
select s.board, cast(epoch(next_d) as bigint) snapshot_at, s.thread_number
from seen s join times t on t.board = s.board and t.d = s.d
where next_d is not null
  and not exists (select 1 from seen n where n.board = s.board and n.d = next_d
                  and n.thread_number = s.thread_number)
""")
def stream_dead_threads(spark, folder):
    """One snapshot per board and day."""
    catalogs, out, state, checkpoint = _paths(
        spark, "dead", "catalogs", "dead", "state", "checkpoint"
    )
    day = F.unix_timestamp(F.to_date(F.timestamp_seconds("snapshot_at")).cast("timestamp"))
    adapters.catalog_payloads(spark, folder).withColumn("snapshot_at", day).write.json(catalogs)
    _drain(ingest.stream_dead_threads(spark, catalogs, out, state, checkpoint))
    return ingest.read_dead_threads(spark, out, state)


@query("""
select board, date_trunc('hour', make_timestamp(created * 1000000)) "hour", count(*) post_count
from chan_posts group by 1, 2
""")
def stream_hourly_counts(spark, folder):
    out, checkpoint = _paths(spark, "hourly", "counts", "checkpoint")
    use_utc(spark)
    events = (
        spark.readStream.schema("event_id bigint, ts timestamp_ntz, event_type string")
        .option("pathGlobFilter", "events.parquet")
        .parquet(folder)
        .select("ts", F.col("event_type").alias("board"))
    )
    _drain(ingest.stream_hourly_counts(events, out, checkpoint))
    return ingest.read_hourly_counts(spark, out)


@query("""
with r as (
  select conv_id, turn, row_number() over (partition by conv_id order by turn desc) - 1 r
  from conversations)
select cast(conv_id as varchar) post_id, conv_id || '-' || turn id,
       cast(case when r = 0 then 0 else r - 1 end as bigint) pos
from r
""")
def stream_new_comments(spark, folder):
    """Each conversation is crawled before and after its last turn, newest turn first."""
    listings, out, state, checkpoint = _paths(spark, "new", "listings", "new", "state", "checkpoint")
    conv = F.col("conv_id").cast("string")
    turns = adapters.table(spark, folder, "conversations").select(
        conv.alias("post_id"),
        "turn",
        F.concat_ws("-", conv, F.col("turn").cast("string")).alias("id"),
        (F.col("turn") == F.max("turn").over(Window.partitionBy("conv_id"))).alias("last"),
    )

    def crawl(rows, at):
        newest_first = F.sort_array(F.collect_list(F.struct("turn", "id")), asc=False)
        children = F.transform(
            newest_first,
            lambda c: F.struct(F.lit("t1").alias("kind"), F.struct(c["id"].alias("id")).alias("data")),
        )
        listing = F.struct(F.struct(children.alias("children")).alias("data"))
        return rows.groupBy("post_id").agg(F.to_json(listing).alias("payload")).select(
            F.lit("s").alias("subreddit"), "post_id", F.lit(at).cast("bigint").alias("fetched_at"), "payload"
        )

    for at, rows in enumerate((turns.where("not last"), turns)):
        crawl(rows, at).write.mode("append").json(listings)
        _drain(ingest.stream_new_comments(spark, listings, out, state, checkpoint))
    return ingest.read_batches(spark, out, ingest.NEW_ROWS).select("post_id", "id", "pos")
