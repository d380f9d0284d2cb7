"""Queries for sources, sinks and nested payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmur.operators import nested
from murmur.operators.engagement import daily_counts
from murmur.plans.registry import query
from murmur.schemas import POST_FIELDS
from murmur.session import scratch_path
from murmur.sources import adapters, payloads, sinks, tables


@query("""
select post_id, author, votes, case when status = 'F' then votes end ups, created from posts
""")
def load_posts_table(spark, folder):
    path = scratch_path(spark, "posts")
    adapters.posts_json(spark, folder).write.parquet(path)
    loaded = tables.load_posts_table(spark, path, POST_FIELDS)
    return loaded.select("post_id", "author", "votes", "ups", "created")


@query("""
select post_id, subreddit, author, votes, created from posts
where created between 820454400 and 852076799 and subreddit in ('1-URGENT', '5-LOW')
""")
def load_posts_layout(spark, folder):
    """The JSON typed once and stored by month; a year of two communities reads its part."""
    path = scratch_path(spark, "posts-layout")
    tables.write_posts_layout(adapters.posts_json(spark, folder), path, POST_FIELDS, per="month")
    loaded = tables.load_posts_layout(
        spark, path, start=820454400, end=852076799, communities=["1-URGENT", "5-LOW"], per="month"
    )
    return loaded.select("post_id", "subreddit", "author", "votes", "created")


@query("""
select cast(doc_id as varchar) post_id, lang subreddit, text cleaned_text,
       '{"id":' || doc_id || ',"tags":["a","b"]}' "data"
from documents where text is not null and text <> ''
""")
def load_export_csv(spark, folder):
    path = scratch_path(spark, "export")
    data = F.concat(F.lit('{"id":'), F.col("post_id"), F.lit(',"tags":["a","b"]}'))
    export = adapters.doc_posts(spark, folder).where("cleaned_text <> ''").select(
        "post_id", "subreddit", "board", data.alias("data"), "cleaned_text"
    )
    export.write.option("header", True).option("escape", '"').option("quoteAll", True).option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
    schema = "post_id string, subreddit string, board string, data string, cleaned_text string"
    return tables.load_export_csv(
        spark, path, schema, ["post_id", "subreddit", "cleaned_text", "data"]
    )


@query("""
select event_type board, cast(floor(epoch(ts)) as bigint) snapshot_at, user_id thread_number
from events
union all
select event_type, cast(floor(epoch(ts)) as bigint), event_id from events
""")
def explode_catalog_threads(spark, folder):
    return payloads.explode_catalog_threads(
        adapters.catalog_payloads(spark, folder), ["board", "snapshot_at"]
    )


@query(r"""
with p as (select *, regexp_extract(url, '^https?://([^/]+)/', 1) board,
                  1704067200 + page_id * 60 created_at from pages)
select board, page_id thread_number, page_id * 2 post_number, created_at, html com from p
union all
select board, page_id, page_id * 2 + 1, created_at, '' from p
""")
def explode_thread_posts(spark, folder):
    return payloads.explode_thread_posts(
        adapters.thread_payloads(spark, folder), ["board", "thread_number"], clean=False
    ).drop("data")


@query("""
select 't1' kind, cast(conv_id as varchar) post_id, conv_id || '-' || turn id, text body
from conversations
union all
select distinct 'more', cast(conv_id as varchar), conv_id || '-x', null from conversations
union all
select distinct 'more', cast(conv_id as varchar), conv_id || '-' || turn, null from conversations
""")
def explode_listing(spark, folder):
    listings = adapters.listing_payloads(spark, folder)
    comments = payloads.explode_listing(listings, ["post_id"]).select(
        F.lit("t1").alias("kind"),
        "post_id",
        "id",
        F.get_json_object("data", "$.body").alias("body"),
    )
    more = payloads.listing_more_ids(listings, ["post_id"]).select(
        F.lit("more").alias("kind"), "post_id", "id", F.lit(None).cast("string").alias("body")
    )
    return comments.unionByName(more)


CHAN_KEYS = ["board", "thread_number", "post_number"]


@query("""
select board, thread_number, post_number, created, replies from chan_posts where class <> 'flag'
""")
def append_new_posts(spark, folder):
    """Flagged posts are stored already; everything comes in again, twice."""
    every = adapters.chan_posts(spark, folder).select(*CHAN_KEYS, "created", "replies", "class")
    stored = every.where("class = 'flag'").drop("class")
    incoming = every.drop("class")
    again = incoming.withColumn("created", F.col("created") + 60)
    return sinks.append_new_posts(stored, incoming.unionByName(again), CHAN_KEYS, "created")


@query("""
with every as (
  select post_id, votes * 1.0 votes, created version, 0 is_new from posts
  union all
  select post_id, mod_score, created, 1 from comments)
select post_id, votes, version from every
qualify row_number() over (partition by post_id order by version desc, is_new desc, votes desc) = 1
""")
def upsert_latest(spark, folder):
    """Posts updated by whatever their comments say, latest time first."""
    target = adapters.posts(spark, folder).select(
        "post_id", F.col("votes").cast("double").alias("votes"), F.col("created").alias("version")
    )
    updates = adapters.comments(spark, folder).select(
        "post_id", F.col("mod_score").alias("votes"), F.col("created").alias("version")
    )
    return sinks.upsert_latest(target, updates, ["post_id"], "version")


@query("""
with target as (
  select post_id, 'stored' "data", 0.5 mod_score, 'normal' class from posts where status <> 'P'),
updates as (select post_id, id "data", mod_score, class, created from comments),
every as (
  select *, 0 is_new, cast(null as bigint) version from target
  union all select post_id, "data", mod_score, class, 1, created from updates),
latest as (
  select post_id, "data" from every
  qualify row_number() over (
    partition by post_id order by is_new desc, version desc, "data" desc) = 1),
earliest as (
  select post_id, mod_score, class from every
  qualify row_number() over (
    partition by post_id order by is_new, version, mod_score, class) = 1)
select post_id, "data", cast(mod_score as double) mod_score, class
from latest join earliest using (post_id)
""")
def upsert_partial(spark, folder):
    """Open posts are new, the rest keep their stored score and class."""
    target = adapters.posts(spark, folder).where("status <> 'P'").select(
        "post_id",
        F.lit("stored").alias("data"),
        F.lit(0.5).alias("mod_score"),
        F.lit("normal").alias("class"),
    )
    updates = adapters.comments(spark, folder).select(
        "post_id", F.col("id").alias("data"), "mod_score", "class", "created"
    )
    return sinks.upsert_partial(
        target, updates, ["post_id"], ["data"], ["mod_score", "class"], "created"
    )


@query("""
select cast(make_timestamp(created * 1000000) as date) "date", count(*) post_count
from chan_posts group by 1
""")
def write_daily_metrics(spark, folder):
    path = scratch_path(spark, "daily")
    sinks.write_daily_metrics(daily_counts(adapters.chan_posts(spark, folder)), path, "csv")
    return spark.read.schema("date date, post_count bigint").option("header", True).csv(path)


@query("""
with lines as (
  select conv_id, turn, unnest(string_split(text, chr(10))) line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 i
  from conversations)
select cast(conv_id as varchar) post_id, conv_id || '-' || turn id,
       cast(conv_id as varchar) parent_id, role comment_text from conversations
union all
select cast(conv_id as varchar), conv_id || '-' || turn || '-' || i,
       conv_id || '-' || turn, line from lines
union all
select cast(conv_id as varchar), conv_id || '-' || turn || '-' || i || 'e',
       conv_id || '-' || turn || '-' || i, 'so: ' || line from lines
""")
def flatten_comment_tree(spark, folder):
    trees = adapters.comment_trees(spark, folder)
    return nested.flatten_comment_tree(trees).drop("data", "position")
