"""Queries for filters and predicates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from murmur.operators import filters as O
from murmur.operators import topics
from murmur.operators.ranking import concat_frames
from murmur.plans.registry import query
from murmur.sources import adapters
from murmur.sources.adapters import DAY, epoch_of

FROM, TO = epoch_of(1996, 1, 1), epoch_of(2000, 6, 30)
CHAN_AS_OF = epoch_of(2024, 1, 31)
POSTS_AS_OF = epoch_of(2001, 8, 2)
PHRASES = ["ring", "widget", "promo", "small bolt"]
PHRASES_SQL = " or ".join(
    f"contains(lower({c}), '{p}')" for c in ("cleaned_title", "cleaned_text") for p in PHRASES
)

TOPICS = {
    "hardware": {
        "posts": topics.communities(["1-URGENT", "2-HIGH"]),
        "comments": topics.comments_in(["1-URGENT", "2-HIGH"]),
        "chan_posts": topics.board("src1", ["THAT", " der "]),
    }
}


@query(f"select post_id, created from posts where created between {FROM} and {TO}")
def filter_epoch_between(spark, folder):
    posts = adapters.posts(spark, folder, window=(FROM, TO))
    return O.filter_epoch_between(posts, FROM, TO).select("post_id", "created")


@query("""
select post_number, created from chan_posts
where cast(make_timestamp(created * 1000000) as date) between date '2024-01-05' and date '2024-01-24'
""")
def filter_date_between(spark, folder):
    start, end = date(2024, 1, 5), date(2024, 1, 24)
    window = (epoch_of(2024, 1, 5), epoch_of(2024, 1, 25))
    chan = adapters.chan_posts(spark, folder, window)
    return O.filter_date_between(chan, start, end).select("post_number", "created")


@query(f"select post_number, created from chan_posts where created >= {CHAN_AS_OF - 14 * DAY}")
def filter_last_n_days(spark, folder):
    chan = adapters.chan_posts(spark, folder, (CHAN_AS_OF - 14 * DAY, 2**33))
    return O.filter_last_n_days(chan, 14, CHAN_AS_OF).select("post_number", "created")


@query(f"select post_id, cleaned_title, cleaned_text from posts where {PHRASES_SQL}")
def match_any_phrase(spark, folder):
    posts = adapters.posts(spark, folder, text=True)
    return O.match_any_phrase(posts, ["cleaned_title", "cleaned_text"], PHRASES).select(
        "post_id", "cleaned_title", "cleaned_text"
    )


@query("select id, author from comments where author not in ('u0', 'u1')")
def exclude_bots(spark, folder):
    comments = adapters.comments(spark, folder)
    return O.exclude_bots(comments, ["author"], ["u0", "u1"]).select("id", "author")


@query("select post_number, board from chan_posts where board in ('click', 'view')")
def filter_in_list(spark, folder):
    chan = adapters.chan_posts(spark, folder)
    return O.filter_in_list(chan, "board", ["click", "view"]).select("post_number", "board")


@query("select post_number, thread_number from chan_posts where resto = 0")
def filter_root_posts(spark, folder):
    chan = adapters.chan_posts(spark, folder)
    return O.filter_root_posts(chan).select("post_number", "thread_number")


@query("select post_id, length(cleaned_text) chars from doc_posts where cleaned_text <> ''")
def filter_non_empty_text(spark, folder):
    docs = O.filter_non_empty_text(adapters.doc_posts(spark, folder), "cleaned_text")
    return docs.select("post_id", F.length("cleaned_text").cast("bigint").alias("chars"))


@query("""
with chosen as (select * from posts where subreddit in ('1-URGENT', '2-HIGH'))
select 'posts' source, post_id id from chosen
union all
select 'comments', id from comments where post_id in (select post_id from chosen)
union all
select 'chan_posts', post_id from doc_posts
where board = 'src1' and (cleaned_text ilike '%THAT%' or cleaned_text ilike '% der %')
""")
def topic_filter(spark, folder):
    posts = adapters.posts(spark, folder)
    frames = {
        "posts": (posts, "post_id"),
        "comments": (adapters.comments(spark, folder), "id"),
        "chan_posts": (adapters.doc_posts(spark, folder), "post_id"),
    }
    return concat_frames(
        [
            topics.topic_filter(frame, "hardware", source, posts, TOPICS).select(
                F.lit(source).alias("source"), F.col(key).alias("id")
            )
            for source, (frame, key) in frames.items()
        ]
    )


@query(f"""
with last as (select post_id, max(created) last_comment_update from comments group by 1)
select post_id, created, last_comment_update
from posts left join last using (post_id)
where subreddit = '1-URGENT' and created > {POSTS_AS_OF - 2400 * DAY}
  and (last_comment_update is null or last_comment_update < {POSTS_AS_OF - 6 * 3600})
""")
def stale_posts(spark, folder):
    """A post was last refreshed when its latest comment came in."""
    last = adapters.comments(spark, folder).groupBy("post_id").agg(
        F.max("created").alias("last_comment_update")
    )
    posts = adapters.posts(spark, folder).join(last, "post_id", "left")
    return O.stale_posts(posts, "1-URGENT", POSTS_AS_OF, max_age_days=2400).select(
        "post_id", "created", "last_comment_update"
    )
