"""Queries for joins."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from murmur.operators import joins as O
from murmur.operators import network
from murmur.operators.engagement import daily_counts, hourly_counts
from murmur.operators.filters import match_any_phrase
from murmur.operators.ranking import top_users
from murmur.plans.filters import FROM, TO
from murmur.plans.registry import query
from murmur.sources import adapters

BOTS = ["u0", "u1"]
PHRASES = ["ring", "widget"]

INTERACTIONS_SQL = """
interactions as (
  select p.post_id, p.subreddit, p.author post_author, p.votes post_score,
         c.author comment_author, c.mod_score comment_score
  from posts p join comments c on p.post_id = c.post_id
  where (contains(lower(p.cleaned_title), 'ring') or contains(lower(p.cleaned_title), 'widget'))
    and p.author not in ('u0', 'u1') and c.author not in ('u0', 'u1'))"""

USERS_SQL = """
post_stats as (
  select subreddit, post_author "user", count(post_id) post_count, sum(post_score) post_score
  from interactions group by all),
comment_stats as (
  select subreddit, comment_author "user", sum(comment_score) comment_score
  from interactions group by all),
users as (
  select subreddit, "user", coalesce(post_count, 0) post_count,
         cast(coalesce(post_score, 0) as bigint) post_score,
         coalesce(comment_score, 0.0) comment_score,
         0.4::double * coalesce(post_score, 0) + 0.3::double * coalesce(comment_score, 0)
           + 15.0::double * coalesce(post_count, 0) engagement_score
  from post_stats full join comment_stats using (subreddit, "user"))"""


def topic_posts(spark, folder):
    return match_any_phrase(
        adapters.posts(spark, folder, text=True), ["cleaned_title"], PHRASES
    )


def interactions(spark, folder):
    return O.interaction_counts(
        topic_posts(spark, folder), adapters.comments(spark, folder), BOTS
    )


@query("""
select p.post_id, p.subreddit, count(c.id) comment_count, sum(c.mod_score) score_sum,
       count(c.mod_score) score_count
from posts p left join comments c on p.post_id = c.post_id group by 1, 2
""")
def posts_left_join_comments(spark, folder):
    posts = adapters.posts(spark, folder).select("post_id", "subreddit")
    return O.posts_left_join_comments(posts, adapters.comments(spark, folder))


@query(f"with {INTERACTIONS_SQL} select * from interactions")
def post_comment_interactions(spark, folder):
    return O.post_comment_interactions(
        topic_posts(spark, folder), adapters.comments(spark, folder), BOTS
    )


@query("""
select id, post_id from comments
where post_id in (select post_id from posts where subreddit = '3-MEDIUM')
""")
def comments_of_topic(spark, folder):
    posts = adapters.posts(spark, folder).where("subreddit = '3-MEDIUM'")
    return O.comments_of_topic(adapters.comments(spark, folder), posts).select("id", "post_id")


@query("""
with seen as (
  select distinct board, thread_number, cast(make_timestamp(created * 1000000) as date) snapshot
  from chan_posts)
select board, thread_number, snapshot + 1 snapshot from seen
where snapshot < (select max(snapshot) from seen)
except
select board, thread_number, snapshot from seen
""")
def dead_threads(spark, folder):
    """Threads active on a day and not on the next, for every board and day."""
    seen = adapters.chan_posts(spark, folder).select(
        "board",
        "thread_number",
        F.to_date(F.timestamp_seconds("created")).alias("snapshot"),
    )
    last = seen.agg(F.max("snapshot")).scalar()
    before = seen.where(F.col("snapshot") < last).withColumn(
        "snapshot", F.date_add("snapshot", 1)
    )
    return O.dead_threads(before, seen, ["board", "thread_number", "snapshot"])


CHAN_HOURS_SQL = """
grid as (select unnest(generate_series(timestamp '2023-12-30', timestamp '2024-02-03',
                                       interval 1 hour)) "hour"),
counts as (select date_trunc('hour', make_timestamp(created * 1000000)) "hour", count(*) n
           from chan_posts group by 1)"""


@query(f"""
with {CHAN_HOURS_SQL}
select "hour", coalesce(n, 0) post_count from grid left join counts using ("hour")
""")
def gap_fill_hours(spark, folder):
    counts = hourly_counts(adapters.chan_posts(spark, folder))
    return O.gap_fill_hours(counts, date(2023, 12, 30), date(2024, 2, 2))


@query("""
with grid as (select cast(unnest(generate_series(timestamp '1994-12-25', timestamp '2001-08-10',
                                                 interval 1 day)) as date) "date"),
counts as (select cast(make_timestamp(created * 1000000) as date) "date", count(*) n
           from posts where subreddit = '5-LOW' group by 1)
select "date", coalesce(n, 0) post_count from grid left join counts using ("date")
""")
def gap_fill_days(spark, folder):
    counts = daily_counts(adapters.posts(spark, folder).where("subreddit = '5-LOW'"))
    return O.gap_fill_days(counts, date(1994, 12, 25), date(2001, 8, 10))


@query(f"""
with {INTERACTIONS_SQL}, {USERS_SQL}
select "user", cast(sum(post_count) as bigint) post_count,
       cast(sum(post_score) as bigint) post_score, sum(comment_score) comment_score
from users group by 1
""")
def user_stats_outer(spark, folder):
    found = interactions(spark, folder)
    return O.user_stats_outer(
        network.post_author_stats(found), network.comment_author_stats(found)
    )


@query(f"""
with {INTERACTIONS_SQL}, {USERS_SQL},
top as (select "user", round(sum(engagement_score), 6) s from users group by 1
        order by 2 desc, 1 limit 100)
select least(post_author, comment_author) user_a, greatest(post_author, comment_author) user_b,
       count(*) weight
from interactions
where post_author <> comment_author
  and post_author in (select "user" from top) and comment_author in (select "user" from top)
group by 1, 2
""")
def edges_between_top_users(spark, folder):
    found = interactions(spark, folder)
    users = network.with_engagement(network.user_activity(found)).withColumn(
        "engagement_score", F.round("engagement_score", 6)
    )
    top = top_users(users, "engagement_score", "user", 100)
    return O.edges_between_top_users(
        network.interaction_edges(found), F.broadcast(top), ("user_a", "user_b")
    )
