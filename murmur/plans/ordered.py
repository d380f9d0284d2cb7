"""Queries for peaks, trends, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmur.operators import engagement as E
from murmur.operators import nested, network, ranking, series
from murmur.plans.aggregates import (
    DAILY_SQL,
    DATE_SQL,
    HOUR_SQL,
    SENTIMENT_SQL,
    USER_ENGAGEMENT_SQL,
    sentiment_by_day,
    user_engagement,
)
from murmur.plans.joins import INTERACTIONS_SQL, USERS_SQL, interactions
from murmur.plans.registry import query
from murmur.plans.scalars import TERMS_SQL, KEYWORDS
from murmur.sources import adapters


@query(f"""
with hours as (select {HOUR_SQL}, count(*) post_count from comments group by 1)
select "hour", post_count from hours order by post_count desc, "hour" limit 1
""")
def peak_row(spark, folder):
    return series.peak_row(E.hourly_counts(adapters.comments(spark, folder)), "post_count", "hour")


@query(f"""
with {SENTIMENT_SQL}
select "date", avg_sentiment,
       cast(sum(cast(avg_sentiment as decimal(10,2))) over (order by "date") as double)
         cumulative_sentiment
from daily
""")
def cumulative_sentiment(spark, folder):
    return series.cumulative_sentiment(sentiment_by_day(spark, folder))


@query(f"""
with {DAILY_SQL},
r as (select post_count, row_number() over (order by "date") up,
             row_number() over (order by "date" desc) down from daily),
m as (select count(*) n, avg(post_count) filter (up <= 7) f, avg(post_count) filter (down <= 7) l
      from r)
select cast(least(7, n) as int) "days", f first_avg, l last_avg,
       round((l - f) / f * 100, 9) percent_change
from m where n > 1
""")
def trend_first_last(spark, folder):
    daily = E.daily_counts(adapters.chan_posts(spark, folder))
    return series.trend_first_last(daily, "post_count", "date").withColumn(
        "percent_change", F.round("percent_change", 9)
    )


@query(f"""
select "date", avg(n) avg_replies
from (select {DATE_SQL}, post_id, count(*) n from comments group by 1, 2)
group by 1 order by 1 desc limit 30
""")
def last_n_rows(spark, folder):
    return series.last_n_rows(E.daily_avg_replies(adapters.comments(spark, folder), "post_id"))


@query(f"""
with {USER_ENGAGEMENT_SQL}, {INTERACTIONS_SQL}, {USERS_SQL.replace("users as", "activity as")},
authors as (select author, sum(total_engagement_score) v from users group by 1),
people as (
  select "user", 0.4::double * sum(post_score) + 0.3::double * sum(comment_score)
                 + 15.0::double * sum(post_count) v
  from activity group by 1)
(select 'total_engagement' metric, author "user", v "value" from authors
 order by v desc, author limit 10)
union all
(select 'engagement_score', "user", round(v, 6) from people order by v desc, "user" limit 10)
""")
def top_users(spark, folder):
    authors = E.author_totals(user_engagement(spark, folder))
    people = network.with_engagement(network.user_activity(interactions(spark, folder)))
    first = ranking.top_users(authors, "total_engagement_score").select(
        F.lit("total_engagement").alias("metric"),
        F.col("author").alias("user"),
        F.col("total_engagement_score").alias("value"),
    )
    second = ranking.top_users(people, "engagement_score", "user").select(
        F.lit("engagement_score").alias("metric"),
        "user",
        F.round("engagement_score", 6).alias("value"),
    )
    return ranking.concat_frames([first, second])


@query(f"""
with {USER_ENGAGEMENT_SQL},
largest as (select subreddit from users group by 1
            order by sum(total_engagement_score) desc, 1 limit 10)
select subreddit, author, total_engagement_score,
       cast(row_number() over (partition by subreddit
                               order by total_engagement_score desc, author) as int) "rank"
from users where subreddit in (select subreddit from largest)
qualify "rank" <= 5
""")
def top_users_per_subreddit(spark, folder):
    return ranking.top_users_per_subreddit(user_engagement(spark, folder)).select(
        "subreddit", "author", "total_engagement_score", "rank"
    )


@query(f"""
with terms as ({TERMS_SQL})
select term, count(*) occurrences from terms group by 1 order by 2 desc, 1 limit 20
""")
def most_common_terms(spark, folder):
    counts = E.term_counts(adapters.doc_posts(spark, folder), "cleaned_text", KEYWORDS)
    return ranking.most_common_terms(counts, 20)


@query("""
select post_id, created, cleaned_text from doc_posts
where board in ('src1', 'src2', 'src3') and cleaned_text is not null
order by created desc, post_id limit 100
""")
def latest_posts(spark, folder):
    docs = adapters.doc_posts(spark, folder).where(F.col("board").isin("src1", "src2", "src3"))
    return ranking.latest_posts(docs).select("post_id", "created", "cleaned_text")


@query("""
select post_id, id, created from comments
qualify row_number() over (partition by post_id order by created, id) <= 3
""")
def cap_rows_per_group(spark, folder):
    comments = adapters.comments(spark, folder).select("post_id", "id", "created")
    return ranking.cap_rows_per_group(
        comments, ["post_id"], [F.col("created").asc(), F.col("id").asc()], 3
    )


@query(f"""
with {INTERACTIONS_SQL}
select post_author "user" from interactions union select comment_author from interactions
""")
def active_users(spark, folder):
    return ranking.active_users(interactions(spark, folder))


@query("""
select post_id "key", created, subreddit, cast(null as varchar) board from posts
union all
select cast(post_number as varchar), created, null, board from chan_posts
""")
def concat_frames(spark, folder):
    return ranking.concat_frames(
        [
            adapters.posts(spark, folder).select(
                F.col("post_id").alias("key"), "created", "subreddit"
            ),
            adapters.chan_posts(spark, folder).select(
                F.col("post_number").cast("string").alias("key"), "created", "board"
            ),
        ]
    )


@query("""
with marks as (
  select conv_id, max(turn) filter (role = 'user') mark from conversations group by 1)
select cast(conv_id as varchar) post_id, conv_id || '-' || turn id, turn pos
from conversations join marks using (conv_id)
where mark is null or turn < mark
""")
def new_comments_since(spark, folder):
    """Turns are comments in arrival order; the last user turn is the stored marker."""
    turns = adapters.table(spark, folder, "conversations").select(
        F.col("conv_id").cast("string").alias("post_id"),
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
        F.col("turn").alias("pos"),
        "role",
    )
    state = (
        turns.groupBy("post_id")
        .agg(F.max(F.when(F.col("role") == "user", F.col("pos"))).alias("_turn"))
        .select(
            "post_id",
            F.concat(F.col("post_id"), F.lit("-"), F.col("_turn").cast("string")).alias(
                "last_comment_id"
            ),
        )
    )
    return nested.new_comments_since(turns.drop("role"), state)
