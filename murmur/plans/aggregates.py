"""Queries for aggregations."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from murmur.operators import engagement as O
from murmur.operators import network, series
from murmur.operators.filters import filter_last_n_days
from murmur.plans.filters import CHAN_AS_OF, POSTS_AS_OF, PHRASES, PHRASES_SQL
from murmur.plans.joins import BOTS, INTERACTIONS_SQL, USERS_SQL, interactions
from murmur.plans.registry import query
from murmur.plans.scalars import KEYWORDS, LEXICON, POLARITY_SQL, TERMS_SQL, TOKENS_SQL
from murmur.schemas import POST_FIELDS
from murmur.sources import adapters
from murmur.sources.adapters import DAY, epoch_of
from murmur.sources.tables import expose_json_fields

START, END = epoch_of(1995, 1, 1), epoch_of(2002, 1, 1)
CHAN_START, CHAN_END = epoch_of(2024, 1, 1), epoch_of(2024, 1, 31)
DATE_SQL = 'cast(make_timestamp(created * 1000000) as date) "date"'
HOUR_SQL = "date_trunc('hour', make_timestamp(created * 1000000)) \"hour\""

HOURLY_SQL = f"""
hourly as (
  select date_trunc('hour', make_timestamp(p.created * 1000000)) "hour", p.subreddit,
         count(distinct p.post_id) post_count, count(c.id) comment_count,
         coalesce(avg(c.mod_score), 0) avg_comment_score
  from posts p left join comments c on p.post_id = c.post_id
  where p.created between {START} and {END} group by 1, 2)"""
BOARDS_SQL = f"""
hourly as (
  select {HOUR_SQL}, board, count(*) post_count, avg(replies) avg_replies
  from chan_posts where created between {CHAN_START} and {CHAN_END} group by 1, 2)"""
USER_ENGAGEMENT_SQL = f"""
per_post as (
  select p.post_id, p.subreddit, p.author, p.votes, count(c.id) comment_count,
         sum(coalesce(c.mod_score, 0)) comment_score
  from posts p left join comments c on p.post_id = c.post_id
  where p.created between {START} and {END} and ({PHRASES_SQL}) group by 1, 2, 3, 4),
users as (
  select author, subreddit, count(distinct post_id) post_count,
         cast(sum(votes) as bigint) total_post_score,
         cast(sum(comment_count) as bigint) total_comments,
         sum(comment_score) total_comment_score,
         sum(votes) + sum(comment_score) total_engagement_score
  from per_post where author not in ('u0', 'u1') group by 1, 2)"""
REDDIT_METRICS = ("post_count", "comment_count", "avg_comment_score")
CHAN_METRICS = ("post_count", "avg_replies")
DAILY_SQL = f"daily as (select {DATE_SQL}, count(*) post_count from chan_posts group by 1)"


def posts_by_hour(spark, folder):
    return O.hourly_engagement(
        adapters.posts(spark, folder, window=(START, END)),
        adapters.comments(spark, folder),
        START,
        END,
    )


def boards_by_hour(spark, folder):
    chan = adapters.chan_posts(spark, folder, (CHAN_START, CHAN_END))
    return O.hourly_board_activity(chan, CHAN_START, CHAN_END)


def user_engagement(spark, folder):
    return O.ai_user_engagement(
        adapters.posts(spark, folder, text=True, window=(START, END)),
        adapters.comments(spark, folder),
        START,
        END,
        PHRASES,
        bots=BOTS,
    )


def rounded(frame, *columns):
    return frame.withColumns({c: F.round(c, 9) for c in columns})


@query("select min(created) min_date, max(created) max_date from posts")
def date_range(spark, folder):
    return O.date_range(adapters.posts(spark, folder))


@query(f"with {HOURLY_SQL} select * from hourly")
def hourly_engagement(spark, folder):
    return posts_by_hour(spark, folder)


@query(f"with {BOARDS_SQL} select * from hourly")
def hourly_board_activity(spark, folder):
    return boards_by_hour(spark, folder)


@query(f"""
with {HOURLY_SQL}
select cast(hour("hour") as int) "hour", avg(post_count) post_count,
       avg(comment_count) comment_count, round(avg(avg_comment_score), 9) avg_comment_score
from hourly group by 1
""")
def hour_of_day_profile(spark, folder):
    profile = O.hour_of_day_profile(posts_by_hour(spark, folder), list(REDDIT_METRICS))
    return rounded(profile, "avg_comment_score")


@query(f"""
with {BOARDS_SQL}
select cast(isodow("hour") - 1 as int) day_order, dayname("hour") "day",
       avg(post_count) post_count, round(avg(avg_replies), 9) avg_replies
from hourly group by 1, 2
""")
def weekday_profile(spark, folder):
    profile = O.weekday_profile(boards_by_hour(spark, folder), list(CHAN_METRICS))
    return rounded(profile, "avg_replies")


@query(f"""
with {HOURLY_SQL},
hours as (select cast(hour("hour") as int) h, avg(post_count) p, avg(comment_count) c
          from hourly group by 1),
days as (select isodow("hour") - 1 o, dayname("hour") d, avg(post_count) p, avg(comment_count) c
         from hourly group by 1, 2)
select (select h from hours order by p desc, h limit 1) peak_hour_post_count,
       (select h from hours order by c desc, h limit 1) peak_hour_comment_count,
       (select d from days order by p desc, o limit 1) peak_day_post_count,
       (select d from days order by c desc, o limit 1) peak_day_comment_count,
       (select round(avg(p), 9) from hours) avg_hour_post_count,
       (select round(avg(c), 9) from hours) avg_hour_comment_count,
       (select round(avg(p), 9) from days) avg_day_post_count,
       (select round(avg(c), 9) from days) avg_day_comment_count
""")
def engagement_summary(spark, folder):
    hourly = posts_by_hour(spark, folder)
    metrics = ("post_count", "comment_count")
    summary = O.engagement_summary(
        O.hour_of_day_profile(hourly, list(metrics)),
        O.weekday_profile(hourly, list(metrics)),
        metrics,
    )
    return rounded(summary, *[c for c in summary.columns if c.startswith("avg_")])


@query(f"with {USER_ENGAGEMENT_SQL} select * from users")
def ai_user_engagement(spark, folder):
    return user_engagement(spark, folder)


@query(f"""
with {USER_ENGAGEMENT_SQL}
select 'all' subreddit, count(distinct author) active_users,
       cast(sum(post_count) as bigint) total_posts,
       cast(sum(total_comments) as bigint) total_comments,
       cast(round(cast(avg(total_engagement_score) as decimal(28,10)), 2) as double) avg_engagement_score
from users
union all
select subreddit, count(distinct author), cast(sum(post_count) as bigint),
       cast(sum(total_comments) as bigint),
       cast(round(cast(avg(total_engagement_score) as decimal(28,10)), 2) as double)
from users group by 1
""")
def engagement_overview(spark, folder):
    users = user_engagement(spark, folder)
    overall = O.engagement_overview(users).withColumn("subreddit", F.lit("all"))
    return overall.unionByName(O.engagement_overview(users, by_subreddit=True))


@query(f"""
with {USER_ENGAGEMENT_SQL}
select author, cast(sum(total_post_score) as bigint) total_post_score,
       sum(total_comment_score) total_comment_score,
       sum(total_engagement_score) total_engagement_score
from users group by 1
""")
def author_totals(spark, folder):
    return O.author_totals(user_engagement(spark, folder))


@query(f"""
with {USER_ENGAGEMENT_SQL}
select subreddit, sum(total_engagement_score) total_engagement_score from users group by 1
""")
def subreddit_totals(spark, folder):
    return O.subreddit_totals(user_engagement(spark, folder))


@query(f"""
with {INTERACTIONS_SQL}
select subreddit, count(distinct post_id) post_count from interactions group by 1
""")
def subreddit_post_counts(spark, folder):
    return O.subreddit_post_counts(interactions(spark, folder))


@query(f"""
with {INTERACTIONS_SQL},
people as (
  select subreddit, post_author u from interactions
  union select subreddit, comment_author from interactions)
select i.subreddit, count(distinct post_id) total_posts, count(*) total_comments,
       any_value(n) active_users
from interactions i
join (select subreddit, count(*) n from people group by 1) p on p.subreddit = i.subreddit
group by 1
""")
def subreddit_network_overview(spark, folder):
    return network.subreddit_network_overview(interactions(spark, folder))


@query(f"""
with {INTERACTIONS_SQL}
select subreddit, post_author "user", count(*) post_count,
       cast(sum(post_score) as bigint) post_score
from interactions group by 1, 2
""")
def post_author_stats(spark, folder):
    return network.post_author_stats(interactions(spark, folder), ["subreddit"])


@query(f"""
with {INTERACTIONS_SQL}
select subreddit, comment_author "user", sum(comment_score) comment_score
from interactions group by 1, 2
""")
def comment_author_stats(spark, folder):
    return network.comment_author_stats(interactions(spark, folder), ["subreddit"])


@query(f"""
select {DATE_SQL}, subreddit, count(*) post_count from posts
where subreddit in ('1-URGENT', '2-HIGH', '5-LOW') and created >= {POSTS_AS_OF - 2000 * DAY}
group by 1, 2
""")
def daily_counts_by_subreddit(spark, folder):
    posts = adapters.posts(spark, folder, window=(POSTS_AS_OF - 2000 * DAY, 2**33)).where(
        F.col("subreddit").isin("1-URGENT", "2-HIGH", "5-LOW")
    )
    return O.daily_counts_by_subreddit(filter_last_n_days(posts, 2000, POSTS_AS_OF))


@query(f"""
select {DATE_SQL}, count(*) post_count from chan_posts
where resto = 0 and created >= {CHAN_AS_OF - 30 * DAY} group by 1
""")
def daily_counts(spark, folder):
    chan = adapters.chan_posts(spark, folder)
    return O.daily_counts(filter_last_n_days(chan, 30, CHAN_AS_OF), roots_only=True)


@query(f"select {HOUR_SQL}, count(*) post_count from comments group by 1")
def hourly_counts(spark, folder):
    return O.hourly_counts(adapters.comments(spark, folder))


DATE_HOUR_SQL = f"""
select {DATE_SQL}, cast(hour(make_timestamp(created * 1000000)) as int) "hour",
       count(*) post_count
from chan_posts where resto = 0 group by 1, 2"""


@query(DATE_HOUR_SQL)
def date_hour_counts(spark, folder):
    return O.date_hour_counts(adapters.chan_posts(spark, folder))


PIVOT_SQL = ", ".join(
    f"cast(coalesce(sum(post_count) filter (\"hour\" = {h}), 0) as bigint) h{h:02d}"
    for h in range(24)
)


@query(f'with counts as ({DATE_HOUR_SQL}) select "date", {PIVOT_SQL} from counts group by 1')
def date_hour_pivot(spark, folder):
    return O.date_hour_pivot(O.date_hour_counts(adapters.chan_posts(spark, folder)))


TOXICITY_SQL = f"""
select {DATE_SQL}, count(*) post_count,
       avg(case when class = 'flag' then mod_score end) avg_toxicity_score,
       count(*) filter (class = 'flag') toxic_posts_count
from chan_posts group by 1"""


@query(TOXICITY_SQL)
def daily_toxicity(spark, folder):
    return O.daily_toxicity(adapters.chan_posts(spark, folder))


@query(f"""
with daily as ({TOXICITY_SQL})
select round(avg(avg_toxicity_score), 9) avg_daily_score, max(avg_toxicity_score) max_daily_score,
       cast(sum(toxic_posts_count) as bigint) total_toxic_posts,
       round(sum(toxic_posts_count) / sum(post_count) * 100, 9) toxic_percent
from daily
""")
def toxicity_summary(spark, folder):
    summary = O.toxicity_summary(O.daily_toxicity(adapters.chan_posts(spark, folder)))
    return rounded(summary, "avg_daily_score", "toxic_percent")


@query(f"""
select "date", avg(n) avg_replies
from (select {DATE_SQL}, post_id, count(*) n from comments group by 1, 2) group by 1
""")
def daily_avg_replies(spark, folder):
    return O.daily_avg_replies(adapters.comments(spark, folder), "post_id")


@query(f"""
select {DATE_SQL}, avg(cast(case when status = 'F' then votes else 0 end as double)) avg_ups
from posts group by 1
""")
def daily_avg_upvotes(spark, folder):
    posts = adapters.posts_json(spark, folder)
    created = {"created": POST_FIELDS["created"]}
    return O.daily_avg_upvotes(expose_json_fields(posts, created))


SENTIMENT_START, SENTIMENT_END = date(2023, 12, 30), date(2024, 2, 1)
SENTIMENT_SQL = f"""
{POLARITY_SQL},
grid as (select cast(unnest(generate_series(timestamp '2023-12-30', timestamp '2024-02-01',
                                            interval 1 day)) as date) "date"),
means as (
  select {DATE_SQL}, count(*) n,
         cast(sum(cast(polarity as decimal(6,2))) as double) / count(*) m
  from scored group by 1),
daily as (
  select "date", coalesce(cast(round(cast(m as decimal(18,10)), 2) as double), 0.0) avg_sentiment,
         coalesce(n, 0) post_count
  from grid left join means using ("date"))"""


def sentiment_by_day(spark, folder):
    return O.daily_sentiment(
        adapters.doc_posts(spark, folder),
        ["post_id"],
        "cleaned_text",
        LEXICON,
        SENTIMENT_START,
        SENTIMENT_END,
    )


@query(f"with {SENTIMENT_SQL} select * from daily")
def daily_sentiment(spark, folder):
    return sentiment_by_day(spark, folder)


@query(f"with terms as ({TERMS_SQL}) select term, count(*) occurrences from terms group by 1")
def term_counts(spark, folder):
    return O.term_counts(adapters.doc_posts(spark, folder), "cleaned_text", KEYWORDS)


@query(f"""
with terms as ({TERMS_SQL})
select (select count(distinct post_id) from terms) records,
       round((select count(distinct post_id) from terms) / count(*) * 100, 9) "percent"
from doc_posts where cleaned_text is not null and cleaned_text <> ''
""")
def records_with_terms(spark, folder):
    found = O.records_with_terms(adapters.doc_posts(spark, folder), "cleaned_text", KEYWORDS)
    return rounded(found, "percent")


@query(f"with tokens as ({TOKENS_SQL}) select token term, count(*) occurrences from tokens group by 1")
def word_frequencies(spark, folder):
    return O.word_frequencies(adapters.doc_posts(spark, folder), "cleaned_text")


EDGES_SQL = """
edges as (
  select least(post_author, comment_author) user_a, greatest(post_author, comment_author) user_b,
         count(*) weight
  from interactions where post_author <> comment_author group by 1, 2)"""


@query(f"with {INTERACTIONS_SQL}, {EDGES_SQL} select * from edges")
def interaction_edges(spark, folder):
    return network.interaction_edges(interactions(spark, folder))


@query(f"""
with {INTERACTIONS_SQL}, {EDGES_SQL}
select cast(coalesce(sum(weight), 0) as bigint) total_interactions,
       coalesce(avg(weight), 0) avg_interactions from edges
""")
def interaction_summary(spark, folder):
    return network.interaction_summary(network.interaction_edges(interactions(spark, folder)))


@query(f"""
with {DAILY_SQL}
select cast(sum(post_count) as bigint) total, avg(post_count) mean, max(post_count) maximum,
       min(post_count) minimum,
       (select "date" from daily order by post_count desc, "date" limit 1) peak_time
from daily
""")
def series_summary(spark, folder):
    daily = O.daily_counts(adapters.chan_posts(spark, folder))
    return series.series_summary(daily, "post_count", "date")


@query(f"""
with daily as (select {DATE_SQL}, subreddit, count(*) post_count from posts group by 1, 2)
select subreddit, cast(sum(post_count) as bigint) total, avg(post_count) mean,
       max(post_count) maximum, min(post_count) minimum
from daily group by 1
""")
def series_summary_by_group(spark, folder):
    daily = O.daily_counts_by_subreddit(adapters.posts(spark, folder))
    return series.series_summary_by_group(daily, "post_count", "subreddit")


NETWORK_SQL = f"{INTERACTIONS_SQL}, {USERS_SQL}"


@query(f"""
with {NETWORK_SQL},
sized as (
  select *, min(engagement_score) over (partition by subreddit) low,
         max(engagement_score) over (partition by subreddit) high,
         row_number() over (partition by subreddit
                            order by engagement_score desc, "user") r
  from users),
top as (select * from sized where r <= 10)
select 'node' kind, subreddit, "user" user_a, null user_b, cast(null as bigint) weight,
       post_count, post_score, comment_score, round(engagement_score, 6) engagement_score,
       case when high = low then 30.0
            else round(20 + (engagement_score - low) / (high - low) * 25, 6) end node_size
from top
union all
select 'edge', subreddit, least(post_author, comment_author), greatest(post_author, comment_author),
       count(*), null, null, null, null, null
from interactions i
where post_author <> comment_author
  and exists (select 1 from top t where t.subreddit = i.subreddit and t."user" = i.post_author)
  and exists (select 1 from top t where t.subreddit = i.subreddit and t."user" = i.comment_author)
group by all
""")
def subreddit_interaction_network(spark, folder):
    both = network.subreddit_interaction_network(interactions(spark, folder))
    return both.withColumns(
        {c: F.round(c, 6) for c in ("engagement_score", "node_size")}
    )
