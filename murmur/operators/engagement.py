"""Aggregations of activity, users, moderation, sentiment and terms."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.functions.fixed import AI_KEYWORDS, AI_PHRASES, BOT_AUTHORS
from murmur.functions.scalars import (
    day_bucket,
    day_name,
    day_order,
    epoch_to_ts,
    hour_bucket,
    json_field_or_default,
)
from murmur.functions.text import keyword_terms, sentiment_polarity, tokenize_words
from murmur.operators.filters import (
    exclude_bots,
    filter_date_between,
    filter_epoch_between,
    filter_non_empty_text,
    filter_root_posts,
    match_any_phrase,
)
from murmur.operators.joins import day_grid, posts_left_join_comments


def weight(frame: DataFrame) -> Column:
    """How many interactions a row stands for."""
    return F.col("n") if "n" in frame.columns else F.lit(1)


def date_range(frame: DataFrame, column: str = "created") -> DataFrame:
    return frame.agg(F.min(column).alias("min_date"), F.max(column).alias("max_date"))


# --- hourly and daily activity -------------------------------------------------


def hourly_engagement(posts: DataFrame, comments: DataFrame, start: int, end: int) -> DataFrame:
    """Posts, comments and mean comment score per hour and subreddit.

    Comments are reduced to one row per post before the join, so nothing fans
    out and the posts of an hour can be counted without a distinct.
    """
    chosen = filter_epoch_between(posts, start, end).select("post_id", "subreddit", "created")
    joined = posts_left_join_comments(chosen, comments)
    return joined.groupBy(hour_bucket(F.col("created")).alias("hour"), "subreddit").agg(
        F.count(F.lit(1)).alias("post_count"),
        F.sum("comment_count").alias("comment_count"),
        F.coalesce(
            F.sum("score_sum") / F.nullif(F.sum("score_count"), F.lit(0)), F.lit(0.0)
        ).alias("avg_comment_score"),
    )


def hourly_board_activity(chan_posts: DataFrame, start: int, end: int) -> DataFrame:
    return (
        filter_epoch_between(chan_posts, start, end)
        .groupBy(hour_bucket(F.col("created")).alias("hour"), "board")
        .agg(F.count(F.lit(1)).alias("post_count"), F.avg("replies").alias("avg_replies"))
    )


def hour_of_day_profile(hourly: DataFrame, metrics: list[str]) -> DataFrame:
    """Mean of the (hour, community) rows per hour of day; each row counts once."""
    return hourly.groupBy(F.hour("hour").alias("hour")).agg(
        *[F.avg(m).alias(m) for m in metrics]
    )


def weekday_profile(hourly: DataFrame, metrics: list[str]) -> DataFrame:
    """The same per weekday; `day_order` 0 is Monday."""
    return hourly.groupBy(
        day_order(F.col("hour")).alias("day_order"), day_name(F.col("hour")).alias("day")
    ).agg(*[F.avg(m).alias(m) for m in metrics])


def first_peak(metric: str, key: str, value: str | None = None) -> Column:
    """`value` (default `key`) of the row with the largest metric, smallest key on ties."""
    return F.max(
        F.struct(F.col(metric).alias("m"), (-F.col(key)).alias("k"), F.col(value or key).alias("v"))
    )["v"]


def engagement_summary(
    hours: DataFrame, days: DataFrame, metrics: tuple[str, str]
) -> DataFrame:
    """Peak hour and day and the mean of each profile, as one row.

    The two profiles are stacked and summarised by one aggregate.
    """

    def stacked(profile: DataFrame, unit: str, key: str, label: str) -> DataFrame:
        return profile.select(
            F.lit(unit).alias("unit"),
            F.col(key).alias("key"),
            F.col(label).cast("string").alias("label"),
            *metrics,
        )

    columns = []
    for unit in ("hour", "day"):
        here = F.col("unit") == unit
        for metric in metrics:
            row = F.struct(
                F.col(metric).alias("m"), (-F.col("key")).alias("k"), F.col("label").alias("v")
            )
            known = here & F.col(metric).isNotNull()
            peak = F.max(F.when(known, row))["v"]
            columns.append(
                peak.cast("int" if unit == "hour" else "string").alias(f"peak_{unit}_{metric}")
            )
            columns.append(F.avg(F.when(here, F.col(metric))).alias(f"avg_{unit}_{metric}"))
    return (
        stacked(hours, "hour", "hour", "hour")
        .unionByName(stacked(days, "day", "day_order", "day"))
        .agg(*columns)
    )


def _counts(frame: DataFrame, *keys) -> DataFrame:
    return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("post_count"))


def daily_counts(frame: DataFrame, roots_only: bool = False) -> DataFrame:
    chosen = filter_root_posts(frame) if roots_only else frame
    return _counts(chosen, day_bucket(F.col("created")).alias("date"))


def daily_counts_by_subreddit(posts: DataFrame) -> DataFrame:
    return _counts(posts, day_bucket(F.col("created")).alias("date"), "subreddit")


def hourly_counts(frame: DataFrame) -> DataFrame:
    return _counts(frame, hour_bucket(F.col("created")).alias("hour"))


def date_hour_counts(chan_posts: DataFrame) -> DataFrame:
    """Thread starters per date and hour of day."""
    roots = filter_root_posts(chan_posts)
    ts = epoch_to_ts(F.col("created"))
    return _counts(roots, F.to_date(ts).alias("date"), F.hour(ts).alias("hour"))


def root_hour_profile(counts: DataFrame) -> DataFrame:
    """Mean thread starters per hour of day, over the dates that have some in it.

    `counts` is `date_hour_counts`; `peak_row(profile, "post_count", "hour")` is its peak.
    """
    return counts.groupBy("hour").agg(F.avg("post_count").alias("post_count"))


def date_hour_pivot(counts: DataFrame) -> DataFrame:
    """Date by hour matrix with columns h00..h23, 0 where there is no post."""
    hours = counts.select("date", "post_count", F.format_string("h%02d", "hour").alias("_h"))
    names = [f"h{h:02d}" for h in range(24)]
    return hours.groupBy("date").pivot("_h", names).sum("post_count").na.fill(0, names)


# --- users ----------------------------------------------------------------------


def ai_user_engagement(
    posts: DataFrame,
    comments: DataFrame,
    start: int,
    end: int,
    phrases: list[str] = AI_PHRASES,
    text_cols: tuple[str, ...] = ("cleaned_title", "cleaned_text"),
    bots: list[str] = BOT_AUTHORS,
) -> DataFrame:
    """Per author and subreddit: posts on the topic, their votes and their comments."""
    chosen = exclude_bots(
        match_any_phrase(filter_epoch_between(posts, start, end), list(text_cols), phrases),
        ["author"],
        bots,
    ).select("post_id", "author", "subreddit", "votes")
    per_post = posts_left_join_comments(chosen, comments)
    return (
        per_post.groupBy("author", "subreddit")
        .agg(
            F.count(F.lit(1)).alias("post_count"),
            F.sum("votes").cast("bigint").alias("total_post_score"),
            F.sum("comment_count").alias("total_comments"),
            F.sum(F.coalesce("score_sum", F.lit(0.0))).alias("total_comment_score"),
        )
        .withColumn(
            "total_engagement_score", F.col("total_post_score") + F.col("total_comment_score")
        )
    )


def engagement_overview(users: DataFrame, by_subreddit: bool = False) -> DataFrame:
    """Users, posts, comments and mean engagement over all rows or per subreddit."""
    return users.groupBy(*(["subreddit"] if by_subreddit else [])).agg(
        F.countDistinct("author").alias("active_users"),
        F.sum("post_count").alias("total_posts"),
        F.sum("total_comments").alias("total_comments"),
        F.round(F.avg("total_engagement_score"), 2).alias("avg_engagement_score"),
    )


def author_totals(users: DataFrame) -> DataFrame:
    return users.groupBy("author").agg(
        *[
            F.sum(c).alias(c)
            for c in ("total_post_score", "total_comment_score", "total_engagement_score")
        ]
    )


def subreddit_totals(users: DataFrame) -> DataFrame:
    return (
        users.groupBy("subreddit")
        .agg(F.sum("total_engagement_score").alias("total_engagement_score"))
        .orderBy(F.col("total_engagement_score").desc(), "subreddit")
    )


def subreddit_post_counts(interactions: DataFrame) -> DataFrame:
    """Distinct posts per subreddit. The distinct spreads over (subreddit, post)."""
    return (
        interactions.groupBy("subreddit")
        .agg(F.countDistinct("post_id").alias("post_count"))
        .orderBy(F.col("post_count").desc(), "subreddit")
    )


# --- moderation -----------------------------------------------------------------


def daily_toxicity(frame: DataFrame) -> DataFrame:
    """Posts, mean score of flagged posts and flagged posts per date."""
    flagged = F.col("class") == "flag"
    return frame.groupBy(day_bucket(F.col("created")).alias("date")).agg(
        F.count(F.lit(1)).alias("post_count"),
        F.avg(F.when(flagged, F.col("mod_score"))).alias("avg_toxicity_score"),
        F.sum(F.when(flagged, 1).otherwise(0)).alias("toxic_posts_count"),
    )


def toxicity_summary(daily: DataFrame) -> DataFrame:
    return daily.agg(
        F.avg("avg_toxicity_score").alias("avg_daily_score"),
        F.max("avg_toxicity_score").alias("max_daily_score"),
        F.sum("toxic_posts_count").alias("total_toxic_posts"),
        (F.sum("toxic_posts_count") / F.sum("post_count") * 100).alias("toxic_percent"),
    )


# --- replies, votes, sentiment ----------------------------------------------------


def daily_avg_replies(comments: DataFrame, parent: str = "parent_id") -> DataFrame:
    """Mean number of replies per parent and date."""
    return (
        comments.groupBy(day_bucket(F.col("created")).alias("date"), parent)
        .agg(F.count(F.lit(1)).alias("reply_count"))
        .groupBy("date")
        .agg(F.avg("reply_count").alias("avg_replies"))
    )


def daily_avg_upvotes(posts: DataFrame) -> DataFrame:
    """Mean `ups` per date; absent or malformed is 0, posts without a time are left out."""
    return (
        posts.where(F.col("created").isNotNull())
        .groupBy(day_bucket(F.col("created")).alias("date"))
        .agg(F.avg(json_field_or_default(F.col("data"), "ups")).alias("avg_ups"))
    )


def daily_sentiment(
    frame: DataFrame,
    keys: list[str],
    text_col: str,
    lexicon: dict[str, float] | DataFrame,
    start: date,
    end: date,
) -> DataFrame:
    """Mean polarity and number of texts per day of the range, 0 on empty days.

    `keys` identify a text; `created` goes with it.
    """
    # The range goes first: texts outside it are neither read nor scored.
    inside = filter_date_between(frame, start, end)
    scored = sentiment_polarity(inside, [*keys, "created"], text_col, lexicon)
    daily = scored.groupBy(day_bucket(F.col("created")).alias("date")).agg(
        F.round(
            F.sum(F.col("polarity").cast("decimal(6,2)")).cast("double") / F.count(F.lit(1)), 2
        ).alias("avg_sentiment"),
        F.count(F.lit(1)).alias("post_count"),
    )
    return (
        day_grid(frame, start, end)
        .join(daily, "date", "left")
        .na.fill(0, ["avg_sentiment", "post_count"])
        .orderBy("date")
    )


# --- terms ------------------------------------------------------------------------


def _count_terms(terms: DataFrame) -> DataFrame:
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("occurrences"))


def term_counts(frame: DataFrame, text_col: str, keywords: list[str] = AI_KEYWORDS) -> DataFrame:
    texts = filter_non_empty_text(frame, text_col)
    return _count_terms(
        texts.select(F.explode(keyword_terms(F.col(text_col), keywords)).alias("term"))
    )


def records_with_terms(
    frame: DataFrame, text_col: str, keywords: list[str] = AI_KEYWORDS
) -> DataFrame:
    """Texts with at least one keyword, as a number and a percentage of non-empty texts."""
    has = F.size(keyword_terms(F.col(text_col), keywords)) > 0
    return (
        filter_non_empty_text(frame, text_col)
        .select(has.cast("bigint").alias("has"))
        .agg(
            F.coalesce(F.sum("has"), F.lit(0)).alias("records"),
            (F.avg("has") * 100).alias("percent"),
        )
    )


def word_frequencies(
    frame: DataFrame, text_col: str, group: tuple[str, ...] = ()
) -> DataFrame:
    """Words and how often they occur, in the whole or in each `group` (such as query_id)."""
    words = frame.select(*group, F.explode(tokenize_words(F.col(text_col))).alias("term"))
    return words.groupBy(*group, "term").agg(F.count(F.lit(1)).alias("occurrences"))
