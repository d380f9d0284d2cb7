"""Joins of posts, comments, calendars and user statistics."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.operators.filters import exclude_bots
from murmur.operators.skew import ROWS_PER_TASK, hot_keys, salted_join
from murmur.functions.fixed import BOT_AUTHORS


def comment_totals(comments: DataFrame) -> DataFrame:
    """One row per post: comments, their score sum, and how many had a score.

    Partial aggregation before the shuffle bounds a hot post to one row per task.
    """
    return comments.groupBy("post_id").agg(
        F.count("id").alias("comment_count"),
        F.sum("mod_score").alias("score_sum"),
        F.count("mod_score").alias("score_count"),
    )


def posts_left_join_comments(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Every post with its comment totals; zero and null scores where it has none."""
    return posts.join(comment_totals(comments), "post_id", "left").withColumns(
        {
            "comment_count": F.coalesce("comment_count", F.lit(0)),
            "score_count": F.coalesce("score_count", F.lit(0)),
        }
    )


def _network_posts(posts: DataFrame, bots: list[str]) -> DataFrame:
    return exclude_bots(posts, ["author"], bots).select(
        "post_id",
        "subreddit",
        F.col("author").alias("post_author"),
        F.col("votes").alias("post_score"),
    )


def post_comment_interactions(
    posts: DataFrame,
    comments: DataFrame,
    bots: list[str] = BOT_AUTHORS,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """One row per comment on the given posts, with both authors; bots left out.

    `posts` are already filtered by date and phrase. Row for row, so comments of
    a hot post are split over tasks.
    """
    said = exclude_bots(comments, ["author"], bots).select(
        "post_id",
        "id",
        F.col("author").alias("comment_author"),
        F.col("mod_score").alias("comment_score"),
    )
    return salted_join(
        said, _network_posts(posts, bots), ["post_id"], "inner", rows_per_task, ["id"]
    ).select(
        "post_id", "subreddit", "post_author", "post_score", "comment_author", "comment_score"
    )


def interaction_counts(
    posts: DataFrame,
    comments: DataFrame,
    bots: list[str] = BOT_AUTHORS,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """`post_comment_interactions` with equal (post, comment author) rows merged.

    `n` is the number of merged rows and `comment_score` their sum. The network
    operators take this form: comments shrink before they meet the posts.
    """
    human = exclude_bots(comments, ["author"], bots)
    said = human.groupBy("post_id", F.col("author").alias("comment_author")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("mod_score").alias("comment_score")
    )
    authors = _network_posts(posts, bots)
    hot = hot_keys(human, ["post_id"], rows_per_task, ["id"])
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    said = said.join(hot, "post_id", "left").withColumn(
        "_salt", F.pmod(F.xxhash64("comment_author"), parts.cast("bigint")).cast("int")
    )
    authors = authors.join(hot, "post_id", "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), parts - 1))
    )
    return said.drop("_parts").join(authors.drop("_parts"), ["post_id", "_salt"]).select(
        "post_id",
        "subreddit",
        "post_author",
        "post_score",
        "comment_author",
        "comment_score",
        "n",
    )


def comments_of_topic(
    comments: DataFrame, topic_posts: DataFrame, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Comments whose post is among `topic_posts`."""
    wanted = topic_posts.select("post_id").distinct()
    return salted_join(comments, wanted, ["post_id"], "left_semi", rows_per_task, ["id"]).select(
        *comments.columns
    )


def dead_threads(previous: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of the previous snapshot that the current one lacks."""
    return previous.select(*keys).distinct().join(
        current.select(*keys).distinct(), keys, "left_anti"
    )


def _grid(frame: DataFrame, start, end, step: str, name: str) -> DataFrame:
    return frame.sparkSession.range(1).select(
        F.explode(F.sequence(start, end, F.expr(step))).alias(name)
    )


def hour_grid(frame: DataFrame, start: date, end: date, name: str = "hour") -> DataFrame:
    """Every hour from the first midnight to the midnight after the last day, included."""
    first = F.lit(start).cast("timestamp_ntz")
    last = F.date_add(F.lit(end), 1).cast("timestamp_ntz")
    return _grid(frame, first, last, "interval 1 hour", name)


def day_grid(frame: DataFrame, start: date, end: date, name: str = "date") -> DataFrame:
    return _grid(frame, F.lit(start), F.lit(end), "interval 1 day", name)


def gap_fill_hours(
    counts: DataFrame, start: date, end: date, time_col: str = "hour", value_cols=("post_count",)
) -> DataFrame:
    """Counts on the full hour grid, 0 where there is none."""
    grid = hour_grid(counts, start, end, time_col)
    return grid.join(counts, time_col, "left").na.fill(0, list(value_cols)).orderBy(time_col)


def gap_fill_days(
    counts: DataFrame, start: date, end: date, time_col: str = "date", value_cols=("post_count",)
) -> DataFrame:
    grid = day_grid(counts, start, end, time_col)
    return grid.join(counts, time_col, "left").na.fill(0, list(value_cols)).orderBy(time_col)


def user_stats_outer(post_stats: DataFrame, comment_stats: DataFrame) -> DataFrame:
    """Post and comment statistics side by side, 0 where a user has only one kind."""
    return post_stats.join(comment_stats, "user", "full").na.fill(
        0, ["post_count", "post_score", "comment_score"]
    )


def edges_between_top_users(
    edges: DataFrame, top: DataFrame, ends: tuple[str, str], group: list[str] | None = None
) -> DataFrame:
    """Rows with both ends among the top users (of the same group)."""
    group = group or []
    for end in ends:
        wanted = top.select(*group, F.col("user").alias(end))
        edges = edges.join(wanted, [*group, end], "left_semi")
    return edges
