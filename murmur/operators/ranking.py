"""Top-k, caps and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.operators.skew import top_n_per_group


def top_users(users: DataFrame, metric: str, user: str = "author", n: int = 10) -> DataFrame:
    return users.orderBy(F.col(metric).desc(), user).limit(n)


def top_users_per_subreddit(
    users: DataFrame,
    metric: str = "total_engagement_score",
    n: int = 5,
    subreddits: int = 10,
) -> DataFrame:
    """Top users of each of the top subreddits; `rank` starts at 1.

    The list of subreddits has at most `subreddits` rows.
    """
    leading = (
        users.groupBy("subreddit")
        .agg(F.sum(metric).alias("_total"))
        .orderBy(F.col("_total").desc(), "subreddit")
        .limit(subreddits)
        .select("subreddit")
    )
    chosen = users.join(F.broadcast(leading), "subreddit", "left_semi")
    return top_n_per_group(
        chosen, ["subreddit"], [F.col(metric).desc(), F.col("author").asc()], n, rank="rank"
    )


def most_common_terms(counts: DataFrame, n: int = 20) -> DataFrame:
    return counts.orderBy(F.col("occurrences").desc(), "term").limit(n)


def latest_posts(
    frame: DataFrame, n: int = 100, text_col: str = "cleaned_text", key: str = "post_id"
) -> DataFrame:
    """Newest rows with a text; the smaller key first at equal times."""
    return (
        frame.where(F.col(text_col).isNotNull())
        .orderBy(F.col("created").desc(), key)
        .limit(n)
    )


def cap_rows_per_group(
    frame: DataFrame, keys: list[str], order: list[Column], n: int, parts: int | None = None
) -> DataFrame:
    """At most `n` rows per parent in arrival order."""
    return top_n_per_group(frame, keys, order, n, parts or (16 if n > 100 else 1))


def active_users(interactions: DataFrame) -> DataFrame:
    """Everybody who posted or commented, once."""
    return interactions.select(
        F.explode(F.array("post_author", "comment_author")).alias("user")
    ).distinct()


def concat_frames(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
