"""User interaction networks.

`interactions` may be raw (`post_comment_interactions`) or merged
(`interaction_counts`); both give the same results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.functions.scalars import engagement_score, node_size
from murmur.operators.engagement import weight
from murmur.operators.joins import edges_between_top_users
from murmur.operators.ranking import concat_frames
from murmur.operators.skew import top_n_per_group


def post_author_stats(
    interactions: DataFrame, group: list[str] | None = None, distinct_posts: bool = False
) -> DataFrame:
    """Per post author: interaction rows and the votes summed over them.

    A post counts once per comment on it, unless `distinct_posts` is set.
    """
    group = group or []
    w = weight(interactions)
    if distinct_posts:
        interactions = interactions.select(
            *group, "post_id", "post_author", "post_score"
        ).distinct()
        w = F.lit(1)
    return interactions.groupBy(*group, F.col("post_author").alias("user")).agg(
        F.sum(w).cast("bigint").alias("post_count"),
        F.sum(F.col("post_score") * w).cast("bigint").alias("post_score"),
    )


def comment_author_stats(interactions: DataFrame, group: list[str] | None = None) -> DataFrame:
    return interactions.groupBy(*(group or []), F.col("comment_author").alias("user")).agg(
        F.sum("comment_score").alias("comment_score")
    )


def user_activity(interactions: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Post and comment statistics of every user in one pass.

    The same table as joining `post_author_stats` and `comment_author_stats`,
    but each interaction yields its two roles and one shuffle sums them.
    """
    group = group or []
    w = weight(interactions)
    posted = F.struct(
        F.col("post_author").alias("user"),
        w.cast("bigint").alias("post_count"),
        (F.col("post_score") * w).cast("bigint").alias("post_score"),
        F.lit(0.0).alias("comment_score"),
    )
    commented = F.struct(
        F.col("comment_author").alias("user"),
        F.lit(0).cast("bigint").alias("post_count"),
        F.lit(0).cast("bigint").alias("post_score"),
        F.coalesce(F.col("comment_score").cast("double"), F.lit(0.0)).alias("comment_score"),
    )
    roles = interactions.select(*group, F.inline(F.array(posted, commented)))
    return roles.groupBy(*group, "user").agg(
        *[
            F.coalesce(F.sum(c), F.lit(0)).alias(c)
            for c in ("post_count", "post_score", "comment_score")
        ]
    )


def with_engagement(users: DataFrame) -> DataFrame:
    return users.withColumn(
        "engagement_score",
        engagement_score(F.col("post_score"), F.col("comment_score"), F.col("post_count")),
    )


def interaction_edges(interactions: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Interactions per unordered pair of users; nobody pairs with themselves."""
    return (
        interactions.where(F.col("post_author") != F.col("comment_author"))
        .groupBy(
            *(group or []),
            F.least("post_author", "comment_author").alias("user_a"),
            F.greatest("post_author", "comment_author").alias("user_b"),
        )
        .agg(F.sum(weight(interactions)).cast("bigint").alias("weight"))
    )


def interaction_summary(edges: DataFrame) -> DataFrame:
    return edges.agg(
        F.coalesce(F.sum("weight"), F.lit(0)).alias("total_interactions"),
        F.coalesce(F.avg("weight"), F.lit(0.0)).alias("avg_interactions"),
    )


def subreddit_network_overview(interactions: DataFrame) -> DataFrame:
    """Distinct posts, comments and distinct users of each subreddit.

    Both distinct counts are two-step aggregations on (subreddit, value), so a
    subreddit with most of the rows is still counted by many tasks.
    """
    counted = interactions.groupBy("subreddit", "post_id").agg(
        F.sum(weight(interactions)).alias("_n")
    ).groupBy("subreddit").agg(
        F.count(F.lit(1)).alias("total_posts"),
        F.sum("_n").cast("bigint").alias("total_comments"),
    )
    users = (
        interactions.select(
            "subreddit", F.explode(F.array("post_author", "comment_author")).alias("user")
        )
        .distinct()
        .groupBy("subreddit")
        .agg(F.count("user").alias("active_users"))
    )
    return counted.join(users, "subreddit")


def scale_min_max(users: DataFrame, metric: str, group: list[str] | None = None) -> DataFrame:
    """Node size from 20 to 45 by min-max scaling; 30 where all values are equal.

    Bounds come from a partial aggregate: a scalar over the frame, or one row
    per group.
    """
    if group:
        bounds = users.groupBy(*group).agg(
            F.min(metric).alias("_low"), F.max(metric).alias("_high")
        )
        return users.join(bounds, group).withColumn(
            "node_size", node_size(F.col(metric), F.col("_low"), F.col("_high"))
        ).drop("_low", "_high")
    bounds = users.agg(
        F.struct(F.min(metric).alias("low"), F.max(metric).alias("high"))
    ).scalar()
    return users.withColumn(
        "node_size", node_size(F.col(metric), bounds["low"], bounds["high"])
    )


def network_nodes(interactions: DataFrame, n: int = 10) -> DataFrame:
    """Top users of every subreddit with their statistics and node size.

    Sizes are scaled over all users of the subreddit, as bounds are taken
    before the cut to `n`.
    """
    users = with_engagement(user_activity(interactions, ["subreddit"]))
    bounds = users.groupBy("subreddit").agg(
        F.min("engagement_score").alias("_low"), F.max("engagement_score").alias("_high")
    )
    top = top_n_per_group(
        users, ["subreddit"], [F.col("engagement_score").desc(), F.col("user").asc()], n
    )
    return top.join(bounds, "subreddit").withColumn(
        "node_size", node_size(F.col("engagement_score"), F.col("_low"), F.col("_high"))
    ).drop("_low", "_high")


def network_edges(interactions: DataFrame, nodes: DataFrame) -> DataFrame:
    """Weighted edges among the nodes of each subreddit. Pairs are merged before the joins."""
    edges = interaction_edges(interactions, ["subreddit"])
    return edges_between_top_users(edges, nodes, ("user_a", "user_b"), ["subreddit"])


def subreddit_interaction_network(
    interactions: DataFrame, n: int = 10, subreddit: str | None = None
) -> DataFrame:
    """Nodes and edges in one frame; `kind` tells them apart.

    One job for every subreddit, or only the one given.
    """
    if subreddit is not None:
        interactions = interactions.where(F.col("subreddit") == subreddit)
    nodes = network_nodes(interactions, n)
    edges = network_edges(interactions, nodes)
    return concat_frames(
        [
            nodes.withColumnRenamed("user", "user_a").withColumn("kind", F.lit("node")),
            edges.withColumn("kind", F.lit("edge")),
        ]
    )
