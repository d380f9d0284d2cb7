"""Reply trees and comment markers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.functions.deep_json import comments_of
from murmur.operators.skew import ROWS_PER_TASK, salted_join

# Spark's JSON parser takes 1,000 levels, and a level of replies is five of them. A payload
# with fewer replies than this is not too deep for it.
_DEEP = 100
_SCANNED = "array<struct<id:string,parent_id:string,body:string,start:int,end:int>>"
_REPLIES = r'"replies"\s*:\s*\{'
_CHILDREN = "$.replies.data.children"


def _text(node: Column, member: str) -> Column:
    return F.try_variant_get(node, f"$.{member}", "string")


def flatten_comment_tree(
    comments: DataFrame,
    payload_col: str = "payload",
    post_col: str = "post_id",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Nested comment JSON to one row per comment.

    A payload row is walked level by level inside its own task: an array holds
    the current level and each step replaces it with the children, until no
    level is left. The number of nodes with replies in the text bounds the
    number of steps, and steps past the deepest level do nothing. Payloads that are
    nested too deeply for Spark's JSON parser, about 200 levels of replies, are scanned
    with a stack instead (`murmur.functions.deep_json`). So trees of any depth come out
    whole without a shuffle or a loop on the driver.

    `position` orders the comments of a payload parent first, replies in order.
    A missing parent id becomes the post id, ``replies=""`` is a leaf, and
    children that are not comments (no body) are left out. `data` is the JSON of
    the comment with its replies (as it stands in the payload, where the parser cannot
    read it), so in a chain of n comments it is as long as n * n; leave it out where it
    is not needed. `keep` names columns of the input to carry along.
    """
    root = F.struct(
        F.try_parse_json(F.col(payload_col)).alias("node"),
        F.lit("000000000").alias("position"),
    )
    step = "array<struct<node:variant,position:string>>"
    levels = F.regexp_count(F.col(payload_col), F.lit(_REPLIES)) + 1

    def children(level: Column) -> Column:
        return F.flatten(
            F.transform(
                level,
                lambda parent: F.transform(
                    F.coalesce(
                        F.try_variant_get(parent["node"], _CHILDREN, "array<variant>"),
                        F.array().cast("array<variant>"),
                    ),
                    lambda child, i: F.struct(
                        F.try_variant_get(child, "$.data", "variant").alias("node"),
                        F.concat(
                            parent["position"], F.lit("."), F.lpad(i.cast("string"), 9, "0")
                        ).alias("position"),
                    ),
                ),
            )
        )

    start = F.struct(
        F.array(root).cast(step).alias("level"), F.array().cast(step).alias("seen")
    )
    walked = F.aggregate(
        F.sequence(F.lit(1), levels),
        start,
        lambda acc, _: F.when(F.size(acc["level"]) == 0, acc).otherwise(
            F.struct(
                children(acc["level"]).alias("level"),
                F.concat(acc["seen"], acc["level"]).alias("seen"),
            )
        ),
        lambda acc: acc["seen"],
    )
    nodes = comments.select(
        F.col(post_col).alias("post_id"), *keep, F.explode(walked).alias("_c")
    )
    node = F.col("_c.node")
    flat = nodes.select(
        _text(node, "id").alias("id"),
        "post_id",
        F.coalesce(_text(node, "parent_id"), F.col("post_id").cast("string")).alias("parent_id"),
        F.to_json(node).alias("data"),
        _text(node, "body").alias("comment_text"),
        F.col("_c.position").alias("position"),
        *keep,
    ).where(F.col("comment_text").isNotNull())
    return flat.unionByName(_scanned_comments(comments, payload_col, post_col, keep))


def _too_deep(payload: Column) -> Column:
    """Not read by the parser, though it may be JSON: with replies enough to be too deep."""
    return (F.regexp_count(payload, F.lit(_REPLIES)) > _DEEP) & F.try_parse_json(payload).isNull()


def _scan(payload: Column) -> Column:
    """The comments of a payload as `comments_of` gives them."""

    def run(payloads: pd.Series) -> pd.Series:
        return payloads.map(comments_of)

    return F.pandas_udf(run, _SCANNED)(payload)


def _scanned_comments(
    comments: DataFrame, payload_col: str, post_col: str, keep: tuple[str, ...]
) -> DataFrame:
    """`flatten_comment_tree` of the payloads that are too deep for the parser."""
    payload = F.col("_payload")
    deep = comments.where(_too_deep(F.col(payload_col))).select(
        F.col(post_col).alias("post_id"), *keep, F.col(payload_col).alias("_payload")
    )
    nodes = deep.withColumn("_found", _scan(payload)).select(
        "post_id", *keep, "_payload", F.posexplode("_found").alias("_at", "_c")
    )
    own = payload.substr(F.col("_c.start") + 1, F.col("_c.end") - F.col("_c.start"))
    return nodes.select(
        F.col("_c.id").alias("id"),
        "post_id",
        F.coalesce("_c.parent_id", F.col("post_id").cast("string")).alias("parent_id"),
        F.coalesce(F.to_json(F.try_parse_json(own)), own).alias("data"),
        F.col("_c.body").alias("comment_text"),
        F.lpad(F.col("_at").cast("string"), 9, "0").alias("position"),
        *keep,
    ).where(F.col("comment_text").isNotNull())


def unreadable_payloads(comments: DataFrame, payload_col: str = "payload") -> DataFrame:
    """Rows whose payload is not JSON; `flatten_comment_tree` has no rows for them."""
    payload = F.col(payload_col)
    broken = comments.where(payload.isNotNull() & F.try_parse_json(payload).isNull())
    return broken.where(~_too_deep(payload) | _scan(payload).isNull())


def new_comments_since(
    comments: DataFrame,
    state: DataFrame,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Comments ahead of the stored marker of their post, in arrival order `pos`.

    `state` has `post_id` and `last_comment_id`. Where the marker is not among
    the comments, or there is none, all are new.
    """
    stored = state.select("post_id", F.col("last_comment_id").alias("id"))
    reached = (
        comments.select("post_id", "id", "pos")
        .join(stored.where(F.col("id").isNotNull()), ["post_id", "id"])
        .groupBy("post_id")
        .agg(F.min("pos").alias("_stop"))
    )
    return (
        salted_join(comments, reached, ["post_id"], "left", rows_per_task, ["id"])
        .where(F.col("_stop").isNull() | (F.col("pos") < F.col("_stop")))
        .select(*comments.columns)
    )


def next_markers(new_comments: DataFrame, state: DataFrame) -> DataFrame:
    """Marker of each post after a crawl: the first new comment, else the stored one."""
    first = new_comments.groupBy("post_id").agg(
        F.min(F.struct("pos", "id"))["id"].alias("_first")
    )
    return state.join(first, "post_id", "full").select(
        "post_id", F.coalesce("_first", "last_comment_id").alias("last_comment_id")
    )
