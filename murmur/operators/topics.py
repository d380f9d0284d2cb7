"""Topics: which posts, comments and board posts belong to one."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.functions.fixed import (
    AI_BOARD,
    AI_BOARD_TEXTS,
    AI_SUBREDDITS,
    POLITICS_BOARD,
    POLITICS_SUBREDDITS,
)
from murmur.operators.filters import FEW_PHRASES, filter_in_list, phrase_match
from murmur.operators.joins import comments_of_topic

TopicFilter = Callable[[DataFrame, DataFrame | None], DataFrame]


def communities(names: list[str]) -> TopicFilter:
    return lambda frame, posts: filter_in_list(frame, "subreddit", names)


def comments_in(names: list[str]) -> TopicFilter:
    return lambda frame, posts: comments_of_topic(
        frame, filter_in_list(posts, "subreddit", names)
    )


def board(name: str, texts: list[str] | None = None) -> TopicFilter:
    def apply(frame: DataFrame, posts: DataFrame) -> DataFrame:
        out = frame.where(F.col("board") == name)
        if texts and len(texts) > FEW_PHRASES and not any("%" in t or "_" in t for t in texts):
            out = out.where(phrase_match(["cleaned_text"], [t.lower() for t in texts]))
        elif texts:
            out = out.where(
                reduce(or_, [F.col("cleaned_text").ilike(f"%{t}%") for t in texts])
            )
        return out

    return apply


TOPICS = {
    "Politics": {
        "posts": communities(POLITICS_SUBREDDITS),
        "comments": comments_in(POLITICS_SUBREDDITS),
        "chan_posts": board(POLITICS_BOARD),
    },
    "AI": {
        "posts": communities(AI_SUBREDDITS),
        "comments": comments_in(AI_SUBREDDITS),
        "chan_posts": board(AI_BOARD, AI_BOARD_TEXTS),
    },
}


def topic_filter(
    frame: DataFrame,
    topic: str,
    source: str,
    posts: DataFrame | None = None,
    topics: dict = TOPICS,
) -> DataFrame:
    """Rows of `source` (posts, comments, chan_posts) that belong to a topic.

    Comments belong to a topic through their post, so they need `posts`.
    """
    return topics[topic][source](frame, posts)
