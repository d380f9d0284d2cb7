"""Row filters over typed post and comment columns."""

from __future__ import annotations

import sys
import types
from datetime import date
from functools import reduce
from operator import or_

import ahocorasick
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.functions.fixed import AI_PHRASES, BOT_AUTHORS

# Task functions travel with their code, so executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def filter_epoch_between(frame: DataFrame, start: int, end: int, column: str = "created") -> DataFrame:
    """Both ends included. On a stored column this reaches the parquet scan."""
    return frame.where(F.col(column).between(start, end))


def filter_date_between(
    frame: DataFrame, start: date, end: date, column: str = "created"
) -> DataFrame:
    """Whole days, both included, written as an epoch range so that it can be pushed down."""
    first = F.unix_timestamp(F.lit(start).cast("timestamp"))
    after = F.unix_timestamp(F.date_add(F.lit(end), 1).cast("timestamp"))
    return frame.where((F.col(column) >= first) & (F.col(column) < after))


def filter_last_n_days(
    frame: DataFrame, days: int, as_of: int, column: str = "created"
) -> DataFrame:
    return frame.where(F.col(column) >= as_of - days * 86400)


# Up to so many phrases each is looked for on its own, which stays in the JVM.
FEW_PHRASES = 50


def phrase_match(columns: list[str], phrases: list[str] = AI_PHRASES) -> Column:
    """Any phrase is a substring of any lower-cased column; null text never matches.

    Of more than FEW_PHRASES one automaton is made in each worker, which looks at every
    character once however many phrases there are.
    """
    if not phrases:
        return F.lit(False)
    if len(phrases) > FEW_PHRASES:
        found = any_phrase_finder(phrases)
        return reduce(or_, [F.coalesce(found(F.lower(F.col(c))), F.lit(False)) for c in columns])
    hits = [
        F.coalesce(F.contains(F.lower(F.col(c)), F.lit(p)), F.lit(False))
        for c in columns
        for p in phrases
    ]
    return reduce(or_, hits)


def any_phrase_finder(phrases: list[str]):
    """Column function: whether a text holds one of the phrases; null for null."""
    wanted = sorted(set(phrases))
    name = hash(tuple(wanted))

    def run(texts: pd.Series) -> pd.Series:
        automaton = _automaton(name, wanted)
        if automaton is None:  # every text holds the empty phrase
            return texts.notna()
        return texts.map(lambda t: None if t is None else next(automaton.iter(t), None) is not None)

    return F.pandas_udf(run, "boolean")


def _automaton(name: int, phrases: list[str]):
    """Made once in a worker, which keeps the last one."""
    held = sys.modules.setdefault("_murmur_phrases", types.ModuleType("_murmur_phrases")).__dict__
    if held.get("name") != (name, len(phrases)) or held.get("phrases") != phrases:
        automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for phrase in phrases:
            if phrase:
                automaton.add_word(phrase)
        automaton.make_automaton()
        held.update(name=(name, len(phrases)), phrases=phrases, automaton=None if "" in phrases else automaton)
    return held["automaton"]


def match_any_phrase(
    frame: DataFrame, columns: list[str], phrases: list[str] = AI_PHRASES
) -> DataFrame:
    return frame.where(phrase_match(columns, phrases))


def exclude_bots(
    frame: DataFrame, columns: list[str], bots: list[str] = BOT_AUTHORS
) -> DataFrame:
    """Drops listed authors and rows without an author."""
    return reduce(lambda df, c: df.where(~F.col(c).isin(bots)), columns, frame)


def filter_in_list(frame: DataFrame, column: str, values: list[str]) -> DataFrame:
    return frame.where(F.col(column).isin(values))


def filter_root_posts(frame: DataFrame) -> DataFrame:
    return frame.where(F.col("resto") == 0)


def filter_non_empty_text(frame: DataFrame, column: str) -> DataFrame:
    return frame.where(F.col(column).isNotNull() & (F.col(column) != ""))


def stale_posts(
    posts: DataFrame,
    subreddit: str,
    as_of: int,
    max_age_days: int = 7,
    refresh_hours: int = 6,
) -> DataFrame:
    """Posts due for a comment refresh, newest first.

    `last_comment_update` is an epoch; null means never refreshed.
    """
    return posts.where(
        (F.col("subreddit") == subreddit)
        & (F.col("created") > as_of - max_age_days * 86400)
        & (
            F.col("last_comment_update").isNull()
            | (F.col("last_comment_update") < as_of - refresh_hours * 3600)
        )
    ).orderBy(F.col("created").desc(), "post_id")
