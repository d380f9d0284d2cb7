"""Column functions: JSON members, numbers, time buckets, scores."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from murmur.functions.fixed import DAY_NAME_FORMAT, NUMBER_PATTERN


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, with the value worked out once however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def json_field(data: Column, name: str) -> Column:
    """Member of a JSON object as text; null if absent or the text is not JSON."""
    return F.get_json_object(data, f"$.{name}")


def numeric_coerce(text: Column) -> Column:
    """Text to double, null if it is not a plain decimal number."""
    number = F.regexp_extract(F.trim(text.cast("string")), NUMBER_PATTERN, 0)
    return number.try_cast("double")


def json_field_or_default(
    data: Column, name: str, default: float = 0, dtype: str = "double"
) -> Column:
    """Numeric member of a JSON object, `default` if absent, null, malformed or out of range."""
    return F.coalesce(
        numeric_coerce(json_field(data, name)).try_cast(dtype), F.lit(default).cast(dtype)
    )


def epoch_seconds(text: Column) -> Column:
    """Whole seconds of an epoch given as text such as ``1730419200.0``."""
    return F.floor(numeric_coerce(text)).cast("bigint")


def epoch_to_ts(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def hour_bucket(seconds: Column) -> Column:
    return F.date_trunc("hour", epoch_to_ts(seconds)).cast("timestamp_ntz")


def day_bucket(seconds: Column) -> Column:
    return F.to_date(epoch_to_ts(seconds))


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def day_name(ts: Column) -> Column:
    return F.date_format(ts, DAY_NAME_FORMAT)


def day_order(ts: Column) -> Column:
    """0 = Monday, the sort key that goes with `day_name`."""
    return F.weekday(ts)


def moderation_flag(label: Column, confidence: Column, threshold: float = 0.9) -> Column:
    return (label == "flag") & (confidence > F.lit(threshold))


def engagement_score(post_score: Column, comment_score: Column, post_count: Column) -> Column:
    """40 % post votes, 30 % comment score, 30 % of fifty points per post."""
    return (
        post_score.cast("double") * F.lit(0.4)
        + comment_score.cast("double") * F.lit(0.3)
        + post_count.cast("double") * F.lit(15.0)
    )


def node_size(value: Column, low: Column, high: Column) -> Column:
    """Linear size from 20 to 45 between `low` and `high`; 30 if they are equal."""
    return F.when(high == low, F.lit(30.0)).otherwise(
        F.lit(20.0) + (value - low) / F.nullif(high - low, F.lit(0.0)) * F.lit(25.0)
    )


def preview(document: Column, length: int = 200) -> Column:
    return F.concat(F.substring(document, 1, length), F.lit("..."))


def relevance(distance: Column) -> Column:
    return F.round(F.lit(1.0) - distance, 2)
