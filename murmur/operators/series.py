"""Operators on grid-sized series: a row per hour, day or community.

The unpartitioned windows here run over such aggregated rows only, never over
posts or comments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmur.operators.engagement import first_peak


def peak_row(series: DataFrame, metric: str, key: str) -> DataFrame:
    """The row with the largest metric; the smallest key wins a tie. Nulls never win."""
    return (
        series.where(F.col(metric).isNotNull())
        .orderBy(F.col(metric).desc(), F.col(key).asc())
        .limit(1)
    )


def series_summary(series: DataFrame, value: str, time_col: str) -> DataFrame:
    """Total, mean, maximum, minimum and the first time of the maximum."""
    seconds = F.unix_timestamp(F.col(time_col).cast("timestamp"))
    return series.withColumn("_t", seconds).agg(
        F.sum(value).alias("total"),
        F.avg(value).alias("mean"),
        F.max(value).alias("maximum"),
        F.min(value).alias("minimum"),
        first_peak(value, "_t", time_col).alias("peak_time"),
    )


def series_summary_by_group(series: DataFrame, value: str, group: str) -> DataFrame:
    return series.groupBy(group).agg(
        F.sum(value).alias("total"),
        F.avg(value).alias("mean"),
        F.max(value).alias("maximum"),
        F.min(value).alias("minimum"),
    )


def cumulative_sentiment(daily: DataFrame) -> DataFrame:
    """Running total of the rounded daily means, exact to two digits at each step."""
    window = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select(
        "date",
        "avg_sentiment",
        F.sum(F.col("avg_sentiment").cast("decimal(10,2)"))
        .over(window)
        .cast("double")
        .alias("cumulative_sentiment"),
    )


def trend_first_last(series: DataFrame, value: str, time_col: str, days: int = 7) -> DataFrame:
    """Mean of the first and the last `days` rows and the change in percent.

    Fewer rows than `days` use them all; no row comes out for one row or none.
    """
    ordered = series.select(
        value,
        F.row_number().over(Window.orderBy(time_col)).alias("_up"),
        F.row_number().over(Window.orderBy(F.col(time_col).desc())).alias("_down"),
    )
    means = ordered.agg(
        F.count(F.lit(1)).alias("_n"),
        F.avg(F.when(F.col("_up") <= days, F.col(value))).alias("first_avg"),
        F.avg(F.when(F.col("_down") <= days, F.col(value))).alias("last_avg"),
    )
    change = (F.col("last_avg") - F.col("first_avg")) / F.nullif(F.col("first_avg"), F.lit(0.0))
    return means.where(F.col("_n") > 1).select(
        F.least(F.lit(days), F.col("_n")).cast("int").alias("days"),
        "first_avg",
        "last_avg",
        (change * 100).alias("percent_change"),
    )


def last_n_rows(series: DataFrame, n: int = 30, time_col: str = "date") -> DataFrame:
    """The latest `n` rows, oldest first. Rows, not calendar days."""
    return series.orderBy(F.col(time_col).desc()).limit(n).orderBy(time_col)
