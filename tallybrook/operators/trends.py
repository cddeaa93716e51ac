"""Daily and hourly aggregates and the windows over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.functions.metrics import pct_change


def daily(silver_df: DataFrame) -> DataFrame:
    """One row per day and engagement label."""
    return silver_df.groupBy(F.col("created_date").alias("report_date"), "sentiment").agg(
        F.count("*").alias("post_count"),
        F.avg("score_filled").alias("avg_score"),
        F.avg("view_count_filled").alias("avg_views"),
        F.avg("answer_count_filled").alias("avg_answers"),
        F.avg(F.col("is_answered").cast("bigint")).alias("answered_rate"),
        F.avg(F.col("is_closed").cast("bigint")).alias("closed_rate"),
        F.avg("hours_to_close").alias("avg_hours_to_close"),
    )


def rolling_sum(
    df: DataFrame, value: str, by: Sequence[str], order: str, name: str, rows: int = 6
) -> DataFrame:
    """Sum over the current and the ``rows`` preceding rows (not days) of each series.

    Meant for aggregated series: a series is one window partition.
    """
    window = Window.partitionBy(*by).orderBy(order).rowsBetween(-rows, Window.currentRow)
    return df.withColumn(name, F.sum(value).over(window))


def rolling_sum_of_days(
    df: DataFrame, value: str, by: Sequence[str], day: str, name: str, days: int = 6
) -> DataFrame:
    """Sum over the day of the row and the ``days`` before it in the calendar, whichever of them are
    present; rows without a day are summed among themselves. An optional extension: ``rolling_sum``
    counts rows.

    A RANGE frame on the day's number: no missing day is made up, and a row's own day counts with all
    of its rows.
    """
    window = Window.partitionBy(*by).orderBy(F.unix_date(day)).rangeBetween(-days, Window.currentRow)
    return df.withColumn(name, F.sum(value).over(window))


def previous(df: DataFrame, value: str, by: Sequence[str], order: str, name: str) -> DataFrame:
    """The value of the previous row present in each series."""
    return df.withColumn(name, F.lag(value).over(Window.partitionBy(*by).orderBy(order)))


def change_from_previous(
    df: DataFrame, value: str, by: Sequence[str], order: str, name: str
) -> DataFrame:
    """Percent change against the previous row present in each series."""
    with_previous = previous(df, value, by, order, "_previous")
    return with_previous.withColumn(name, pct_change(F.col(value), F.col("_previous"))).drop("_previous")


def rank_within(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Add ``rank`` and ``dense_rank`` by descending value."""
    window = Window.partitionBy(*by).orderBy(F.col(value).desc())
    return df.withColumns({"rank": F.rank().over(window), "dense_rank": F.dense_rank().over(window)})
