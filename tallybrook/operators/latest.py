"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.operators.membership import with_membership


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in the given order.

    ``order`` should end in a unique column, or the pick among ties changes between runs.
    Spark plans ``rank = 1`` as a group limit before and after the shuffle: each task sends at most
    one row per key, so a hot key costs one row per task instead of all its rows in one task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def without_outdated(df: DataFrame, keys: Sequence[str], order: Sequence[Column], version: Sequence[str]) -> DataFrame:
    """``df`` without nearly all rows that ``latest_by_key`` would drop: a step before it that spares wide rows the
    shuffle.

    The pick is made on the keys, the order's columns and ``version``, the columns that tell versions of a key
    apart; what it picks is broadcast as a bitmap. Every row that could be the first of its key stays, so
    ``latest_by_key`` gives the same rows after it. ``df`` is worked out twice, once without its wide columns.
    """
    picked = latest_by_key(df, keys, order).select(*keys, *version)
    return with_membership(df, picked, "_is_latest").filter("_is_latest").drop("_is_latest")


def latest_of_wide_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], version: Sequence[str]) -> DataFrame:
    """The rows of ``latest_by_key``, for rows too wide to be shuffled: what ``without_outdated`` leaves is the only
    row of its key nearly always, and then stays where it is. Keys that have more rows left are broadcast as a
    bitmap, and their rows are ranked as a whole."""
    kept = without_outdated(df, keys, order, version)
    several = kept.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").select(*keys)
    marked = with_membership(kept, several, "_several")
    ranked = latest_by_key(marked.filter("_several"), keys, order)
    return marked.filter(~F.col("_several")).unionByName(ranked).drop("_several")
