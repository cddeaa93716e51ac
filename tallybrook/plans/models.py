"""Bronze, silver and gold: ``gold(silver(bronze(table)))`` is one logical plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallybrook.functions.metrics import engagement, pct_change, zero_if_null
from tallybrook.functions.text import clean_text, has_text
from tallybrook.functions.time import epoch_date, epoch_hour, epoch_ts, hours_between
from tallybrook.operators.latest import latest_by_key, latest_of_wide_rows
from tallybrook.operators.trends import daily, rolling_sum
from tallybrook.sources.versions import new_version_path, publish, read_version


def bronze(df: DataFrame, view: str | None = None) -> DataFrame:
    """All columns of the loaded table, as a view when named."""
    if view:
        df.createOrReplaceTempView(view)
    return df.select("*")


def version_order() -> list[Column]:
    """Latest activity first, then latest creation; the unique link settles ties."""
    return [
        F.coalesce("last_activity_date", "creation_date").desc(),
        F.col("creation_date").desc(),
        F.col("link").desc(),
    ]


def latest_versions(df: DataFrame, wide: bool = False) -> DataFrame:
    """The latest version of every question, null id included. ``wide`` is for plans that need the titles: it picks
    on narrow rows first, so that titles are not shuffled, and works ``df`` out more than once for it."""
    if wide:
        return latest_of_wide_rows(df, ["question_id"], version_order(), ["link"])
    return latest_by_key(df, ["question_id"], version_order())


def usable_latest(df: DataFrame, wide: bool = False) -> DataFrame:
    """Latest versions that have an id and a non-blank title.

    The title test applies to the latest version: a question whose latest title is blank disappears,
    older titles do not count. Its outcome is computed before the shuffle, so a plan that does not
    need the title sends one flag instead of the text. The null-id filter does move below the
    ranking, where it also takes the null group out of the shuffle.
    """
    latest = latest_versions(df.withColumn("_has_title", has_text(F.col("title"))), wide)
    return latest.filter(F.col("question_id").isNotNull() & F.col("_has_title")).drop("_has_title")


def silver_columns() -> list[Column]:
    """All outputs read the inputs, so they belong in one select: two outputs reuse an input's name."""
    created, active, closed = (F.col(c) for c in ("creation_date", "last_activity_date", "closed_date"))
    return [
        F.col("question_id"),
        clean_text(F.col("title")).alias("title_clean"),
        F.col("link"),
        epoch_ts(created).alias("created_ts"),
        epoch_date(created).alias("created_date"),
        epoch_ts(active).alias("last_activity_ts"),
        epoch_date(active).alias("last_activity_date"),
        epoch_ts(closed).alias("closed_ts"),
        epoch_date(closed).alias("closed_date"),
        closed.isNotNull().alias("is_closed"),
        F.col("is_answered"),
        zero_if_null(F.col("score")).alias("score_filled"),
        zero_if_null(F.col("answer_count")).alias("answer_count_filled"),
        zero_if_null(F.col("view_count")).alias("view_count_filled"),
        F.col("content_license"),
        F.col("closed_reason"),
        F.col("owner_user_id"),
        F.col("owner_display_name"),
        engagement(F.col("view_count"), F.col("answer_count"), F.col("score")).alias("sentiment"),
        hours_between(created, closed).alias("hours_to_close"),
    ]


def silver(df: DataFrame, wide: bool = False) -> DataFrame:
    """Latest usable version of every question, standardised; ``wide`` as in ``latest_versions``."""
    return usable_latest(df, wide).select(*silver_columns())


def gold(silver_df: DataFrame) -> DataFrame:
    """Daily figures per engagement label, with a 7-row rolling count and change from the day before."""
    series = Window.partitionBy("sentiment").orderBy("report_date")
    rolling = rolling_sum(
        daily(silver_df), "post_count", ["sentiment"], "report_date", "rolling_7d_post_count"
    )
    before = F.lag("post_count").over(series)
    return rolling.withColumn("day_over_day_change_pct", pct_change(F.col("post_count"), before))


def hourly(df: DataFrame) -> DataFrame:
    """Usable questions per UTC hour of creation and engagement label."""
    label = engagement(F.col("view_count"), F.col("answer_count"), F.col("score"))
    return (
        usable_latest(df)
        .groupBy(epoch_hour(F.col("creation_date")).alias("report_hour"), label.alias("sentiment"))
        .agg(F.count("*").alias("post_count"))
    )


def write_clustered(df: DataFrame, path: str, day: str, cluster: Sequence[str], keep: int = 0) -> None:
    """Rebuild a table partitioned by day and sorted by the cluster columns inside its files.

    The rebuild is written as a version of its own and published when it is complete, so one that dies
    leaves the table as it was; read it with ``read_model``. ``keep`` former versions stay for readers
    that began before.

    The rebalance gathers each day but lets adaptive execution split a day too large for one task;
    sorted files give row-group min/max skipping on the cluster columns.
    """
    version = new_version_path(path)
    (
        df.hint("rebalance", day)
        .sortWithinPartitions(day, *cluster)
        .write.mode("errorifexists")
        .option("compression", "zstd")
        .partitionBy(day)
        .parquet(version)
    )
    publish(df.sparkSession, path, version, keep)


def write_silver(df: DataFrame, path: str, keep: int = 0) -> None:
    write_clustered(df, path, "created_date", ["sentiment", "is_answered", "is_closed"], keep)


def write_gold(df: DataFrame, path: str, keep: int = 0) -> None:
    write_clustered(df, path, "report_date", ["sentiment"], keep)


def read_model(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The published silver or gold table."""
    return read_version(spark, path, schema, None if schema is None else schema.names)


def total_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total_rows"))


def latest_records(df: DataFrame, n: int = 10) -> DataFrame:
    """The newest records; ties by id, then link."""
    return (
        df.orderBy(F.desc("creation_date"), F.desc("question_id"), F.desc("link"))
        .limit(n)
        .select("question_id", "title", "creation_date")
    )
