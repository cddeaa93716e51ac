"""Daily counts as a stream: an optional extension of the daily aggregates.

State holds one number for each day and label that the watermark still lets change. A batch writes the
days that it changed, with their whole counts, under its own id; the latest batch of a day tells its
count, so a batch that is run again replaces what it wrote. Rows later than the watermark do not change
a day any more; they are the difference between what was offered and what is counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallybrook.functions.time import epoch_date, to_epoch
from tallybrook.sources.lake import batch_path
from tallybrook.streaming.ingest import adaptive_execution, stream_run

DAILY_DDL = "report_date date, sentiment string, post_count bigint, run string, batch_id bigint"
OFFERED = "offered"


def daily_counts(rows: DataFrame, late: str = "7 days") -> DataFrame:
    """``report_date, sentiment, post_count`` of a stream of silver rows, by event time.

    A row may be ``late`` behind the newest one. Rows without a creation time belong to no day and are
    left out. Counts are combined in tasks before the shuffle; a day with a third of all rows sends
    one number a task.
    """
    # A watermark needs an instant; going by epoch seconds keeps the session's zone out of it.
    created = F.timestamp_seconds(to_epoch(F.col("created_ts")))
    dated = rows.where("created_ts IS NOT NULL").select(created.alias("created_ts"), "sentiment")
    offered = dated.observe("daily", F.count(F.lit(1)).alias(OFFERED))
    counted = offered.withWatermark("created_ts", late).groupBy(F.window("created_ts", "1 day").alias("day"), "sentiment")
    return counted.agg(F.count(F.lit(1)).alias("post_count")).select(
        epoch_date(F.unix_seconds("day.start")).alias("report_date"), "sentiment", "post_count"
    )


def gathered(batch: DataFrame) -> DataFrame:
    """The counts that a batch changed, in one partition. A shuffle of these few rows, not a coalesce: that would
    leave the state of all partitions to a single task."""
    return batch.repartition(1)


def count_by_day(rows: DataFrame, table: str, checkpoint: str, late: str = "7 days", trigger: dict | None = None) -> StreamingQuery:
    """Start counting; by default everything available now, then stop."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        with adaptive_execution(batch.sparkSession):
            gathered(batch).write.mode("overwrite").parquet(batch_path(table, stream_run(batch), batch_id))

    return (
        daily_counts(rows, late)
        .writeStream.outputMode("update")
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_daily_counts(spark: SparkSession, table: str) -> DataFrame:
    """The count of every day and label, from the latest batch that changed it; streams add up."""
    latest = spark.read.schema(DAILY_DDL).parquet(table).groupBy("run", "report_date", "sentiment").agg(
        F.max_by("post_count", "batch_id").alias("post_count")
    )
    return latest.groupBy("report_date", "sentiment").agg(F.sum("post_count").alias("post_count"))


def late_rows(counters: DataFrame, daily: DataFrame) -> DataFrame:
    """``offered, counted, late``: one row; every row offered is counted in a day or was too late."""
    offered = counters.where(F.col("name") == OFFERED).agg(F.coalesce(F.sum("value"), F.lit(0)).alias("offered"))
    counted = daily.agg(F.coalesce(F.sum("post_count"), F.lit(0)).alias("counted"))
    return offered.join(counted).withColumn("late", F.col("offered") - F.col("counted"))
