"""Question records, items and envelopes derived from the whole ``events`` and ``documents`` tables.

Every event is one version of question ``event_id div 3``; its title is the whole text of document
``event_id mod (number of documents)``. Nulls, blanks, redeliveries and broken messages are set by
fixed residues of the ids, so Spark and the checking SQL derive the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.functions.time import to_epoch
from tallybrook.schemas import RECORD_COLUMNS
from tallybrook.session import run_dir, shuffles_dropped
from tallybrook.sources.lake import GZIP

PAGE_ITEMS = 100
#: Records that a task makes. Adaptive execution merges tasks by what their join reads, and the records are
#: many times larger, so where the work is more than a task for each core the number of tasks is given.
TASK_ROWS = 25_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks for work on whole records, by the rows that the files' footers tell."""
    return max(table(spark, sf_dir, name).count() for name in ("events", "documents")) // TASK_ROWS + 1


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, documents = table(spark, sf_dir, "events"), table(spark, sf_dir, "documents")
    n_documents = documents.agg(F.count("*").alias("n")).scalar()
    event = events.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.call_function("div", F.col("event_id"), F.lit(3)).alias("q"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        to_epoch(F.col("ts")).alias("ep"),
        F.pmod(F.col("event_id"), n_documents).alias("doc_id"),
    )
    # Both tables grow together, so neither is broadcast; a small text file in one row group would
    # otherwise also leave all later text work to a single task.
    n_tasks = _tasks(spark, sf_dir)
    if n_tasks > spark.sparkContext.defaultParallelism:
        event = event.repartition(n_tasks, "doc_id")
    return event.join(documents.select("doc_id", "text").hint("merge"), "doc_id")


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def _null_when(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id``, ``event_type`` and the 14 record columns, one row per event."""
    ep, q, k = F.col("ep"), F.col("q"), F.col("k")
    undated = q % 113 == 0
    error = F.col("event_type") == "error"
    return _versions(spark, sf_dir).select(
        "event_id",
        "event_type",
        _null_when(_every(97), q).alias("question_id"),
        F.when(_every(101), None)
        .when(_every(103), "   ")
        .when(_every(107), "???")
        .otherwise(F.col("text"))
        .alias("title"),
        F.concat(F.lit("https://q.example/"), F.col("event_id")).alias("link"),
        _null_when(undated, ep).alias("creation_date"),
        _null_when((k % 10 == 3) | undated, ep + k * 60).alias("last_activity_date"),
        F.col("event_type").isin("purchase", "signup").alias("is_answered"),
        _null_when(k == 7, F.floor(F.col("value") / 4) - 5).alias("score"),
        _null_when(k == 8, F.col("user_id") % 6).alias("answer_count"),
        _null_when(k == 9, F.floor(F.col("value") * 6)).alias("view_count"),
        _null_when(k % 4 == 0, F.lit("CC BY-SA 4.0")).alias("content_license"),
        F.when(error, ep + (k - 20) * 1800).alias("closed_date"),
        F.when(error, F.lit("Duplicate")).alias("closed_reason"),
        F.col("user_id").alias("owner_user_id"),
        F.concat(F.lit("user_"), F.col("user_id")).alias("owner_display_name"),
    )


def questions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loaded (bronze) table."""
    return versions(spark, sf_dir).select(*RECORD_COLUMNS)


def with_defaults(df: DataFrame) -> DataFrame:
    """The records as normalisation leaves them: absent counts 0, absent activity the creation date."""
    zero = F.lit(0).cast("bigint")
    return df.withColumns(
        {
            "last_activity_date": F.coalesce("last_activity_date", "creation_date"),
            **{c: F.coalesce(F.col(c), zero) for c in ("score", "answer_count", "view_count")},
        }
    )


def items_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, item_json``: nested items; nulls become absent keys."""
    flat = [c for c in RECORD_COLUMNS if not c.startswith("owner_")]
    owner = F.struct(
        F.col("owner_user_id").alias("user_id"), F.col("owner_display_name").alias("display_name")
    )
    item = F.struct(*flat, owner.alias("owner"), F.array("event_type").alias("tags"))
    return versions(spark, sf_dir).select("event_id", F.to_json(item).alias("item_json"))


def land_item_pages(spark: SparkSession, sf_dir: str) -> str:
    """Write the items as gzip page files of at most ``PAGE_ITEMS`` items, one page per line."""
    path = run_dir(spark, "item-pages")
    page = F.call_function("div", F.col("event_id"), F.lit(PAGE_ITEMS))
    # Grouped after the shuffle: lists do not shrink in the tasks before it, they only spill there.
    items = items_json(spark, sf_dir).withColumn("page", page)
    n_tasks = _tasks(spark, sf_dir)
    pages = (
        (items.repartition(n_tasks, "page") if n_tasks > spark.sparkContext.defaultParallelism else items.repartition("page"))
        .groupBy("page")
        .agg(F.concat_ws(",", F.collect_list("item_json")).alias("items"))
        .select(F.concat(F.lit('{"items":['), F.col("items"), F.lit("]}")).alias("value"))
    )
    with shuffles_dropped(spark):
        pages.write.options(**GZIP).text(path)
    return path


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, value``: one envelope per delivery; every 11th event is delivered twice."""
    record = with_defaults(versions(spark, sf_dir))
    payload = F.to_json(F.struct(*RECORD_COLUMNS))
    data = (
        F.when(_every(13), "")
        .when(_every(19), "*bad")
        .otherwise(F.replace(F.base64(payload.cast("binary")), F.lit("\r\n"), F.lit("")))
    )
    message = F.struct(
        data.alias("data"), _null_when(_every(23), F.col("event_id").cast("string")).alias("messageId")
    )
    body = F.when(_every(17), "junk").otherwise(F.to_json(F.struct(message.alias("message"))))
    deliveries = F.array_repeat(F.lit(1), F.when(_every(11), 2).otherwise(1))
    return record.select("event_id", body.alias("value"), F.explode(deliveries).alias("_")).drop("_")


def land_envelopes(spark: SparkSession, sf_dir: str) -> str:
    """Write the envelopes as gzip text files, one message per line."""
    path = run_dir(spark, "envelopes")
    with shuffles_dropped(spark):
        envelopes(spark, sf_dir).select("value").write.options(**GZIP).text(path)
    return path
