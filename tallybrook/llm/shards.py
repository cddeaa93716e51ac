"""Contiguous shards of nearly equal bytes, cut from global prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import stage

#: Bytes that a row takes besides its text.
ROW_OVERHEAD = 8
#: Rows that one range partition is meant to hold.
ROWS_PER_PART = 1 << 20


def row_size(text: Column) -> Column:
    """UTF-8 bytes of the text (a null text has none) plus the overhead of a row."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(ROW_OVERHEAD)


def assign_shards(keys: DataFrame, order: list[str], size: str, shards: int) -> DataFrame:
    """``keys`` with ``shard`` and ``slot`` (place in the shard, from 0) in the given order.

    The rows are range-partitioned by ``order`` and written once. Totals per partition, a few
    numbers each, become global offsets; a running sum inside a partition gives every row its bytes
    ``[from, to)`` of the whole, and the middle of those decides the shard. So a shard differs from
    an equal part by one row at most. A partition splits between equal keys too, because the row's
    place in the input ends the order: a key with a third of all rows is no hot spot.

    Ties and repeated rows follow that place; null keys come first; an empty table gives no rows.
    Extra columns are kept; names starting with ``_sh_`` are taken.
    """
    spark = keys.sparkSession
    ends = [F.col(f"`{name}`").asc_nulls_first() for name in order] + [F.col("_sh_row").asc()]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), keys.count() // ROWS_PER_PART + 1)
    placed = keys.withColumn("_sh_row", F.monotonically_increasing_id())
    placed = placed.repartitionByRange(parts, *ends).withColumn("_sh_part", F.spark_partition_id())
    placed = stage(placed, "shard-keys")

    totals = placed.groupBy("_sh_part").agg(F.sum(size).alias("_sh_bytes"), F.count(F.lit(1)).alias("_sh_rows"))
    totals = stage(totals, "shard-totals")  # a row for each partition
    before = Window.orderBy("_sh_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_sh_part",
        F.coalesce(F.sum("_sh_bytes").over(before), F.lit(0)).alias("_sh_bytes_before"),
        F.coalesce(F.sum("_sh_rows").over(before), F.lit(0)).alias("_sh_rows_before"),
        F.sum("_sh_bytes").over(Window.partitionBy()).alias("_sh_total"),
    )
    inside = Window.partitionBy("_sh_part").orderBy(*ends)
    summed = placed.select(
        "*",
        F.sum(size).over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias("_sh_sum"),
        F.row_number().over(inside).alias("_sh_number"),
    ).join(F.broadcast(offsets), "_sh_part")
    middle = 2 * (F.col("_sh_bytes_before") + F.col("_sh_sum")) - F.col(size)
    cut = F.expr(f"CAST(least({shards - 1}, _sh_middle * {shards} DIV (2 * _sh_total)) AS int)")
    sharded = summed.withColumn("_sh_middle", middle).select(
        *keys.columns, cut.alias("shard"), (F.col("_sh_rows_before") + F.col("_sh_number") - 1).alias("_sh_place")
    )
    sharded = stage(sharded, "shard-rows")
    first = sharded.groupBy("shard").agg(F.min("_sh_place").alias("_sh_first"))  # a row for each shard
    return sharded.join(F.broadcast(first), "shard").select(
        *keys.columns, "shard", (F.col("_sh_place") - F.col("_sh_first")).alias("slot")
    )


def shard_documents(documents: DataFrame, shards: int = 24) -> DataFrame:
    """Shard, slot, size and checksum of every document.

    The order is checksum, size, id: equal texts lie side by side, in one shard but for those that
    a target cuts. A null text counts as empty, its ``text_crc32`` is that of no bytes (0).
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    keys = documents.select(
        "doc_id", row_size(F.col("text")).alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32")
    )
    return assign_shards(keys, ["text_crc32", "size", "doc_id"], "size", shards)


def sharded_documents(documents: DataFrame, shards: int = 24) -> DataFrame:
    """Every document, whole, with its shard and slot, for writing one folder a shard
    (``partitionBy("shard")``); the same order and cuts as ``shard_documents``."""
    keyed = documents.withColumn("_sh_size", row_size(F.col("text"))).withColumn(
        "_sh_crc", F.crc32(F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8"))
    )
    return assign_shards(keyed, ["_sh_crc", "_sh_size", "doc_id"], "_sh_size", shards).drop("_sh_size", "_sh_crc")
