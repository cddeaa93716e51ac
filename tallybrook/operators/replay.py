"""Replay of dead letters: repaired records go through the contract again, each accepted once.

A replay writes what it accepts as drafts, then commits by creating the next entry of the lake's replay
log; only then its batch is moved to where readers look. A replay that dies before its commit has done
nothing; one that dies after it is completed by the next. Of two at once one commits, the other looks
again. Letters are never changed: one that is still broken stays a letter and may be replayed again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook import fixed_values as fv
from tallybrook.schemas import DEAD_LETTER_DDL, RECORD_COLUMNS, RECORD_DDL
from tallybrook.sources.commits import CommitLog, list_names, move_once
from tallybrook.sources.envelopes import STORED, decode_messages
from tallybrook.sources.lake import (
    batch_path,
    spread_by_hour,
    with_event_time,
    with_hour_partitions,
    write_processed,
    write_raw,
)

#: The run of replayed records in the lake, and what their message ids begin with.
REPLAY_RUN, REPLAY_PREFIX = "replay", "replay-"
ACCEPTED_DDL = "letter_id string, message_id string"
_MOST_TRIES = 100


def letter_id() -> Column:
    """The id of the message that became a letter, or a digest of what it held."""
    held = F.coalesce("original", "record", F.lit(""))
    return F.coalesce("message_id", F.concat(F.lit("letter-"), F.sha2(held, 256)))


def to_envelopes(letters: DataFrame, repair: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``letter_id, value``: envelopes of the repaired records, one per letter.

    ``repair`` gets the record columns, ``letter_id``, ``reason``, ``error`` and ``original`` and returns
    the rows to send with the record columns set right. Letters with no record (an undecodable payload)
    have null columns, so ``repair`` may fill them from ``original``.
    """
    once = letters.withColumn("letter_id", letter_id()).groupBy("letter_id").agg(
        F.min(F.struct("record", "original", "reason", "error")).alias("letter")
    )
    opened = once.select("letter_id", "letter.*").withColumn("fields", F.from_json("record", RECORD_DDL))
    repaired = repair(opened.select("letter_id", "reason", "error", "original", "fields.*"))
    data = F.base64(F.encode(F.to_json(F.struct(*RECORD_COLUMNS)), "UTF-8"))
    message = F.struct(
        F.replace(data, F.lit("\r\n"), F.lit("")).alias("data"),
        F.concat(F.lit(REPLAY_PREFIX), F.col("letter_id")).alias("messageId"),
        F.struct(F.col("letter_id").alias("replay_of")).alias("attributes"),
    )
    return repaired.select("letter_id", F.to_json(F.struct(message.alias("message"))).alias("value"))


def replay_log(spark: SparkSession, lake: str) -> CommitLog:
    return CommitLog(spark, f"{lake}/_replays/_commits")


def _draft(lake: str, entry: dict) -> str:
    return f"{lake}/_replays/{entry['draft']}"


def complete_replays(spark: SparkSession, lake: str) -> list[dict]:
    """Move the batches of committed replays to their places, if that is still to be done."""
    entries = replay_log(spark, lake).entries()
    for entry in entries:
        for kind in ("raw", "processed"):
            left = dict(list_names(spark, _draft(lake, entry), folders=True))
            if kind in left:
                target = batch_path(f"{lake}/{kind}", REPLAY_RUN, entry["number"])
                move_once(spark, batch_path(f"{_draft(lake, entry)}/{kind}", REPLAY_RUN, entry["number"]), target)
    return entries


def accepted_letters(spark: SparkSession, lake: str) -> DataFrame:
    """``letter_id, message_id`` of every letter that a replay has stored."""
    paths = [f"{_draft(lake, e)}/accepted" for e in replay_log(spark, lake).entries()]
    if not paths:
        return spark.createDataFrame([], ACCEPTED_DDL)
    return spark.read.schema(ACCEPTED_DDL).parquet(*paths)


def replay_letters(spark: SparkSession, lake: str, repair: Callable[[DataFrame], DataFrame], where: str = "true") -> int:
    """Replay the letters of a lake that hold ``where`` and were not accepted before; returns how many
    were accepted now."""
    for _ in range(_MOST_TRIES):
        number = len(complete_replays(spark, lake))
        letters = spark.read.schema(DEAD_LETTER_DDL).json(f"{lake}/dead_letters").where(where)
        known = accepted_letters(spark, lake).select("letter_id")
        waiting = to_envelopes(letters, repair).join(known, "letter_id", "left_anti")
        decoded = decode_messages(waiting)
        stored = decoded.where(F.col("outcome") == STORED)
        placed = with_hour_partitions(with_event_time(stored)).select("letter_id", "message_id", *RECORD_COLUMNS, *fv.HOUR_COLUMNS)
        entry = {"number": number, "draft": uuid.uuid4().hex}
        draft = _draft(lake, entry)
        placed.select("*").write.parquet(f"{draft}/_rows")
        rows = spark.read.schema(placed.schema).parquet(f"{draft}/_rows")
        count = rows.count()
        if not count:
            return 0
        rows.select("letter_id", "message_id").write.parquet(f"{draft}/accepted")
        write_raw(spread_by_hour(rows), f"{draft}/raw", REPLAY_RUN, number)
        write_processed(spread_by_hour(rows), f"{draft}/processed", REPLAY_RUN, number)
        if replay_log(spark, lake).commit(number, draft=entry["draft"], accepted=count):
            complete_replays(spark, lake)
            return count
    raise RuntimeError("other replays were faster every time")
