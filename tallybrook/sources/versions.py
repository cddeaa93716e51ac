"""Tables that are rebuilt as a whole: every rebuild is a version folder, a log says which one counts.

``<path>/version=V/...`` and ``<path>/_commits/N.json``. A rebuild that dies leaves a folder that no
entry names; readers keep seeing the version before. Readers that started on a version may finish, as
long as it is kept.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallybrook.sources.commits import CommitLog, list_names, remove

_MOST_TRIES = 100


def versions_log(spark: SparkSession, path: str) -> CommitLog:
    return CommitLog(spark, f"{path}/_commits")


def new_version_path(path: str) -> str:
    return f"{path}/version={uuid.uuid4().hex}"


def publish(spark: SparkSession, path: str, version_path: str, keep: int = 0) -> None:
    """Make a written version the current one, then remove others but for the ``keep`` current ones
    before it. Of two rebuilds at once the later publication counts."""
    log, name = versions_log(spark, path), version_path.rsplit("/", 1)[1]
    for _ in range(_MOST_TRIES):
        last = log.last()
        if log.commit(0 if last is None else last["number"] + 1, version=name, before=([last["version"], *last["before"]] if last else [])[: max(keep, 0)]):
            break
    else:
        raise RuntimeError("other rebuilds were faster every time")
    entry = log.last()
    if entry["version"] != name:
        return  # a later rebuild is current; it removes what is old
    replaced = set() if last is None else {last["version"], *last["before"]}
    for old in replaced - {name, *entry["before"]}:
        remove(spark, f"{path}/{old}")


def drop_unpublished(spark: SparkSession, path: str) -> list[str]:
    """Remove version folders that no entry has named, as rebuilds that died leave them. Not while a
    rebuild is running."""
    entries = versions_log(spark, path).entries()
    named = {e["version"] for e in entries}
    lost = [n for n, _ in list_names(spark, path, folders=True) if n.startswith("version=") and n not in named]
    for name in lost:
        remove(spark, f"{path}/{name}")
    return lost


def read_version(spark: SparkSession, path: str, schema: StructType | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """The current version; a path without a log is read as it is."""
    last = versions_log(spark, path).last()
    reader = spark.read if schema is None else spark.read.schema(schema)
    rows = reader.parquet(path if last is None else f"{path}/{last['version']}")
    return rows if columns is None else rows.select(*columns)
