"""Lake layout: event-time hour folders with raw JSON and processed parquet.

``<root>/run=R/batch_id=N/year=Y/month=MM/day=DD/hour=HH/part-*``. A run is one source read by one
job or one stream checkpoint, so no run can touch another's rows; within a run a repeated batch
replaces its own folder as a whole. The batch is the outermost folder that is written: one commit,
no work for each hour folder on the driver, and filters on the hour still prune.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybrook import fixed_values as fv
from tallybrook.functions.time import epoch_ts, in_epoch_range, now_seconds
from tallybrook.schemas import CONTRACT, HOUR_DDL, LAKE_DDL, RECORD_COLUMNS, RECORD_DDL
from tallybrook.session import shuffles_dropped

#: Writer options for text files: gzip at its fastest level, which takes a fraction of the default's time.
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
_RUN_NAME = re.compile(r"[A-Za-z0-9_.-]+")


def run_of(*origin: str) -> str:
    """A run name that follows from where the rows come from: the same origin, the same name."""
    return hashlib.sha256("\n".join(origin).encode()).hexdigest()[:24]


def claim_run(spark: SparkSession, lake_dir: str, run: str, origin: str) -> None:
    """Record which origin a run name stands for; refuse a name that stands for another one."""
    if not _RUN_NAME.fullmatch(run):
        raise ValueError(f"a run name is letters, digits, '_', '.' and '-': {run!r}")
    path = f"{lake_dir}/_runs/{run}"
    try:
        known = spark.read.text(path, wholetext=True).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        known = None
    if known is None:
        spark.range(1).select(F.lit(origin).alias("value")).coalesce(1).write.mode("overwrite").text(path)
    elif known.value.rstrip("\n") != origin:
        raise ValueError(f"run {run!r} holds rows of {known.value.strip()!r}, not of {origin!r}")


def with_event_time(
    df: DataFrame, field: str = "creation_date", fallback: Column | None = None
) -> DataFrame:
    """Add ``event_time`` from an epoch field; absent, null, non-numeric or beyond what a timestamp
    holds means ``fallback`` (epoch seconds, by default the processing time), so that one bad record
    never ends a run."""
    fallback = now_seconds() if fallback is None else fallback
    seconds = fallback
    if field in df.columns and isinstance(df.schema[field].dataType, T.NumericType):
        seconds = F.coalesce(in_epoch_range(F.col(field).cast("bigint")), fallback)
    return df.withColumn("event_time", epoch_ts(seconds))


def with_hour_partitions(df: DataFrame, ts: str = "event_time") -> DataFrame:
    """Add year, month, day and hour as strings, all but the year padded to two digits."""

    def padded(part: Column) -> Column:
        return F.lpad(part.cast("string"), 2, "0")

    return df.withColumns(
        {
            "year": F.year(ts).cast("string"),
            "month": padded(F.month(ts)),
            "day": padded(F.dayofmonth(ts)),
            "hour": padded(F.hour(ts)),
        }
    )


def hour_path() -> Column:
    """``year=Y/month=MM/day=DD/hour=HH`` of the partition columns."""
    return F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.col(c)) for c in fv.HOUR_COLUMNS])


def normalize_types(df: DataFrame) -> DataFrame:
    """The record columns in stored types."""
    return df.select(*[F.col(f.name).cast(f.type).alias(f.name) for f in CONTRACT])


def spread_by_hour(df: DataFrame) -> DataFrame:
    """Bring the rows of an hour together before writing, so a folder gets few files.

    A rebalance, not a repartition: adaptive execution splits an hour that is too large for one
    task and merges small ones.
    """
    return df.hint("rebalance", *fv.HOUR_COLUMNS)


def batch_path(path: str, run: str, batch_id: int) -> str:
    return f"{path}/run={run}/batch_id={batch_id}"


def _lake_writer(df: DataFrame):
    stored = [F.col(f.name).cast(f.type).alias(f.name) for f in CONTRACT]
    # Static even where a session asks for dynamic overwrite: the whole batch folder is replaced.
    return (
        df.select(*stored, *fv.HOUR_COLUMNS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*fv.HOUR_COLUMNS)
    )


def write_raw(df: DataFrame, path: str, run: str, batch_id: int = 0, gzip: bool = False) -> None:
    """One JSON line per record, nulls kept, non-ASCII as is; readers know ``gzip`` by the files' names."""
    writer = _lake_writer(df).option("ignoreNullFields", "false").options(**(GZIP if gzip else {}))
    with shuffles_dropped(df.sparkSession):
        writer.json(batch_path(path, run, batch_id))


def write_processed(df: DataFrame, path: str, run: str, batch_id: int = 0, compression: str = "snappy") -> None:
    """Parquet with the stored types, by default snappy; ``zstd`` files are a good third smaller where titles are
    long. Readers know either by its footer."""
    with shuffles_dropped(df.sparkSession):
        _lake_writer(df).option("compression", compression).parquet(batch_path(path, run, batch_id))


def write_dead_letters(df: DataFrame, path: str, run: str, batch_id: int = 0, gzip: bool = False) -> None:
    rows = df.select("reason", "error", "record", "original", "message_id", "attributes")
    writer = rows.write.mode("overwrite").option("ignoreNullFields", "false").options(**(GZIP if gzip else {}))
    with shuffles_dropped(df.sparkSession):
        writer.json(batch_path(path, run, batch_id))


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LAKE_DDL).json(path)


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LAKE_DDL).parquet(path)


def read_processed_batch(spark: SparkSession, path: str, run: str, batch_id: int) -> DataFrame:
    """The rows of one batch, with their hour columns."""
    return spark.read.schema(f"{RECORD_DDL}, {HOUR_DDL}").parquet(batch_path(path, run, batch_id))


def read_records(spark: SparkSession, *paths: str) -> DataFrame:
    """Only the record columns of parquet files below the given folders, whatever their layout."""
    reader = spark.read.schema(RECORD_DDL)
    return reader.option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.parquet"
    ).parquet(*paths).select(*RECORD_COLUMNS)
