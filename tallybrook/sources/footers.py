"""Schemas of stored files, read from their footers by tasks."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.schemas import CONTRACT

FOOTER_DDL = "path string, n_rows bigint, column string, type string"
#: Arrow's names of the stored types.
TYPE_NAMES = {"int64": "bigint", "int32": "int", "int16": "smallint", "int8": "tinyint", "bool": "boolean", "float": "float", "double": "double"}


def read_footers(spark: SparkSession, root: str, tasks: int | None = None) -> DataFrame:
    """``path, n_rows, column, type``: a row for every column of every parquet file below ``root``.

    Spark lists the files; tasks open each and read its footer only, so the work follows the number of
    files and not their size. File systems are those that Arrow knows (local and shared folders, HDFS,
    S3, GCS).
    """
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(root).select("path")
    )

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.fs as fs
        import pyarrow.parquet as pq

        for frame in frames:
            rows = []
            for path in frame["path"]:
                if path.startswith("file:"):
                    system, name = fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
                else:
                    system, name = fs.FileSystem.from_uri(quote(path, safe="/:@%"))
                with system.open_input_file(name) as file:
                    footer = pq.ParquetFile(file)
                    for field in footer.schema_arrow:
                        rows.append((path, footer.metadata.num_rows, field.name, TYPE_NAMES.get(str(field.type), str(field.type))))
            yield pd.DataFrame(rows, columns=["path", "n_rows", "column", "type"])

    spread = files.repartition(tasks) if tasks else files
    return spread.mapInPandas(read, FOOTER_DDL)


def schemas_by_file_set(footers: DataFrame, file_set: Column) -> DataFrame:
    """``file_set, column, type, n_files, n_rows``: what the files of every set hold."""
    return footers.groupBy(file_set.alias("file_set"), "column", "type").agg(F.count(F.lit(1)).alias("n_files"), F.sum("n_rows").alias("n_rows"))


def drift(footers: DataFrame, file_set: Column, expected: dict[str, str] | None = None) -> DataFrame:
    """``file_set, column, expected, found, issue, n_files, n_rows``: where file sets differ from the
    expected columns (by default the record's): ``missing``, ``unexpected`` or ``type``.

    A column that only some files of a set lack is missing in these files, and counted by them.
    """
    expected = {f.name: f.type for f in CONTRACT} if expected is None else expected
    files = footers.groupBy(file_set.alias("file_set"), "path").agg(
        F.max("n_rows").alias("n_rows"), F.map_from_arrays(F.collect_list("column"), F.collect_list("type")).alias("held")
    )
    wanted = F.map_from_arrays(F.array(*[F.lit(c) for c in expected]), F.array(*[F.lit(t) for t in expected.values()]))
    columns = F.array_distinct(F.concat(F.map_keys(wanted), F.map_keys("held")))
    each = files.select("file_set", "n_rows", "held", F.explode(columns).alias("column")).select(
        "file_set", "n_rows", "column", F.try_element_at(wanted, F.col("column")).alias("expected"), F.try_element_at("held", F.col("column")).alias("found")
    )
    issue = F.when(F.col("found").isNull(), "missing").when(F.col("expected").isNull(), "unexpected").when(F.col("found") != F.col("expected"), "type")
    return each.withColumn("issue", issue).where("issue IS NOT NULL").groupBy("file_set", "column", "expected", "found", "issue").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("n_rows").alias("n_rows")
    )
