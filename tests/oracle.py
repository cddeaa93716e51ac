"""Compare a query with its SQL: same columns, same types, same rows in any order."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
DUCK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "array<string>": "VARCHAR[]",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.12g}"
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(frame, connection, sql: str) -> list[str]:
    """Human-readable differences; empty when equal."""
    relation = connection.sql(sql)
    spark_types = {f.name: DUCK_TYPES[f.dataType.simpleString()] for f in frame.schema}
    duck_types = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    problems = []
    if spark_types != duck_types:
        problems.append(f"schema: {sorted(set(spark_types.items()) ^ set(duck_types.items()))}")
    ours = _rows(frame.columns, frame.collect())
    theirs = _rows(relation.columns, relation.fetchall())
    if not ours:
        problems.append("no rows")
    if len(ours) != len(theirs):
        problems.append(f"rows: {len(ours)} != {len(theirs)}")
    if ours != theirs:
        only = [r for r in ours if r not in set(theirs)][:2]
        other = [r for r in theirs if r not in set(ours)][:2]
        problems.append(f"values: {str(only)[:600]} vs {str(other)[:600]}")
    return problems
