"""Run queries against their SQL: ``python tests/check_queries.py <sf_dir> [query ...]``."""

import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

import __spark_entry__ as entry_point  # noqa: E402
from oracle import connect, differences  # noqa: E402


def main(sf_dir: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry_point.queries(), entry_point.oracle_sql()
    bad = 0
    for name in names or queries:
        started = time.time()
        frame = queries[name](spark, sf_dir)
        if name in oracles:
            problems = differences(frame, connect(sf_dir), oracles[name])
        else:
            problems = [] if frame.count() else ["no rows"]
        bad += bool(problems)
        kind = "sql " if name in oracles else "rows"
        print(f"{name:24} {kind} {time.time() - started:6.2f}s {'ok' if not problems else problems}", flush=True)
    print(f"{len(names or queries)} queries, {bad} different")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
