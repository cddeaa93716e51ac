"""What keeps the large runs' disk and memory small, seen on small frames and plans."""

import contextlib
import io
import json
import os

from pyspark.sql import functions as F

from tallybrook.operators import compact, load
from tallybrook.registry import QUERIES, derived, lake_queries
from tallybrook.schemas import RECORD_COLUMNS, RECORD_DDL
from tallybrook.sources import lake
from tallybrook.streaming.ingest import prepared_messages, read_messages


def explained(df):
    with contextlib.redirect_stdout(out := io.StringIO()):
        df.explain()
    return out.getvalue()


def rows_of_hours(spark, n):
    rows = spark.range(n).select(
        *[(F.col("id") * 3600 if c == "creation_date" else F.lit(None)).cast(t).alias(c) for c, t in (f.split() for f in RECORD_DDL.split(", ")) if c != "question_id"],
        F.col("id").alias("question_id"),
    )
    return lake.with_hour_partitions(lake.with_event_time(rows))


def test_raw_lines_may_be_compressed(spark, tmp_path):
    rows = rows_of_hours(spark, 3)
    lake.write_raw(rows, str(tmp_path / "plain"), "r")
    lake.write_raw(rows, str(tmp_path / "packed"), "r", gzip=True)
    assert not [*(tmp_path / "packed").rglob("*.json")] and [*(tmp_path / "packed").rglob("*.json.gz")]
    plain, packed = (sorted(map(str, lake.read_raw(spark, str(tmp_path / n)).collect())) for n in ("plain", "packed"))
    assert plain == packed and len(plain) == 3


def test_landed_files_are_compressed(spark, sf_dir):
    assert [f for f in os.listdir(derived.land_envelopes(spark, sf_dir).removeprefix("file:")) if f.endswith(".gz")]
    path = derived.land_item_pages(spark, sf_dir).removeprefix("file:")
    assert [f for f in os.listdir(path) if f.endswith(".gz")]
    pages = [json.loads(r.value)["items"] for r in spark.read.text(path).collect()]
    assert max(map(len, pages)) <= derived.PAGE_ITEMS and sum(map(len, pages)) == derived.versions(spark, sf_dir).count()


def test_records_get_tasks_by_their_number(spark, sf_dir, monkeypatch):
    assert "REPARTITION_BY_NUM" not in explained(derived.versions(spark, sf_dir))
    whole = derived.questions_raw(spark, sf_dir)
    monkeypatch.setattr(derived, "TASK_ROWS", 100)  # 1,000 events: more tasks than the session has cores
    spread = derived.questions_raw(spark, sf_dir)
    assert spread.rdd.getNumPartitions() == 11
    assert spread.exceptAll(whole).count() == whole.exceptAll(spread).count() == 0


def test_dedup_of_a_stream_moves_what_sinks_need(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1").write_text('{"message": {"data": "*bad", "messageId": "b"}}\n')
    stream = prepared_messages(read_messages(spark, str(tmp_path / "in")))
    assert set(stream.columns) == {"message_id", "outcome", "violations", "payload_error", "original", *RECORD_COLUMNS, "year", "month", "day", "hour"}
    analysed = stream._jdf.queryExecution().analyzed().toString()
    below_dedup = analysed[analysed.rindex("EventTimeWatermark") :].splitlines()
    # The first projection under the watermark's columns has neither payload nor the stored message's envelope.
    kept = next(line for line in below_dedup if "Project [message_id#" in line and "_slot" not in line and "_arrived" not in line)
    assert "payload#" not in kept and "CASE WHEN" in kept


def test_loaded_tables_are_zstd(spark, tmp_path):
    load.replace_batch(spark.range(3).toDF("a"), str(tmp_path / "table"), "r", 0)
    assert [*(tmp_path / "table").rglob("*.zstd.parquet")]
    load.replace_batch(spark.range(5).toDF("a"), str(tmp_path / "table"), "r", 0)
    assert spark.read.parquet(str(tmp_path / "table")).count() == 5


def test_compaction_finds_slots_without_a_shuffle_of_records(spark, tmp_path, monkeypatch):
    root, hinted = str(tmp_path / "processed"), []
    for batch_id in range(2):
        lake.write_processed(rows_of_hours(spark, 5), root, "r", batch_id)
    broadcast = compact.F.broadcast
    monkeypatch.setattr(compact.F, "broadcast", lambda df: hinted.append(df.columns) or broadcast(df))
    assert compact.compact(spark, root, "year=9999") == 2
    assert hinted == [["hour_folder", "first", "slots"]]
    assert compact.read_lake(spark, root).count() == 10


def test_files_of_large_lakes_are_zstd(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(lake_queries, "run_dir", lambda spark, name: str(tmp_path / name))
    for name, folder, n in (("write_processed", "lake", 1000), ("lake_two_sources", "sources", 1000), ("schema_drift_files", "drift", 4)):
        assert QUERIES[name](spark, sf_dir).count() == n
        files = [f.name for f in (tmp_path / folder).rglob("*.parquet") if f.is_file()]
        assert files and all(f.endswith(".zstd.parquet") for f in files)
