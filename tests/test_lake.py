"""Lake layout, incremental load, streaming."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tallybrook.operators import load
from tallybrook.operators.once import with_columns_once
from tallybrook.schemas import RECORD_COLUMNS, RECORD_DDL
from tallybrook.session import run_dir, shared_dir
from tallybrook.sources import lake
from tallybrook.streaming.ingest import drop_redelivered, ingest, read_messages
from tallybrook.streaming.load import load_new_files
from test_ingest import RECORD, envelope


def records(spark, *values):
    rows = []
    for value in values:
        row = dict.fromkeys(RECORD_COLUMNS)
        row.update({**RECORD, **value})
        rows.append(tuple(row[c] for c in RECORD_COLUMNS))
    return spark.createDataFrame(rows, RECORD_DDL)


def placed(spark, *values):
    return lake.with_hour_partitions(lake.with_event_time(records(spark, *values)))


def folder(path):
    return path[path.index("year="):]


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert run_dir(spark, "x") != run_dir(spark, "x")


def test_hour_path(spark):
    df = placed(spark, {"creation_date": 1736398800})
    assert df.select(lake.hour_path()).first()[0] == "year=2025/month=01/day=09/hour=05"


def test_event_time_fallbacks(spark):
    df = spark.createDataFrame([(None, "5", 7.9)], "a bigint, b string, c double")
    fixed = F.lit(100).cast("bigint")

    def event_time(field):
        return lake.with_event_time(df, field, fixed).first().event_time

    fallback = dt.datetime(1970, 1, 1, 0, 1, 40)
    assert [event_time(f) for f in ("a", "b", "nowhere")] == [fallback] * 3
    assert event_time("c") == dt.datetime(1970, 1, 1, 0, 0, 7)
    recent = lake.with_event_time(df, "a").first().event_time
    assert abs((dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - recent).total_seconds()) < 600


def test_raw_lines_keep_nulls_and_characters(spark, tmp_path):
    lake.write_raw(placed(spark, {"title": "čaj"}), str(tmp_path / "raw"), "r")
    files = [p for p in (tmp_path / "raw").rglob("*.json")]
    line = files[0].read_text(encoding="utf-8")
    assert "čaj" in line and json.loads(line)["closed_date"] is None
    assert list(json.loads(line)) == RECORD_COLUMNS


def test_rewriting_a_batch_replaces_it(spark, tmp_path):
    path = str(tmp_path / "processed")
    for batch_id in (0, 1, 1):
        lake.write_processed(placed(spark, {"question_id": 1}, {"question_id": 2}), path, "r", batch_id)
    back = lake.read_processed(spark, path)
    assert back.count() == 4
    assert {r.hour for r in back.collect()} == {"00"}
    assert [p for p in (tmp_path / "processed").rglob("*.snappy.parquet")]


def test_hot_hour_is_split(spark, tmp_path):
    path = str(tmp_path / "processed")
    rows = spark.range(60_000).select(
        *[F.lit(None).cast("string").alias(c) if c == "title" else F.lit(RECORD.get(c)).alias(c) for c in RECORD_COLUMNS if c != "link"],
        F.concat_ws("-", F.sha2(F.col("id").cast("string"), 256), F.sha2(F.col("id").cast("string"), 512)).alias("link"),
    )
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2m",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1m",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        hours = lake.with_hour_partitions(lake.with_event_time(rows))
        lake.write_processed(lake.spread_by_hour(hours), path, "r")
    finally:
        for key in settings:
            spark.conf.unset(key)
    files = [p for p in (tmp_path / "processed").rglob("*.parquet")]
    assert len(files) > 1  # one hour, several tasks
    assert lake.read_processed(spark, path).count() == 60_000


def test_folder_load_skips_loaded_hours_and_file_load_does_not(spark, tmp_path):
    root = str(tmp_path / "processed")
    by_folder, by_file = str(tmp_path / "by_folder"), str(tmp_path / "by_file")
    manifest, checkpoint = str(tmp_path / "manifest"), str(tmp_path / "checkpoint")

    def load_both():
        found = load.load_new_folders(spark, root, by_folder, manifest)
        load_new_files(spark, root, by_file, checkpoint).awaitTermination()
        return [folder(f) for f in found], [
            sorted(r.question_id for r in load.read_table(spark, t).collect()) for t in (by_folder, by_file)
        ]

    lake.write_processed(placed(spark, {"question_id": 1}, {"question_id": 2, "creation_date": 4000}), root, "r", 0)
    first = ["year=1970/month=01/day=01/hour=00", "year=1970/month=01/day=01/hour=01"]
    assert load_both() == (first, [[1, 2], [1, 2]])
    assert load_both() == ([], [[1, 2], [1, 2]])
    lake.write_processed(placed(spark, {"question_id": 3}, {"question_id": 4, "creation_date": 8000}), root, "r", 1)
    assert load_both() == (["year=1970/month=01/day=01/hour=02"], [[1, 2, 4], [1, 2, 3, 4]])
    assert load.read_manifest(spark, manifest).count() == 3


def test_folders_in_the_other_layout(spark, tmp_path):
    """Hour folders that end in a kind folder, one file per message."""
    hour = tmp_path / "year=2025" / "month=12" / "day=16" / "hour=15"
    records(spark, {"question_id": 8}).coalesce(1).write.parquet(str(hour / "processed"))
    (hour / "raw").mkdir()
    (hour / "raw" / "part-1.parquet").write_bytes(b"not processed")
    found = [folder(r.folder) for r in load.list_hour_folders(spark, str(tmp_path)).collect()]
    assert found == ["year=2025/month=12/day=16/hour=15/processed"]
    table, manifest = str(tmp_path / "t"), str(tmp_path / "m")
    assert len(load.load_new_folders(spark, str(tmp_path), table, manifest)) == 1
    assert [r.question_id for r in load.read_table(spark, table).collect()] == [8]


def test_crash_before_the_manifest_is_repaired(spark, tmp_path):
    root, table, manifest = (str(tmp_path / n) for n in ("processed", "table", "manifest"))
    lake.write_processed(placed(spark, {"question_id": 1}), root, "r", 0)
    # The data of batch 0 was written, the manifest was not.
    load.replace_batch(lake.read_records(spark, root), table, load.FOLDER_RUN, 0)
    load.load_new_folders(spark, root, table, manifest)
    assert load.read_table(spark, table).count() == 1


def test_state_file_without_folders(spark, tmp_path):
    (tmp_path / "old.json").write_text(json.dumps({"last_loaded_ts": 5}))
    (tmp_path / "new.json").write_text(json.dumps({"loaded_hour_folders": ["a", "b"]}, indent=2))
    assert load.read_folder_list(spark, str(tmp_path / "old.json")).count() == 0
    assert load.read_folder_list(spark, str(tmp_path / "new.json")).count() == 2
    assert load.read_manifest(spark, str(tmp_path / "nowhere")).count() == 0
    assert load.read_folder_list(spark, str(tmp_path / "nowhere.json")).count() == 0


def test_folders_of_an_older_state_count_as_loaded(spark, tmp_path):
    root, table, manifest = (str(tmp_path / n) for n in ("processed", "table", "manifest"))
    lake.write_processed(placed(spark, {"question_id": 1}, {"question_id": 2, "creation_date": 4000}), root, "r")
    known = sorted(r.folder for r in load.list_hour_folders(spark, root).collect())
    (tmp_path / "state.json").write_text(json.dumps({"loaded_hour_folders": known[:1]}))
    assert load.load_new_folders(spark, root, table, manifest, str(tmp_path / "state.json")) == known[1:]
    assert [r.question_id for r in load.read_table(spark, table).collect()] == [2]


def test_loaded_table_is_known_in_its_namespace(spark, tmp_path):
    table = str(tmp_path / "table")
    load.replace_batch(records(spark, {"question_id": 5}), table, "r", 0)
    for _ in range(2):
        load.register_table(spark, "tallybrook_test", "questions", table)
    assert [r.question_id for r in spark.table("tallybrook_test.questions").collect()] == [5]


def test_runs_and_streams_never_touch_each_other(spark, tmp_path):
    lake_dir = str(tmp_path / "lake")
    for name, question in (("a", 1), ("b", 2)):
        source, checkpoint = str(tmp_path / f"source-{name}"), str(tmp_path / f"checkpoint-{name}")
        land(source, "1", envelope({**RECORD, "question_id": question}, "m"))
        ingest(read_messages(spark, source), lake_dir, checkpoint).awaitTermination()
    lake.write_processed(placed(spark, {"question_id": 3}), f"{lake_dir}/processed", "batch")
    lake.write_processed(placed(spark, {"question_id": 3}), f"{lake_dir}/processed", "batch")
    assert sorted(r.question_id for r in lake.read_processed(spark, f"{lake_dir}/processed").collect()) == [1, 2, 3]
    lake.claim_run(spark, lake_dir, "mine", "here")
    lake.claim_run(spark, lake_dir, "mine", "here")
    with pytest.raises(ValueError, match="not of 'there'"):
        lake.claim_run(spark, lake_dir, "mine", "there")


def test_old_files_are_read_too(spark, tmp_path):
    source, root = str(tmp_path / "source"), str(tmp_path / "processed")
    month_ago = dt.datetime.now().timestamp() - 30 * 86400

    def ingest_all():
        ingest(read_messages(spark, source), str(tmp_path / "lake"), str(tmp_path / "c1")).awaitTermination()
        load_new_files(spark, root, str(tmp_path / "table"), str(tmp_path / "c2")).awaitTermination()

    land(source, "1", envelope({**RECORD, "question_id": 1}, "m1"))
    lake.write_processed(placed(spark, {"question_id": 1}), root, "r", 0)
    ingest_all()
    land(source, "2", envelope({**RECORD, "question_id": 2}, "m2"))
    os.utime(os.path.join(source, "2"), (month_ago, month_ago))
    lake.write_processed(placed(spark, {"question_id": 2}), root, "r", 1)
    for path in (tmp_path / "processed" / "run=r" / "batch_id=1").rglob("*.parquet"):
        os.utime(path, (month_ago, month_ago))
    ingest_all()
    for back in (lake.read_processed(spark, str(tmp_path / "lake" / "processed")), load.read_table(spark, str(tmp_path / "table"))):
        assert sorted(r.question_id for r in back.collect()) == [1, 2]


def test_one_bad_message_stays_one_bad_message(spark, tmp_path):
    source, lake_dir, checkpoint = (str(tmp_path / n) for n in ("source", "lake", "checkpoint"))
    bad = [
        envelope({**RECORD, "creation_date": 10**15}, "far"), envelope({**RECORD, "creation_date": -(10**15)}, "past"),
        envelope({**RECORD, "title": 7}, "number"), envelope({**RECORD, "title": {"a": 1}}, "object"), envelope({**RECORD, "link": True}, "flag"),
        envelope({**RECORD, "content_license": 4}, "licence"), '{"message": {"data": "/w==", "messageId": "bytes"}}',
    ]
    land(source, "1", *bad, envelope(RECORD, "good"), envelope({**RECORD, "creation_date": -5}, "early"))
    for _ in range(2):
        ingest(read_messages(spark, source), lake_dir, checkpoint).awaitTermination()
    assert sorted(r.creation_date for r in lake.read_processed(spark, f"{lake_dir}/processed").collect()) == [-5, 100]
    letters = {r.message_id: r for r in spark.read.json(f"{lake_dir}/dead_letters").collect()}
    assert {i: r.error for i, r in letters.items()} == {
        "far": "creation_date:out_of_range", "past": "creation_date:out_of_range", "number": "title:wrong_type; title:missing",
        "object": "title:wrong_type; title:missing", "flag": "link:wrong_type; link:missing", "licence": "content_license:wrong_type", "bytes": "payload is not UTF-8",
    }
    assert sorted(r.original for r in letters.values()) == sorted(bad)
    # A letter can be repaired and sent again.
    land(source, "2", envelope({**RECORD, "title": "seven"}, "number-repaired"))
    ingest(read_messages(spark, source), lake_dir, checkpoint).awaitTermination()
    assert "seven" in {r.title for r in lake.read_processed(spark, f"{lake_dir}/processed").collect()}


def land(path, name, *lines):
    os.makedirs(path, exist_ok=True)
    temporary = os.path.join(path, f".{name}")
    with open(temporary, "w", encoding="utf-8") as file:
        file.write("\n".join(lines) + "\n")
    os.replace(temporary, os.path.join(path, name))


def test_stream_drops_redeliveries_across_runs_and_keeps_late_rows(spark, tmp_path):
    source, lake_dir, checkpoint = (str(tmp_path / n) for n in ("source", "lake", "checkpoint"))

    def run():
        query = ingest(read_messages(spark, source), lake_dir, checkpoint, "topic", "python")
        query.awaitTermination()
        return [p["observedMetrics"]["outcomes"] if isinstance(p, dict) else p.observedMetrics["outcomes"] for p in query.recentProgress]

    bad = '{"message": {"data": "*bad", "messageId": "b"}}'
    dead = envelope({**RECORD, "link": None}, "d")
    far = {**RECORD, "creation_date": 4_000_000_000}
    land(source, "1", *[envelope(RECORD, "m1")] * 4, envelope(far, "m2"), bad, bad, dead, "junk")
    outcomes = run()
    assert (outcomes[0].stored, outcomes[0].failed, outcomes[0].dead, outcomes[0].ack_no_message) == (5, 2, 1, 1)
    # The second run redelivers m1 and brings a row far behind the newest event time.
    land(source, "2", envelope(RECORD, "m1"), envelope({**RECORD, "creation_date": 50}, "m3"), dead)
    run()
    for back in (lake.read_processed(spark, f"{lake_dir}/processed"), lake.read_raw(spark, f"{lake_dir}/raw")):
        assert sorted(r.creation_date for r in back.collect()) == [50, 100, 4_000_000_000]
    letters = spark.read.json(f"{lake_dir}/dead_letters").orderBy("reason").collect()
    assert [(r.reason, r.error) for r in letters] == [
        ("contract_failed", "link:missing"), ("decode_failed", "payload is not base64"),
    ]


def test_replayed_batch_writes_the_same(spark, tmp_path):
    source, lake_dir, checkpoint = (str(tmp_path / n) for n in ("source", "lake", "checkpoint"))
    land(source, "1", envelope(RECORD, "m1"), envelope({**RECORD, "link": None}, "d"))

    def run():
        ingest(read_messages(spark, source), lake_dir, checkpoint).awaitTermination()
        return [
            lake.read_processed(spark, f"{lake_dir}/processed").count(),
            lake.read_raw(spark, f"{lake_dir}/raw").count(),
            spark.read.json(f"{lake_dir}/dead_letters").count(),
        ]

    assert run() == [1, 1, 1]
    for commit in (tmp_path / "checkpoint" / "commits").iterdir():  # as if it had died before committing
        commit.unlink()
    assert run() == [1, 1, 1]


def test_copies_are_spread_before_the_dedup(spark, tmp_path):
    source = str(tmp_path / "source")
    for name in "abc":
        land(source, name, *["same"] * 50, name)
    lines = read_messages(spark, source, max_files=1)
    query = (
        drop_redelivered(lines, ("value",), spread=3)
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    rows = spark.read.schema("value string").parquet(str(tmp_path / "out")).collect()
    assert sorted(r.value for r in rows) == ["a", "b", "c", "same"]


def test_columns_once(spark):
    df = with_columns_once(spark.range(2), {"a": F.col("id") + 1, "b": F.lit(None).cast("string")})
    assert [tuple(r) for r in df.orderBy("id").collect()] == [(0, 1, None), (1, 2, None)]


class _Session:
    """Just enough of a session to ask where shared files go."""

    def __init__(self, master):
        self.conf = self
        self.sparkContext = self
        self.master = master
        self.applicationId = f"app-{id(self)}"
        self.checkpoint_dir = None

    def get(self, key, default=None):
        return default

    def setCheckpointDir(self, path):
        self.checkpoint_dir = path


def test_only_local_mode_gets_a_temporary_folder():
    local = _Session("local[2]")
    assert shared_dir(local) == shared_dir(local) == local.checkpoint_dir
    with pytest.raises(RuntimeError):
        shared_dir(_Session("yarn"))
