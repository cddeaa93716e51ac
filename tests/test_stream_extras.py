"""Counters, daily counts and replays of dead letters: late rows, restarts, and attempts that die."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from tallybrook.operators import replay
from tallybrook.schemas import DEAD_LETTER_DDL
from tallybrook.sources import commits, footers, lake
from tallybrook.streaming import trends
from tallybrook.streaming.counters import DROPPED, BatchCounters, read_counters, total_counts
from tallybrook.streaming.ingest import ANY_AGE, ingest, read_messages
from tallybrook.streaming.trends import count_by_day, late_rows, read_daily_counts
from test_ingest import RECORD, envelope
from test_lake import land, records


def run_counted(spark, base, start):
    counters = BatchCounters(spark, f"{base}/counters")
    spark.streams.addListener(counters)
    try:
        counters.wait(start())
    finally:
        spark.streams.removeListener(counters)


def test_counters_of_two_runs_add_up(spark, tmp_path):
    source, lake_dir, checkpoint = (str(tmp_path / n) for n in ("source", "lake", "checkpoint"))
    bad = '{"message": {"data": "*bad", "messageId": "b"}}'
    for name, lines in (("1", [envelope(RECORD, "m1")] * 3 + [bad, "junk"]), ("2", [envelope(RECORD, "m1"), envelope({**RECORD, "link": None}, "d")])):
        land(source, name, *lines)
        run_counted(spark, str(tmp_path), lambda: ingest(read_messages(spark, source), lake_dir, checkpoint))
    run_counted(spark, str(tmp_path), lambda: ingest(read_messages(spark, source), lake_dir, checkpoint))  # nothing new
    counts = read_counters(spark, str(tmp_path / "counters"))
    assert {r.outcome: r.n_messages for r in total_counts(counts).collect()} == {
        "stored": 4, "failed": 1, "dead": 1, "ack_no_message": 1, "ack_no_data": 0, DROPPED: 0,
    }
    assert counts.select("run", "batch_id").distinct().count() == 2


def test_daily_counts_of_a_stream(spark, tmp_path):
    """Late rows within the watermark count, later ones are told of, and a restart changes nothing."""
    base, rows = str(tmp_path), str(tmp_path / "rows")
    schema = "created_ts timestamp_ntz, sentiment string"

    def arrive(*days):
        made = [(None if d is None else dt.datetime(2024, 1, 1, 23, 59) + dt.timedelta(days=d), "POSITIVE" if d == 1 else "NEUTRAL") for d in days]
        spark.createDataFrame(made, schema).coalesce(1).write.mode("append").parquet(rows)
        stream = spark.readStream.schema(schema).option("maxFileAge", ANY_AGE).parquet(rows)
        run_counted(spark, base, lambda: count_by_day(stream, f"{base}/table", f"{base}/checkpoint", late="3 days"))
        return {(str(r.report_date), r.sentiment): r.post_count for r in read_daily_counts(spark, f"{base}/table").collect()}

    first = arrive(0, 0, 1, 5, None)
    assert first == {("2024-01-01", "NEUTRAL"): 2, ("2024-01-02", "POSITIVE"): 1, ("2024-01-06", "NEUTRAL"): 1}
    second = arrive(5, 3, 0, 0)  # day 3 is in time, day 0 is not
    assert second == {**first, ("2024-01-06", "NEUTRAL"): 2, ("2024-01-04", "NEUTRAL"): 1}
    daily = read_daily_counts(spark, f"{base}/table")
    told = late_rows(read_counters(spark, f"{base}/counters"), daily).first()
    assert (told.offered, told.counted, told.late) == (8, 6, 2)
    done = tmp_path / "checkpoint" / "commits"
    last = max(int(f.name) for f in done.iterdir() if f.name.isdigit())
    for name in (str(last), f".{last}.crc"):  # as if the last batch had died
        (done / name).unlink()
    stream = spark.readStream.schema(schema).option("maxFileAge", ANY_AGE).parquet(rows)
    count_by_day(stream, f"{base}/table", f"{base}/checkpoint", late="3 days").awaitTermination()
    assert {(str(r.report_date), r.sentiment): r.post_count for r in read_daily_counts(spark, f"{base}/table").collect()} == second


def letters_of(spark, tmp_path):
    source = str(tmp_path / "source")
    land(
        source, "1", envelope(RECORD, "good"), envelope({**RECORD, "title": None}, "t"), envelope({**RECORD, "title": None}, "t"),
        envelope({**RECORD, "question_id": None}, "q"), '{"message": {"data": "*bad", "messageId": "b"}}',
    )
    ingest(read_messages(spark, source), str(tmp_path / "lake"), str(tmp_path / "checkpoint")).awaitTermination()
    return str(tmp_path / "lake")


def with_title(records):
    return records.withColumn("title", F.coalesce("title", F.lit("made up")))


def titles(spark, root):
    return sorted(r.title for r in lake.read_processed(spark, f"{root}/processed").collect())


def test_letters_are_accepted_once(spark, tmp_path):
    root = letters_of(spark, tmp_path)
    before = spark.read.schema(DEAD_LETTER_DDL).json(f"{root}/dead_letters").count()
    assert [replay.replay_letters(spark, root, with_title) for _ in range(2)] == [1, 0]
    assert titles(spark, root) == ["made up", RECORD["title"]]
    assert sorted(r.title for r in lake.read_raw(spark, f"{root}/raw").collect()) == titles(spark, root)
    assert [tuple(r) for r in replay.accepted_letters(spark, root).collect()] == [("t", "replay-t")]
    # What is still broken stays a letter and can be repaired later, undecodable payloads too.
    rebuilt = lambda r: with_title(r).withColumns(
        {"question_id": F.lit(77).cast("bigint"), **{c: F.coalesce(F.col(c), F.lit(1).cast("bigint")) for c in ("creation_date", "last_activity_date")},
         "link": F.lit("l")}
    )
    replay.replay_letters(spark, root, rebuilt)
    assert {r.letter_id for r in replay.accepted_letters(spark, root).collect()} >= {"t", "q"}
    assert spark.read.schema(DEAD_LETTER_DDL).json(f"{root}/dead_letters").count() == before


def test_replays_that_die_or_race(spark, tmp_path, monkeypatch):
    root = letters_of(spark, tmp_path)

    def die(*args, **kwargs):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(commits.CommitLog, "commit", die)
        with pytest.raises(KeyboardInterrupt):
            replay.replay_letters(spark, root, with_title)
    assert titles(spark, root) == [RECORD["title"]]
    accepted = []
    threads = [threading.Thread(target=lambda: accepted.append(replay.replay_letters(spark, root, with_title))) for _ in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(accepted) == [0, 1] and titles(spark, root) == ["made up", RECORD["title"]]


def test_a_replay_that_dies_after_its_commit_is_completed(spark, tmp_path, monkeypatch):
    root = letters_of(spark, tmp_path)
    with monkeypatch.context() as patch:
        patch.setattr(replay, "move_once", lambda *args: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            replay.replay_letters(spark, root, with_title)
    assert titles(spark, root) == [RECORD["title"]]
    assert replay.replay_letters(spark, root, with_title) == 0
    assert titles(spark, root) == ["made up", RECORD["title"]]


def test_letters_without_ids(spark):
    rows = [("r", None, None, "o1"), ("r", "{}", None, None), ("r", None, None, None), ("r", None, "m", "o")]
    df = spark.createDataFrame(rows, "reason string, record string, message_id string, original string")
    ids = [r[0] for r in df.select(replay.letter_id()).collect()]
    assert len(set(ids)) == 4 and ids[3] == "m" and all(i.startswith("letter-") for i in ids[:3])


def test_drift_of_files_and_of_some_files(spark, tmp_path):
    good = records(spark, {"question_id": 1}, {"question_id": 2})
    good.coalesce(1).write.parquet(str(tmp_path / "sets" / "a b"))
    good.drop("link").coalesce(1).write.mode("append").parquet(str(tmp_path / "sets" / "a b"))
    good.withColumn("score", F.col("score").cast("double")).coalesce(1).write.parquet(str(tmp_path / "sets" / "c"))
    found = footers.read_footers(spark, str(tmp_path / "sets"), tasks=3)
    drift = footers.drift(found, F.regexp_extract("path", "/([^/]+)/[^/]+$", 1)).collect()
    assert sorted((r.file_set.replace("%20", " "), r.column, r.expected, r.found, r.issue, r.n_files, r.n_rows) for r in drift) == [
        ("a b", "link", "string", None, "missing", 1, 2), ("c", "score", "bigint", "double", "type", 1, 2),
    ]
    sets = footers.schemas_by_file_set(found, F.lit("all")).where("column = 'link'").collect()
    assert [(r.type, r.n_files, r.n_rows) for r in sets] == [("string", 2, 4)]


def test_state_of_a_batch_stays_spread(spark, tmp_path):
    """The one file of a batch is gathered from the tasks that hold the state, not by one task for all of them."""
    rows = str(tmp_path / "rows")
    spark.createDataFrame([(dt.datetime(2024, 1, 1 + i), "NEUTRAL") for i in range(20)], "created_ts timestamp_ntz, sentiment string").write.parquet(rows)
    stream = spark.readStream.schema("created_ts timestamp_ntz, sentiment string").option("maxFileAge", ANY_AGE).parquet(rows)
    seen = []

    def look(batch, _):
        one = trends.gathered(batch)
        seen.append((batch.rdd.getNumPartitions(), one._jdf.queryExecution().executedPlan().toString(), len(one.collect())))

    query = trends.daily_counts(stream).writeStream.outputMode("update").foreachBatch(look)
    query.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    (partitions, plan, n_days), *_ = seen
    assert (partitions, n_days) == (4, 20) and "SinglePartition" in plan and "Coalesce" not in plan
    count_by_day(stream, str(tmp_path / "table"), str(tmp_path / "checkpoint")).awaitTermination()
    assert len([*(tmp_path / "table").rglob("batch_id=0/*.parquet")]) == 1
    assert read_daily_counts(spark, str(tmp_path / "table")).count() == 20
