"""What jobs leave on disk while they run: ids instead of messages in a stream's dedup, no shuffle of a write that has ended."""

from pyspark.sql import functions as F

from tallybrook.operators import compact, load
from tallybrook.session import shuffles_dropped
from tallybrook.sources import envelopes as env
from tallybrook.sources import lake
from tallybrook.streaming import ingest as stream
from test_ingest import RECORD, envelope
from test_lake import land, records


def shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def test_dedup_of_a_file_stream_moves_ids_only(spark, tmp_path):
    (tmp_path / "in").mkdir()
    ids = stream.delivered_ids(stream.read_messages(spark, str(tmp_path / "in")))
    assert set(ids.columns) == {"outcome", "message_id", "file", "second"}


def test_messages_are_read_again_from_their_files(spark, tmp_path):
    """Odd file names, copies within a file, between files and between batches, and an id of two outcomes."""
    source, lake_dir, checkpoint = (str(tmp_path / n) for n in ("source of", "lake", "checkpoint"))

    def run(*asked):
        if asked:
            land(source, *asked)
        stream.ingest(stream.read_messages(spark, source), lake_dir, checkpoint).awaitTermination()

    other = envelope({**RECORD, "title": "other"}, "m2")
    dead, bad = envelope({**RECORD, "link": None}, "m2"), '{"message": {"data": "*bad", "messageId": "b"}}'
    land(source, "a b%20[1]{c}*?", envelope(RECORD, "m1"), envelope(RECORD, "m1"), other, dead, bad, "junk", envelope(RECORD, ""))
    land(source, "ü+&=1", envelope(RECORD, "m1"), bad, other, "junk", '{"message": {"messageId": "m9"}}', envelope({**RECORD, "title": "one"}, "m3"))
    run()
    run("next", envelope(RECORD, "m1"), envelope({**RECORD, "title": "later"}, "m4"), dead, envelope(RECORD, ""))
    assert [r.title for r in lake.read_raw(spark, f"{lake_dir}/raw").where("batch_id > 0").collect()] == ["later"]
    for commit in (tmp_path / "checkpoint" / "commits").iterdir():  # as if the batch had died before its commit
        commit.unlink()
    run()
    titles = sorted([RECORD["title"], RECORD["title"], "later", "one", "other"])
    for back in (lake.read_processed(spark, f"{lake_dir}/processed"), lake.read_raw(spark, f"{lake_dir}/raw")):
        assert sorted(r.title for r in back.collect()) == titles
        assert {r.run for r in back.select("run").distinct().collect()} == {r.run for r in back.select("run").collect()}
    letters = spark.read.json(f"{lake_dir}/dead_letters").collect()
    assert sorted((r.message_id, r.original) for r in letters) == sorted([("m2", dead), ("b", bad)])


def test_messages_that_differ_under_one_id_are_one(spark):
    lines = spark.createDataFrame([(envelope({**RECORD, "title": t}, "m"),) for t in "abc"] + [(envelope(RECORD, "n"),), (envelope(RECORD, "gone"),)], "value string")
    ids = spark.createDataFrame([("stored", "m"), ("stored", "n")], "outcome string, message_id string")
    doubtful = env.doubtful_ids(lines, ids)
    assert {r.message_id for r in doubtful.collect()} == {"m", "gone"}
    found = env.messages_of(lines, ids, doubtful, "stored", ["message_id", "title"])
    again = env.messages_of(lines.orderBy(F.desc("value")), ids, doubtful, "stored", ["message_id", "title"])
    assert sorted(r.message_id for r in found.collect()) == ["m", "n"]
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, again.collect()))
    everything = env.messages_of(lines, ids, lines.select(F.lit("n").alias("message_id")).union(doubtful), "stored", ["message_id", "title"])
    assert sorted(map(tuple, everything.collect())) == sorted(map(tuple, found.collect()))
    assert sorted(map(tuple, env.few_messages_of(lines, ids, ["message_id", "title"]).collect())) == sorted(map(tuple, found.collect()))


def test_lines_of_other_sources_are_ingested_whole(spark, tmp_path):
    source, lake_dir = str(tmp_path / "source"), str(tmp_path / "lake")
    land(source, "1", envelope(RECORD, "m1"), envelope(RECORD, "m1"), envelope({**RECORD, "link": None}, "d"))
    stream.ingest(spark.readStream.text(source), lake_dir, str(tmp_path / "checkpoint")).awaitTermination()
    assert lake.read_processed(spark, f"{lake_dir}/processed").count() == lake.read_raw(spark, f"{lake_dir}/raw").count() == 1
    assert spark.read.json(f"{lake_dir}/dead_letters").count() == 1


def test_a_write_leaves_no_shuffle(spark, tmp_path):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    spark.conf.set(setting, "false")
    before = shuffle_files(spark)
    rows = lake.with_hour_partitions(lake.with_event_time(records(spark, {"question_id": 1}, {"question_id": 2, "creation_date": 9000})))
    lake.write_processed(lake.spread_by_hour(rows), str(tmp_path / "processed"), "r")
    lake.write_raw(lake.spread_by_hour(rows), str(tmp_path / "raw"), "r")
    assert shuffle_files(spark) <= before
    assert lake.read_processed(spark, str(tmp_path / "processed")).count() == lake.read_raw(spark, str(tmp_path / "raw")).count() == 2
    spark.range(9).repartition(2, "id").write.parquet(str(tmp_path / "kept"))
    assert spark.conf.get(setting) == "false" and shuffle_files(spark) - before
    with shuffles_dropped(spark):
        assert spark.conf.get(setting) == "true"


def test_a_compaction_goes_by_ranges_of_hours(spark, tmp_path, monkeypatch):
    root, bare = str(tmp_path / "processed"), []
    hours = [{"question_id": n, "creation_date": 3600 * (n % 7)} for n in range(40)]
    rows = lake.with_hour_partitions(lake.with_event_time(records(spark, *hours)))
    for batch_id in range(2):
        lake.write_processed(lake.spread_by_hour(rows), root, "r", batch_id)
    spans = compact._spans
    monkeypatch.setattr(compact, "SLOTS_AT_ONCE", 2)
    monkeypatch.setattr(compact, "_spans", lambda *frames: bare.extend(spans(*frames)) or bare)
    assert compact.compact(spark, root, "year=9999", target_bytes=6000) == 2
    assert len(bare) > 2 and all(a.end < b.start for a, b in zip(bare, bare[1:], strict=False))
    assert len(compact.drop_replaced(spark, root)) == 2
    back = compact.read_lake(spark, root)
    assert sorted((r.question_id, r.batch_id) for r in back.collect()) == sorted((n, b) for n in range(40) for b in range(2))
    assert [*(tmp_path / "processed" / "_compacted").rglob("*.zstd.parquet")]


def test_a_load_leaves_no_shuffle(spark, tmp_path):
    before = shuffle_files(spark)
    load.replace_batch(spark.range(9).repartition(2, "id"), str(tmp_path / "table"), "r", 0)
    assert shuffle_files(spark) <= before and spark.read.parquet(str(tmp_path / "table")).count() == 9


def test_batches_without_rows_are_compacted(spark, tmp_path):
    root = str(tmp_path / "processed")
    for batch_id in range(2):
        rows = lake.with_hour_partitions(lake.with_event_time(records(spark, {"question_id": 1}).where("false")))
        lake.write_processed(rows, root, "r", batch_id)
    assert compact.compact(spark, root, "year=9999") == 2
    assert len(compact.drop_replaced(spark, root)) == 2 and compact.read_lake(spark, root).count() == 0
