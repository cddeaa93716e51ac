"""Writers at once, writers that die, and rebuilds that readers never see half of."""

import threading

import pytest
from pyspark.sql import functions as F

from tallybrook.operators import load
from tallybrook.operators.trends import rolling_sum, rolling_sum_of_days
from tallybrook.plans import models
from tallybrook.sources import commits, lake, versions
from test_lake import folder, placed, records


@pytest.mark.parametrize("scheme", ["", "file:"])
def test_an_entry_is_written_once(spark, tmp_path, scheme):
    log = commits.CommitLog(spark, f"{scheme}{tmp_path}/log é")
    assert log.entries() == [] and log.last() is None
    won = []
    threads = [threading.Thread(target=lambda i=i: won.append((log.commit(0, by=i), i))) for i in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert [w for w, _ in won].count(True) == 1
    assert log.entries() == [{"number": 0, "by": next(i for w, i in won if w)}]
    assert log.commit(1, by="ö") and log.last() == {"number": 1, "by": "ö"}
    assert not list((tmp_path / "log é").glob(".*.tmp"))


def test_renames_refuse_an_existing_target(spark, tmp_path, monkeypatch):
    """The way of file systems without links."""
    monkeypatch.setattr(commits, "urlparse", lambda url: type("Other", (), {"scheme": "store", "path": url})())
    log = commits.CommitLog(spark, str(tmp_path / "log"))
    assert [log.commit(0, a=1), log.commit(0, a=2), log.commit(1, a=3)] == [True, False, True]
    assert [e["a"] for e in log.entries()] == [1, 3]


def test_two_loads_at_once_lose_and_repeat_nothing(spark, tmp_path):
    root, table, manifest = (str(tmp_path / n) for n in ("processed", "table", "manifest"))
    hours = [{"question_id": i, "creation_date": 3600 * i} for i in range(12)]
    for batch_id in range(3):
        lake.write_processed(placed(spark, *hours[batch_id * 4 : batch_id * 4 + 4]), root, "r", batch_id)
    found, errors = [], []

    def one():
        try:
            found.extend(load.load_new_folders(spark, root, table, manifest))
        except Exception as error:  # noqa: BLE001 - shown below
            errors.append(error)

    threads = [threading.Thread(target=one) for _ in range(3)]
    for t in threads:
        t.start()
    lake.write_processed(placed(spark, {"question_id": 50, "creation_date": 3600 * 50}), root, "s", 0)
    for t in threads:
        t.join()
    assert errors == []
    found += load.load_new_folders(spark, root, table, manifest)
    assert len(found) == len(set(found)) == 13
    assert sorted(r.question_id for r in load.read_table(spark, table).collect()) == [*range(12), 50]
    kept = load.read_manifest(spark, manifest).collect()
    assert sorted(r.folder for r in kept) == sorted(found)


def test_a_load_that_dies_before_or_after_its_commit(spark, tmp_path, monkeypatch):
    root, table, manifest = (str(tmp_path / n) for n in ("processed", "table", "manifest"))
    lake.write_processed(placed(spark, {"question_id": 1}), root, "r", 0)

    def die(*args, **kwargs):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(commits.CommitLog, "commit", die)
        with pytest.raises(KeyboardInterrupt):
            load.load_new_folders(spark, root, table, manifest)
    with monkeypatch.context() as patch:
        patch.setattr(load, "write_manifest", die)
        with pytest.raises(KeyboardInterrupt):
            load.load_new_folders(spark, root, table, manifest)
    assert load.read_manifest(spark, manifest).count() == 0
    assert load.load_new_folders(spark, root, table, manifest) == []
    assert load.read_manifest(spark, manifest).count() == 1
    assert [r.question_id for r in load.read_table(spark, table).collect()] == [1]


def test_seen_batches_are_not_listed_again(spark, tmp_path, monkeypatch):
    root, table, manifest = (str(tmp_path / n) for n in ("processed", "table", "manifest"))
    listed, plain = [], load.list_hour_folders
    monkeypatch.setattr(load, "list_hour_folders", lambda s, r, within=None: listed.append([b.path[len(root):] for b in within]) or plain(s, r, within))

    def write(batch_id, *rows):
        lake.write_processed(placed(spark, *rows), root, "r", batch_id)
        return [folder(f) for f in load.load_new_folders(spark, root, table, manifest)]

    assert len(write(0, {"question_id": 1}, {"question_id": 2, "creation_date": 4000})) == 2
    assert write(1, {"question_id": 3}) == []  # an hour that is loaded already
    assert write(2, {"question_id": 4, "creation_date": 8000}) == ["year=1970/month=01/day=01/hour=02"]
    assert write(0, {"question_id": 5, "creation_date": 12000}) == ["year=1970/month=01/day=01/hour=03"]  # written again
    assert load.load_new_folders(spark, root, table, manifest) == []
    assert listed == [["/run=r/batch_id=0"], ["/run=r/batch_id=1"], ["/run=r/batch_id=2"], ["/run=r/batch_id=0"]]
    assert sorted(r.question_id for r in load.read_table(spark, table).collect()) == [1, 2, 4, 5]


def test_a_table_from_before_the_log(spark, tmp_path):
    root, table, manifest = (str(tmp_path / n) for n in ("processed", "table", "manifest"))
    lake.write_processed(placed(spark, {"question_id": 1}, {"question_id": 2, "creation_date": 4000}), root, "r", 0)
    first = sorted(r.folder for r in load.list_hour_folders(spark, root).collect())[0]
    load.replace_batch(records(spark, {"question_id": 1}), table, load.FOLDER_RUN, 0)
    load.write_manifest(spark.createDataFrame([(first,)], "folder string"), manifest, 0)
    assert len(load.load_new_folders(spark, root, table, manifest, register=("tallybrook_old", "questions"))) == 1
    for rows in (load.read_table(spark, table), spark.table("tallybrook_old.questions")):
        assert sorted(r.question_id for r in rows.collect()) == [1, 2]
    assert load.read_manifest(spark, manifest).count() == 2


def test_the_namespace_shows_committed_loads_only(spark, tmp_path):
    root, table, manifest = (str(tmp_path / n) for n in ("processed", "table", "manifest"))
    for batch_id in range(2):
        lake.write_processed(placed(spark, {"question_id": batch_id, "creation_date": batch_id * 4000}), root, "r", batch_id)
        load.load_new_folders(spark, root, table, manifest, register=("tallybrook_load", "questions"))
    load.replace_batch(records(spark, {"question_id": 9}), table, "folders-lost", 7)
    assert sorted(r.question_id for r in spark.table("tallybrook_load.questions").collect()) == [0, 1]


def silver_like(spark, n):
    days = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int"))
    return spark.range(n).select("id", days.alias("created_date"), F.lit("NEUTRAL").alias("sentiment"), F.lit(True).alias("is_answered"), F.lit(False).alias("is_closed"))


def test_a_rebuild_that_dies_leaves_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "silver")
    models.write_silver(silver_like(spark, 10), path)
    reading = models.read_model(spark, path)

    def die(*args, **kwargs):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(commits.CommitLog, "commit", die)
        with pytest.raises(KeyboardInterrupt):
            models.write_silver(silver_like(spark, 99), path)
    failing = silver_like(spark, 50).withColumn("id", F.when(F.col("id") == 40, F.raise_error(F.lit("broken"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="broken"):
        models.write_silver(failing, path)
    assert models.read_model(spark, path).count() == reading.count() == 10
    assert len(versions.drop_unpublished(spark, path)) >= 1
    assert models.read_model(spark, path).count() == 10


def test_versions_are_kept_for_their_readers(spark, tmp_path):
    path = str(tmp_path / "gold")
    readers = []
    for n in (4, 5, 6):
        models.write_silver(silver_like(spark, n), path, keep=1)
        readers.append(models.read_model(spark, path))
    assert [r.count() for r in readers[1:]] == [5, 6]
    assert len([n for n, _ in commits.list_names(spark, path, folders=True)]) == 2
    models.write_silver(silver_like(spark, 7), path)
    assert [n for n, _ in commits.list_names(spark, path, folders=True)] == [versions.versions_log(spark, path).last()["version"]]


def test_days_of_the_calendar(spark):
    rows = [("a", d, n) for d, n in (("2024-01-01", 1), ("2024-01-07", 2), ("2024-01-08", 4), ("2024-01-08", 8), (None, 16), (None, 32), ("2024-03-01", 64))]
    df = spark.createDataFrame(rows, "k string, day string, n long").withColumn("day", F.col("day").cast("date"))
    found = sorted((str(r.day), r.n, r.total) for r in rolling_sum_of_days(df, "n", ["k"], "day", "total").collect())
    assert found == [
        ("2024-01-01", 1, 1), ("2024-01-07", 2, 3), ("2024-01-08", 4, 14), ("2024-01-08", 8, 14), ("2024-03-01", 64, 64), ("None", 16, 48), ("None", 32, 48),
    ]
    assert rolling_sum(df, "n", ["k"], "day", "total").filter("n = 64").first().total == 127
