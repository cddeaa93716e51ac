"""Silver, gold, windows and paging."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallybrook.operators.latest import latest_by_key, without_outdated
from tallybrook.operators.membership import with_membership
from tallybrook.operators.paging import paged_top_n
from tallybrook.operators.trends import change_from_previous, previous, rank_within, rolling_sum
from tallybrook.plans import models
from tallybrook.registry import QUERIES
from tallybrook.registry.derived import questions_raw
from tallybrook.schemas import RECORD_COLUMNS, RECORD_DDL
from tallybrook.session import run_dir


def question(**values):
    base = dict.fromkeys(RECORD_COLUMNS)
    base.update(question_id=1, title="t", link="l", creation_date=1000, is_answered=False)
    base.update(values)
    return tuple(base[c] for c in RECORD_COLUMNS)


def questions(spark, *rows):
    return spark.createDataFrame([question(**r) for r in rows], RECORD_DDL)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_blank_latest_title_hides_the_question(spark):
    df = questions(
        spark,
        {"question_id": 1, "title": "good", "last_activity_date": 10, "link": "a"},
        {"question_id": 1, "title": " \n", "last_activity_date": 20, "link": "b"},
        {"question_id": 2, "title": "old", "last_activity_date": 10, "link": "c"},
        {"question_id": 2, "title": "new", "last_activity_date": 20, "link": "d"},
        {"question_id": 3, "title": "???", "link": "e"},
        {"question_id": None, "title": "no id", "link": "f"},
    )
    rows = {r.question_id: r.title_clean for r in models.silver(df).collect()}
    assert rows == {2: "new", 3: ""}


def test_version_order(spark):
    df = questions(
        spark,
        {"link": "a", "last_activity_date": None, "creation_date": 50},
        {"link": "b", "last_activity_date": 50, "creation_date": 40},
        {"link": "c", "last_activity_date": 50, "creation_date": 50},
        {"link": "d", "last_activity_date": None, "creation_date": None},
    )
    assert [r.link for r in models.latest_versions(df).collect()] == ["c"]


def test_silver_reads_inputs_not_outputs(spark):
    df = questions(spark, {"creation_date": 0, "closed_date": 7201, "last_activity_date": 86400})
    row = models.silver(df).first()
    assert (row.is_closed, row.hours_to_close) == (True, 2)
    assert row.closed_date == dt.date(1970, 1, 1)
    assert row.last_activity_date == dt.date(1970, 1, 2)
    assert (row.score_filled, row.answer_count_filled, row.view_count_filled) == (0, 0, 0)
    assert len(row) == 20


def test_silver_plan(spark, tmp_path):
    path = str(tmp_path / "raw")
    questions(spark, {}).write.parquet(path)
    raw = spark.read.parquet(path)
    silver, gold = plan(models.silver(raw)), plan(models.gold(models.silver(raw)))
    for text in (silver, gold):
        assert text.count("WindowGroupLimit") == 2  # before and after the shuffle
        assert "Python" not in text
        below_window = text[text.index("WindowGroupLimit"):]
        assert "Filter isnotnull(question_id" in below_window  # null ids never reach the shuffle
        assert "Filter ((isnotnull(title" not in below_window  # titles are tested after ranking
    # Only a flag, not the title, goes through gold's shuffle.
    assert "title" not in gold[: gold.index("FileScan")].replace("_has_title", "").split("RLIKE")[0]
    assert "content_license" not in gold


def test_hot_key_is_limited_before_the_shuffle(spark):
    df = spark.range(40_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id"
    )
    rows = latest_by_key(df, ["k"], [F.desc("id")])
    assert rows.filter("k = 7").collect()[0].id == 39_999
    assert rows.count() == df.select("k").distinct().count()


def series(spark, counts):
    rows = [("a", dt.date(2024, 1, d), n) for d, n in counts]
    return spark.createDataFrame(rows, "label string, day date, n bigint")


def test_windows_count_rows_not_days(spark):
    df = series(spark, [(1, 2), (20, 3)])
    rolled = rolling_sum(df, "n", ["label"], "day", "total").orderBy("day").collect()
    assert [r.total for r in rolled] == [2, 5]
    before = previous(df, "n", ["label"], "day", "before").orderBy("day").collect()
    assert [r.before for r in before] == [None, 2]
    change = change_from_previous(df, "n", ["label"], "day", "pct").orderBy("day").collect()
    assert [r.pct for r in change] == [None, 50.0]


def test_rolling_sum_keeps_seven_rows(spark):
    df = series(spark, [(d, 1) for d in range(1, 11)])
    rolled = rolling_sum(df, "n", ["label"], "day", "total").orderBy("day").collect()
    assert [r.total for r in rolled] == [1, 2, 3, 4, 5, 6, 7, 7, 7, 7]


def test_ranks(spark):
    df = spark.createDataFrame([("d", 5), ("d", 5), ("d", 3)], "day string, n bigint")
    rows = sorted((r.n, r["rank"], r.dense_rank) for r in rank_within(df, "n", ["day"]).collect())
    assert rows == [(3, 3, 2), (5, 1, 1), (5, 1, 1)]


def test_table_layouts(spark, sf_dir):
    silver = models.silver(questions_raw(spark, sf_dir))
    path = run_dir(spark, "silver-test")
    models.write_silver(silver, path)
    back = spark.read.schema(silver.schema).parquet(path)
    assert back.count() == silver.count() > 300
    pruned = plan(back.filter("created_date = date'2024-01-05'"))
    assert "PartitionFilters: [isnotnull(created_date" in pruned
    first = back.count()
    models.write_silver(silver.limit(5), path)  # a rebuild replaces everything
    assert spark.read.schema(silver.schema).parquet(path).count() == 5 < first


def page(df, **kwargs):
    return [r.id for r in paged_top_n(df, "t", tiebreak=("id",), **kwargs).orderBy(F.desc("t"), F.desc("id")).collect()]


def test_paging_edges(spark):
    df = spark.range(25).withColumn("t", F.col("id") % 10)
    assert page(df, page_size=0, total=0) == []
    with pytest.raises(ValueError):
        page(df, page_size=0, total=5)
    assert len(page(df, page_size=10, total=99)) == 25
    assert len(page(df, page_size=3, total=20, max_pages=2)) == 6
    assert len(page(df, page_size=4)) == 25
    assert len(page(df, page_size=4, max_pages=1)) == 4
    assert len(page(df, page_size=4, start_page=3, max_pages=None)) == 17
    # In order: 19, 9, 18 | 8, 17, ...
    assert page(df, page_size=3, total=2, start_page=2) == [8, 17]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(1, 9), st.integers(1, 40), st.integers(1, 4), st.integers(1, 6))
def test_pages_in_order(spark, page_size, total, start_page, max_pages):
    df = spark.range(60).repartition(5).withColumn("t", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")))
    ordered = sorted(((1 if i % 3 == 0 else i), i) for i in range(60))[::-1]
    skip = (start_page - 1) * page_size
    want = [i for _, i in ordered[skip: skip + min(total, page_size * max_pages)]]
    kwargs = dict(page_size=page_size, total=total, start_page=start_page, max_pages=max_pages)
    assert page(df, **kwargs) == want


def test_pages_of_ties_and_equal_rows(spark):
    rows = [(None, 1, "a")] * 3 + [(5, i % 2, "b" if i % 3 else None) for i in range(20)] + [(5, 1, "b")] * 4
    df = spark.createDataFrame(rows, "t long, id long, x string").repartition(4)
    for skip in range(0, 27, 4):
        found = paged_top_n(df, "t", page_size=4, total=4, start_page=skip // 4 + 1, tiebreak=("id",))
        ids = sorted([(-1 if t is None else t, i) for t, i, _ in rows], reverse=True)[skip : skip + 4]
        assert sorted([(-1 if r.t is None else r.t, r.id) for r in found.collect()], reverse=True) == ids
    whole = [r for n in range(1, 8) for r in paged_top_n(df, "t", page_size=4, total=4, start_page=n, tiebreak=("id",)).collect()]
    assert sorted(map(str, map(tuple, whole))) == sorted(map(str, rows))


def test_paging_moves_keys_only(spark):
    wide = spark.range(100).withColumns({"t": F.col("id") % 7, "text": F.repeat(F.lit("wide"), 1000)})
    found = paged_top_n(wide, "t", page_size=10, total=10, start_page=2, tiebreak=("id",))
    # The only sort is that of the page itself: it comes after the filter by the page's keys.
    steps = plan(found).split("== Physical Plan ==")[-1]
    assert "TakeOrderedAndProject" not in steps and steps.count("- Sort [") == 1 and steps.index("Sort [") < steps.index("Filter (")
    assert found.count() == 10


def test_pages_come_in_order(spark, monkeypatch):
    rows = [(i % 7 if i % 11 else None, i % 50) for i in range(200)]
    df = spark.createDataFrame(rows, "t long, id long").repartition(6)
    ordered = sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], r[1]), reverse=True)
    for top_keys in (10_000, 5):  # both ways to the bounds
        monkeypatch.setattr("tallybrook.operators.paging.TOP_KEYS", top_keys)
        for start, size in ((1, 10), (2, 13), (3, 40), (9, 23)):
            found = paged_top_n(df, "t", page_size=size, total=size, start_page=start, tiebreak=("id",))
            assert [tuple(r) for r in found.collect()] == ordered[(start - 1) * size : start * size]
    assert [tuple(r) for r in paged_top_n(df, "t", max_pages=None, tiebreak=("id",)).collect()] == ordered


def test_membership_finds_every_key(spark):
    keys = spark.range(0, 60_000, 3).select((F.col("id") % 7).alias("a"), F.when(F.col("id") % 5 != 0, F.col("id").cast("string")).alias("b"))
    rows = spark.range(60_000).select("id", (F.col("id") % 7).alias("a"), F.when(F.col("id") % 5 != 0, F.col("id").cast("string")).alias("b"))
    found = with_membership(rows, keys, "held").select("id", "a", "b", "held").collect()
    held = {(r.a, r.b) for r in keys.collect()}
    assert len(found) == 60_000 and all(r.held for r in found if (r.a, r.b) in held)
    assert sum(r.held for r in found if (r.a, r.b) not in held) < 100  # about 4 are expected


def test_old_versions_go_before_titles_move(spark, sf_dir):
    df = questions(
        spark,
        *[{"question_id": i % 500, "title": f"t{i}", "link": f"l{i}", "last_activity_date": i * 7919 % 1500} for i in range(1500)],
        *[{"question_id": 9000, "title": t, "link": "same", "last_activity_date": 5} for t in ("a", "a", "a")],
        {"question_id": 9001, "link": None, "creation_date": None}, {"question_id": 9001, "link": "x", "creation_date": None},
        {"question_id": 9002, "title": " ", "link": "new", "last_activity_date": 9}, {"question_id": 9002, "link": "old", "last_activity_date": 8},
        {"question_id": None, "link": "none"},
    ).repartition(3)
    kept = without_outdated(df, ["question_id"], models.version_order(), ["link"])
    assert 500 + 3 + 2 + 1 <= kept.count() <= 515 and kept.filter("question_id is null").count() == 1
    for build in (models.silver, models.usable_latest, models.latest_versions):
        assert sorted(map(str, build(df).collect())) == sorted(map(str, build(df, wide=True).collect()))
    for name in ("silver_dedup", "silver_filter", "silver"):
        text = plan(QUERIES[name](spark, sf_dir))
        assert "bitmap_construct_agg" in text and "BroadcastHashJoin" in text and "Union" in text


def test_stored_models_are_zstd(spark, tmp_path):
    models.write_silver(models.silver(questions(spark, {})), str(tmp_path / "silver"))
    assert [*(tmp_path / "silver").rglob("*.zstd.parquet")] and not [*(tmp_path / "silver").rglob("*.snappy.parquet")]
