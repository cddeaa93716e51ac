"""Data-quality rules and suites."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybrook.operators import quality as dq
from tallybrook.plans import suites


def run(spark, values, *rules, ddl="c bigint"):
    frame = spark.createDataFrame([(v,) for v in values], ddl)
    return dq.run_suite(frame, "s", rules).collect()


def test_mostly_is_inclusive(spark):
    rule = dq.NotNull("c", mostly=0.8)
    assert run(spark, [None] * 20 + [1] * 80, rule)[0].success is True
    assert run(spark, [None] * 21 + [1] * 79, rule)[0].success is False


def test_unique_counts_every_repeated_row(spark):
    row = run(spark, [1, 1, 2, None, None], dq.Unique("c"))[0]
    assert (row.success, row.element_count, row.missing_count, row.unexpected_count) == (False, 5, 2, 2)
    assert row.unexpected_pct == pytest.approx(200 / 3)
    assert run(spark, [1, 2, None, None], dq.Unique("c"))[0].success is True


def test_several_unique_rules(spark):
    frame = spark.createDataFrame([(1, 1), (1, 2), (3, 3)], "a int, b int")
    rows = dq.run_suite(frame, "s", [dq.Unique("a"), dq.Unique("b"), dq.NotNull("b")]).collect()
    got = {(r.rule, r.column): (r.success, r.unexpected_count) for r in rows}
    assert got == {("Unique", "a"): (False, 2), ("Unique", "b"): (True, 0), ("NotNull", "b"): (True, 0)}


def test_sets_and_lengths_ignore_nulls(spark):
    rows = run(
        spark, ["A", "BB", None], dq.InSet("c", values=("A",)), dq.LengthBetween("c", min=2, max=5),
        ddl="c string",
    )
    assert [(r.missing_count, r.unexpected_count, r.success) for r in rows] == [(1, 1, False)] * 2


def test_missing_column_does_not_stop_the_suite(spark):
    rows = run(spark, [1], dq.NotNull("gone"), dq.ColumnExists("gone"), dq.ColumnExists("c"), dq.RowCount(min=1))
    got = {(r.rule, r.column): (r.success, r.error) for r in rows}
    assert got[("NotNull", "gone")] == got[("ColumnExists", "gone")] == (False, "column not found: gone")
    assert got[("ColumnExists", "c")] == got[("RowCount", None)] == (True, None)


def test_empty_table(spark):
    rules = [dq.NotNull("c"), dq.Unique("c"), dq.RowCount(min=1, max=10)]
    rows = {r.rule: r for r in run(spark, [], *rules)}
    assert (rows["NotNull"].success, rows["Unique"].success, rows["RowCount"].success) == (True, True, False)
    assert rows["Unique"].element_count == 0


def test_suite_sizes():
    sizes = [len(s) for s in (*suites.BRONZE_SUITES.values(), *suites.SILVER_SUITES.values())]
    assert sizes == [7, 7, 8, 8]
    assert (len(suites.MODEL_TESTS["bronze"]), len(suites.MODEL_TESTS["silver"])) == (3, 9)


def test_one_scan_per_suite(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 2, "t")], "question_id bigint, creation_date bigint, title string").write.parquet(path)
    plan = dq.run_suite(spark.read.parquet(path), "s", suites.BRONZE_MONITORING)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1
    assert "Python" not in text


def test_failing_rows(spark):
    frame = spark.createDataFrame([(1, "A"), (1, None), (2, "B")], "k int, v string")
    assert dq.failing_rows(frame, dq.NotNull("v")).collect() == [(1, None)]
    assert dq.failing_rows(frame, dq.InSet("v", values=("A",))).collect() == [(2, "B")]
    assert dq.failing_rows(frame, dq.Unique("k")).collect() == [(1, 2)]
    with pytest.raises(ValueError):
        dq.failing_rows(frame, dq.RowCount())


def test_success_and_persistence(spark, tmp_path):
    frame = spark.createDataFrame([(1,), (None,)], "c int")
    results = dq.run_suite(frame, "s", [dq.NotNull("c"), dq.RowCount(min=1)])
    assert dq.suite_success(results).collect() == [("s", False)]
    path = str(tmp_path / "results")
    stamp = dq.write_results(results, path, dt.datetime(2025, 1, 9, 5, 6, 7, tzinfo=dt.timezone.utc))
    dq.write_results(results, path)
    assert stamp == "20250109T050607Z"
    back = spark.read.schema(dq.RESULT_DDL).json(path)
    assert back.count() == 4 and back.filter(f"run_stamp = '{stamp}'").count() == 2


def test_schema_drift(spark):
    frame = spark.createDataFrame([(1, "x", 2)], "a int, b string, d int")
    expected = T.StructType.fromDDL("a bigint, b string, c date")
    assert sorted(dq.schema_drift(frame, expected)) == [("a", "now int"), ("c", "missing"), ("d", "unexpected")]


def test_profile_tells_a_text_from_its_hash(spark):
    text = "x" * 100
    hashed = spark.range(1).select(F.sha2(F.lit(text), 256)).first()[0]
    row = dq.profile(spark.createDataFrame([(text,), (hashed,)], "t string")).first()
    assert (row.distinct_count, row.duplicate_rows) == (2, 0)


def test_profile_compares_whole_texts(spark):
    long = "x" * 5000
    frame = spark.createDataFrame([(long + "a",), (long + "b",), (long + "a",), (None,)], "t string")
    row = dq.profile(frame).first()
    assert (row.element_count, row.null_count, row.distinct_count, row.duplicate_rows) == (4, 1, 2, 2)
    assert row.null_share == 0.25


def test_suites_share_a_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 2, "t"), (1, None, None)], "question_id bigint, creation_date bigint, title string").write.parquet(path)
    results = dq.run_suites(spark.read.parquet(path), suites.BRONZE_SUITES)
    assert results._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    got = {(r.suite, r.rule, r.column): r.success for r in results.collect()}
    assert len(got) == 14
    assert got[("bronze_strict", "NotNull", "title")] is False
    assert got[("bronze_monitoring", "Unique", "question_id")] is False
    assert got[("bronze_monitoring", "RowCount", None)] is True
