"""Data-quality rules, suites, model tests and the column profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.fixed_values import MONITORING_MOSTLY
from tallybrook.operators import quality as dq
from tallybrook.plans import models, suites
from tallybrook.registry import sql
from tallybrook.registry.base import query
from tallybrook.registry.derived import questions_raw
from tallybrook.schemas import RECORD_COLUMNS
from tallybrook.session import run_dir


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.silver(questions_raw(spark, sf_dir))


# --- checking SQL: one SELECT per rule, each over the whole table ---

_NULL = "CAST(NULL AS {})".format


def _counts_sql(table: str, rule: dq.Rule) -> str:
    """``elements, missing, unexpected`` of a rule."""
    column = rule.column
    if isinstance(rule, dq.Unique):
        return (
            f"SELECT CAST(sum(n) AS BIGINT) AS elements, "
            f"CAST(coalesce(sum(n) FILTER ({column} IS NULL), 0) AS BIGINT) AS missing, "
            f"CAST(coalesce(sum(n) FILTER ({column} IS NOT NULL AND n > 1), 0) AS BIGINT) AS unexpected "
            f"FROM (SELECT {column}, count(*) AS n FROM {table} GROUP BY 1)"
        )
    if isinstance(rule, (dq.ColumnExists, dq.RowCount)):
        missing = unexpected = _NULL("BIGINT")
    else:
        missing = f"count(*) - count({column})"
        if isinstance(rule, dq.NotNull):
            unexpected = missing
        elif isinstance(rule, dq.InSet):
            allowed = ", ".join(f"'{v}'" for v in rule.values)
            unexpected = f"count(*) FILTER ({column} NOT IN ({allowed}))"
        else:
            unexpected = f"count(*) FILTER (length({column}) NOT BETWEEN {rule.min} AND {rule.max})"
    return f"SELECT count(*) AS elements, {missing} AS missing, {unexpected} AS unexpected FROM {table}"


def _rule_sql(suite: str, table: str, rule: dq.Rule, columns: list[str]) -> str:
    success, pct, error = "true", _NULL("DOUBLE"), _NULL("VARCHAR")
    if rule.column and rule.column not in columns:
        success, error = "false", f"'column not found: {rule.column}'"
        rule_counts = f"SELECT count(*) AS elements, {_NULL('BIGINT')} AS missing, {_NULL('BIGINT')} AS unexpected FROM {table}"
    else:
        rule_counts = _counts_sql(table, rule)
        if isinstance(rule, dq.RowCount):
            success = f"elements BETWEEN {rule.min} AND {rule.max}"
        elif not isinstance(rule, dq.ColumnExists):
            checked = "elements" if isinstance(rule, dq.NotNull) else "(elements - missing)"
            success = f"({checked} = 0 OR ({checked} - unexpected) / {checked} >= CAST({rule.mostly} AS DOUBLE))"
            pct = f"unexpected / nullif({checked}, 0) * 100"
    column = f"'{rule.column}'" if rule.column else _NULL("VARCHAR")
    return (
        f"SELECT '{suite}' AS suite, '{rule.name}' AS rule, {column} AS \"column\", '{rule.params}' AS params, "
        f"elements AS element_count, missing AS missing_count, unexpected AS unexpected_count, "
        f"{pct} AS unexpected_pct, CAST({rule.mostly} AS DOUBLE) AS mostly, {success} AS success, "
        f"{error} AS error FROM ({rule_counts})"
    )


_SILVER_COLUMNS = (
    "question_id title_clean link created_ts created_date last_activity_ts last_activity_date closed_ts "
    "closed_date is_closed is_answered score_filled answer_count_filled view_count_filled content_license "
    "closed_reason owner_user_id owner_display_name sentiment hours_to_close"
).split()
_TABLES = {"raw": (sql.on_raw, RECORD_COLUMNS), "silver": (sql.on_silver, _SILVER_COLUMNS)}


def _suite_selects(table: str, suite: str, rules) -> list[str]:
    return [_rule_sql(suite, table, rule, _TABLES[table][1]) for rule in rules]


def _suite_sql(table: str, suite: str, rules) -> str:
    return _TABLES[table][0](" UNION ALL ".join(_suite_selects(table, suite, rules)))


# --- single rules ---


def _rule_query(name: str, table: str, rules) -> None:
    @query(name, _suite_sql(table, name, rules))
    def run(spark, sf_dir):
        frame = questions_raw(spark, sf_dir) if table == "raw" else _silver(spark, sf_dir)
        return dq.run_suite(frame, name, rules)


_rule_query(
    "dq_column_exists",
    "raw",
    [dq.ColumnExists("question_id"), dq.ColumnExists("title"), dq.ColumnExists("votes"), dq.NotNull("votes")],
)
_rule_query("dq_not_null", "raw", [dq.NotNull(c) for c in ("question_id", "title", "creation_date", "link")])
_rule_query(
    "dq_not_null_mostly",
    "raw",
    [dq.NotNull(c, mostly=MONITORING_MOSTLY) for c in ("title", "creation_date", "content_license")],
)
_rule_query("dq_unique", "raw", [dq.Unique("question_id"), dq.Unique("link")])
_rule_query(
    "dq_in_set",
    "silver",
    [suites.MODEL_TESTS["silver"][-1], dq.InSet("closed_reason", values=("Off-topic", "Unclear"))],
)
_rule_query("dq_row_count", "raw", [suites.BRONZE_STRICT[-1], dq.RowCount(min=0, max=10)])
_rule_query("dq_length", "silver", [dq.LengthBetween("title_clean", min=1, max=300)])


# --- suites and tests ---

_ALL_SUITES = [("raw", n, r) for n, r in suites.BRONZE_SUITES.items()]
_ALL_SUITES += [("silver", n, r) for n, r in suites.SILVER_SUITES.items()]


@query(
    "dq_suite",
    sql.on_silver(" UNION ALL ".join(s for args in _ALL_SUITES for s in _suite_selects(*args))),
)
def dq_suite(spark, sf_dir):
    bronze = dq.run_suites(questions_raw(spark, sf_dir), suites.BRONZE_SUITES)
    return bronze.unionByName(dq.run_suites(_silver(spark, sf_dir), suites.SILVER_SUITES))


@query("dq_results", _suite_sql("silver", "silver_full", suites.SILVER_FULL))
def dq_results(spark, sf_dir):
    path = run_dir(spark, "dq-results")
    dq.write_results(dq.run_suite(_silver(spark, sf_dir), "silver_full", suites.SILVER_FULL), path)
    return spark.read.schema(dq.RESULT_DDL).json(path).drop("run_stamp")


@query(
    "dq_model_tests",
    sql.on_silver(
        "SELECT suite AS model, rule AS test, \"column\", unexpected_count AS failing_rows, "
        "unexpected_count = 0 AS passed FROM ("
        + " UNION ALL ".join(
            s
            for model, table in (("bronze", "raw"), ("silver", "silver"))
            for s in _suite_selects(table, model, suites.MODEL_TESTS[model])
        )
        + ")"
    ),
)
def dq_model_tests(spark, sf_dir):
    raw = questions_raw(spark, sf_dir)
    return dq.run_model_tests(raw, "bronze", suites.MODEL_TESTS["bronze"]).unionByName(
        dq.run_model_tests(models.silver(raw), "silver", suites.MODEL_TESTS["silver"])
    )


def _profile_sql(column: str) -> str:
    return (
        f"SELECT '{column}' AS \"column\", CAST(sum(n) AS BIGINT) AS element_count, "
        f"CAST(coalesce(sum(n) FILTER (v IS NULL), 0) AS BIGINT) AS null_count, count(v) AS distinct_count, "
        f"CAST(coalesce(sum(n) FILTER (v IS NOT NULL AND n > 1), 0) AS BIGINT) AS duplicate_rows, "
        f"coalesce(sum(n) FILTER (v IS NULL), 0) / sum(n) AS null_share "
        f"FROM (SELECT {column} AS v, count(*) AS n FROM raw GROUP BY 1)"
    )


@query("dq_profile", sql.on_raw(" UNION ALL ".join(_profile_sql(c) for c in RECORD_COLUMNS)))
def dq_profile(spark, sf_dir):
    return dq.profile(questions_raw(spark, sf_dir))


@query(
    "dq_failing_rows",
    sql.on_raw(
        """SELECT 'title:not_null' AS rule, link, CAST(NULL AS BIGINT) AS question_id, CAST(1 AS BIGINT) AS n_records
             FROM raw WHERE title IS NULL
           UNION ALL SELECT 'question_id:unique', NULL, question_id, count(*)
             FROM raw WHERE question_id IS NOT NULL GROUP BY question_id HAVING count(*) > 1"""
    ),
)
def dq_failing_rows(spark, sf_dir):
    """Every row that two of the rules object to."""
    raw = questions_raw(spark, sf_dir)
    untitled = dq.failing_rows(raw, dq.NotNull("title")).select(
        F.lit("title:not_null").alias("rule"), "link", F.lit(None).cast("bigint").alias("question_id"), F.lit(1).cast("bigint").alias("n_records")
    )
    repeated = dq.failing_rows(raw, dq.Unique("question_id")).select(
        F.lit("question_id:unique").alias("rule"), F.lit(None).cast("string").alias("link"), "question_id", "n_records"
    )
    return untitled.unionByName(repeated)
