"""Data-quality rules, run over a whole frame in one pass."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT_COLUMNS = (
    "suite", "rule", "column", "params", "element_count", "missing_count",
    "unexpected_count", "unexpected_pct", "mostly", "success", "error",
)




@dataclass(frozen=True)
class Rule:
    """A check on one column; ``mostly`` is the share of non-null values that must pass."""

    column: str | None
    mostly: float = 1.0

    def unexpected(self) -> Column | None:
        """True for a failing row, for rules that look at one row at a time."""
        return None

    @property
    def name(self) -> str:
        return type(self).__name__

    @property
    def params(self) -> str:
        extra = {k: v for k, v in asdict(self).items() if k not in ("column", "mostly")}
        return json.dumps(extra)


class ColumnExists(Rule):
    pass


class NotNull(Rule):
    def unexpected(self) -> Column:
        return F.col(self.column).isNull()


class Unique(Rule):
    """Every row of a value that occurs more than once fails; nulls are ignored."""


@dataclass(frozen=True)
class InSet(Rule):
    values: tuple = ()

    def unexpected(self) -> Column:
        return F.col(self.column).isNotNull() & ~F.col(self.column).isin(*self.values)


@dataclass(frozen=True)
class LengthBetween(Rule):
    min: int = 0
    max: int | None = None

    def unexpected(self) -> Column:
        length = F.length(self.column)
        outside = length < self.min
        if self.max is not None:
            outside = outside | (length > self.max)
        return F.coalesce(outside, F.lit(False))


@dataclass(frozen=True)
class RowCount(Rule):
    column: str | None = None
    min: int = 0
    max: int | None = None


def _measures(rules: Sequence[Rule]) -> dict[str, Column]:
    """Per-row indicators whose counts the rules need, shared between rules on one column."""
    measures = {}
    for i, rule in enumerate(rules):
        if rule.column and not isinstance(rule, ColumnExists):
            measures[f"missing:{rule.column}"] = F.col(rule.column).isNull()
        if rule.unexpected() is not None:
            measures[f"unexpected:{i}"] = rule.unexpected()
    return measures


def _totals(df: DataFrame, rules: Sequence[Rule], unique: Rule | None) -> DataFrame:
    """One row with the element count and the count of every measure.

    With a uniqueness rule the rows are first grouped by its column, which gives the duplicates and
    the other counts from the same scan. Partial aggregation keeps a hot value to one row per task.
    """
    measures = _measures(rules)
    if unique is None:
        return df.agg(
            F.count("*").alias("elements"),
            *[F.count_if(flag).alias(name) for name, flag in measures.items()],
        )
    groups = df.groupBy(F.col(unique.column).alias("_value")).agg(
        F.count("*").alias("elements"),
        *[F.count_if(flag).alias(name) for name, flag in measures.items()],
    )
    repeated = F.col("_value").isNotNull() & (F.col("elements") > 1)

    def total(column: Column) -> Column:
        return F.coalesce(F.sum(column), F.lit(0))

    return groups.agg(
        total(F.when(repeated, F.col("elements"))).alias("repeated"),
        *[total(F.col(f"`{c}`")).alias(c) for c in ("elements", *measures)],
    )


def _result_row(suite: str, i: int, rule: Rule) -> Column:
    elements = F.col("elements")
    missing = unexpected = checked = F.lit(None).cast("bigint")
    success = F.lit(True)
    if isinstance(rule, RowCount):
        success = elements >= rule.min
        if rule.max is not None:
            success = success & (elements <= rule.max)
    elif not isinstance(rule, ColumnExists):
        missing = F.col(f"`missing:{rule.column}`")
        unexpected = F.col("repeated") if isinstance(rule, Unique) else F.col(f"`unexpected:{i}`")
        checked = elements if isinstance(rule, NotNull) else elements - missing
        success = F.coalesce(F.try_divide(checked - unexpected, checked) >= rule.mostly, F.lit(True))
    return _row(
        suite, rule, elements, missing, unexpected, F.try_divide(unexpected, checked) * 100, success
    )


def _row(suite, rule, elements, missing, unexpected, pct, success, error=None) -> Column:
    values = (
        F.lit(suite), F.lit(rule.name), F.lit(rule.column).cast("string"), F.lit(rule.params),
        elements, missing, unexpected, pct, F.lit(float(rule.mostly)), success,
        F.lit(error).cast("string"),
    )
    return F.struct(*[v.alias(n) for n, v in zip(RESULT_COLUMNS, values)])


def run_suites(df: DataFrame, suites: Mapping[str, Sequence[Rule]]) -> DataFrame:
    """One result row per suite and rule, from one scan and without bringing data to the driver.

    A rule on a column that does not exist fails with an error and does not stop the suite. Rules
    that occur in several suites are measured once. Uniqueness of a second column needs an
    aggregation of its own over that column.
    """
    asked = [(suite, rule) for suite, rules in suites.items() for rule in rules]
    lost = [(s, r) for s, r in asked if r.column is not None and r.column not in df.columns]
    present = [(s, r) for s, r in asked if (s, r) not in lost]
    unique_columns = list(dict.fromkeys(r.column for _, r in present if isinstance(r, Unique)))
    own = unique_columns[1:]

    def results(group: Sequence[tuple[str, Rule]], lost: Sequence[tuple[str, Rule]] = ()) -> DataFrame:
        rules = list(dict.fromkeys(rule for _, rule in group))
        unique = next((r for r in rules if isinstance(r, Unique)), None)
        rows = [_result_row(suite, rules.index(rule), rule) for suite, rule in group]
        null, none = F.lit(None).cast("bigint"), F.lit(None).cast("double")
        rows += [
            _row(suite, r, F.col("elements"), null, null, none, F.lit(False),
                 f"column not found: {r.column}")
            for suite, r in lost
        ]
        return _totals(df, rules, unique).select(F.inline(F.array(*rows)))

    shared = [(s, r) for s, r in present if not (isinstance(r, Unique) and r.column in own)]
    frames = [results(shared, lost)]
    frames += [
        results([(s, r) for s, r in present if isinstance(r, Unique) and r.column == column])
        for column in own
    ]
    return reduce(DataFrame.unionByName, frames)


def run_suite(df: DataFrame, suite: str, rules: Sequence[Rule]) -> DataFrame:
    """One result row per rule of a single suite."""
    return run_suites(df, {suite: rules})


def suite_success(results: DataFrame) -> DataFrame:
    """``suite, success``: a suite passes when all its rules do."""
    return results.groupBy("suite").agg(F.bool_and("success").alias("success"))


def failing_rows(df: DataFrame, rule: Rule) -> DataFrame:
    """The rows a rule objects to; for uniqueness, each repeated value once with ``n_records``."""
    if isinstance(rule, Unique):
        counts = df.groupBy(rule.column).agg(F.count("*").alias("n_records"))
        return counts.filter(F.col(rule.column).isNotNull() & (F.col("n_records") > 1))
    if rule.unexpected() is None:
        raise ValueError(f"{rule.name} does not look at rows")
    return df.filter(rule.unexpected())


def run_model_tests(df: DataFrame, model: str, tests: Sequence[Rule]) -> DataFrame:
    """``model, test, column, failing_rows, passed`` from one scan; ``failing_rows`` lists them."""
    return run_suite(df, model, tests).select(
        F.col("suite").alias("model"),
        F.col("rule").alias("test"),
        "column",
        F.col("unexpected_count").alias("failing_rows"),
        (F.col("unexpected_count") == 0).alias("passed"),
    )


def write_results(results: DataFrame, path: str, at: datetime | None = None) -> str:
    """Append the results as JSON under a UTC run stamp, which is returned. A stamp made here is no
    other run's; ``at`` gives a stamp of one's own."""
    if at is not None:
        stamp = at.strftime("%Y%m%dT%H%M%SZ")
    else:
        stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S.%fZ-") + uuid.uuid4().hex[:8]
    stamped = results.withColumn("run_stamp", F.lit(stamp))
    (
        stamped.coalesce(1)
        .write.mode("append")
        .partitionBy("run_stamp")
        .option("ignoreNullFields", "false")
        .json(path)
    )
    return stamp


RESULT_DDL = (
    "suite string, rule string, column string, params string, element_count bigint, "
    "missing_count bigint, unexpected_count bigint, unexpected_pct double, mostly double, "
    "success boolean, error string, run_stamp string"
)


def schema_drift(df: DataFrame, expected: T.StructType) -> list[tuple[str, str]]:
    """(column, missing | unexpected | now <type>) for every difference; reads the schema only."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    wanted = {f.name: f.dataType.simpleString() for f in expected}
    drift = [(c, "missing") for c in wanted if c not in actual]
    drift += [(c, "unexpected") for c in actual if c not in wanted]
    drift += [(c, f"now {actual[c]}") for c in wanted if c in actual and actual[c] != wanted[c]]
    return drift


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: rows, nulls, null share, distinct values and rows with a repeated value.

    Whole-number columns share one scan and one shuffle of (column, value) counts, all others
    another, each reading only its columns. Counts are combined in each task first, so frequent
    values and nulls cost one row per task. Every text is counted under the SHA-256 of the whole of
    it: texts are compared in full but not shuffled, and no text can pass for another's hash.
    """
    columns = list(columns or df.columns)
    whole = [c for c in columns if isinstance(df.schema[c].dataType, T.IntegralType)]
    others = [c for c in columns if c not in whole]

    def as_text(column: str) -> Column:
        text = F.col(column).cast("string")
        if not isinstance(df.schema[column].dataType, T.StringType):
            return text
        return F.sha2(text, 256)

    parts = []
    if whole:
        parts.append(_value_stats(df, {c: F.col(c).cast("bigint") for c in whole}))
    if others:
        parts.append(_value_stats(df, {c: as_text(c) for c in others}))
    stats = reduce(DataFrame.unionByName, parts)
    return stats.withColumn("null_share", F.try_divide("null_count", "element_count"))


def _value_stats(df: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    """Counts per column of same-typed keys. Columns go by number until the end, to keep rows narrow."""
    names = list(keys)
    numbered = df.select(*[key.alias(str(i)) for i, key in enumerate(keys.values())])
    values = numbered.unpivot([], numbered.columns, "at", "value").select(F.col("at").cast("int"), "value")
    counts = values.groupBy("at", "value").agg(F.count("*").alias("n"))
    known = F.col("value").isNotNull()

    def total(column: Column) -> Column:
        return F.coalesce(F.sum(column), F.lit(0))

    per_column = counts.groupBy("at").agg(
        F.sum("n").alias("element_count"),
        total(F.when(~known, F.col("n"))).alias("null_count"),
        F.count("value").alias("distinct_count"),
        total(F.when(known & (F.col("n") > 1), F.col("n"))).alias("duplicate_rows"),
    )
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("at") + 1)
    return per_column.select(name.alias("column"), *[c for c in per_column.columns if c != "at"])
