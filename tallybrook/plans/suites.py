"""The quality suites and model tests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from tallybrook.fixed_values import (
    ENGAGEMENT_LABELS,
    MONITORING_MOSTLY,
    ROW_COUNT_MAX,
    ROW_COUNT_MIN,
)
from tallybrook.operators.quality import ColumnExists, InSet, NotNull, RowCount, Rule, Unique

_VOLUME = RowCount(min=ROW_COUNT_MIN, max=ROW_COUNT_MAX)
_LABELS = InSet("sentiment", values=ENGAGEMENT_LABELS)


def _exists_and_filled(*columns: str) -> list:
    return [rule(c) for c in columns for rule in (ColumnExists, NotNull)]


BRONZE_STRICT = (*_exists_and_filled("question_id", "creation_date", "title"), _VOLUME)

BRONZE_MONITORING = (
    ColumnExists("question_id"),
    ColumnExists("creation_date"),
    ColumnExists("title"),
    _VOLUME,
    Unique("question_id"),
    NotNull("creation_date", mostly=MONITORING_MOSTLY),
    NotNull("title", mostly=MONITORING_MOSTLY),
)

SILVER_STRICT = (
    *_exists_and_filled("question_id", "created_ts", "is_closed"),
    ColumnExists("sentiment"),
    _LABELS,
)

SILVER_FULL = (
    *_exists_and_filled("question_id", "sentiment", "title_clean"),
    Unique("question_id"),
    _LABELS,
)

BRONZE_SUITES = {"bronze_strict": BRONZE_STRICT, "bronze_monitoring": BRONZE_MONITORING}
SILVER_SUITES = {"silver_strict": SILVER_STRICT, "silver_full": SILVER_FULL}

# Tests attached to the models; a test passes when no row fails it.
MODEL_TESTS = {
    "bronze": (NotNull("question_id"), NotNull("creation_date"), NotNull("title")),
    "silver": (
        NotNull("question_id"),
        Unique("question_id"),
        NotNull("created_ts"),
        NotNull("created_date"),
        NotNull("last_activity_date"),
        NotNull("title_clean"),
        NotNull("is_closed"),
        NotNull("sentiment"),
        _LABELS,
    ),
}


def with_max_rows(suites: Mapping[str, Sequence[Rule]], most: int) -> dict[str, tuple[Rule, ...]]:
    """The suites with another limit on the row count, for tables that outgrow the default."""
    return {
        name: tuple(replace(rule, max=most) if isinstance(rule, RowCount) else rule for rule in rules)
        for name, rules in suites.items()
    }
