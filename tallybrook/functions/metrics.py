"""Derived measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybrook import fixed_values as fv


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def engagement(views: Column, answers: Column, score: Column) -> Column:
    """Engagement label; nulls count as 0 and the first matching rule wins."""
    views, answers, score = zero_if_null(views), zero_if_null(answers), zero_if_null(score)
    return (
        F.when((views >= fv.HIGH_VIEWS) | (answers >= fv.HIGH_ANSWERS), fv.HIGH_ENGAGEMENT)
        .when(score >= fv.POSITIVE_SCORE, fv.POSITIVE)
        .when(score < 0, fv.NEGATIVE)
        .otherwise(fv.NEUTRAL)
    )


def pct_change(current: Column, previous: Column) -> Column:
    """Percent change; null when there is no previous value or it is 0."""
    return F.try_divide(current - previous, previous) * 100
