"""Epoch seconds and UTC time without the session time zone.

Everything is ``timestamp_ntz``: casts through zoned timestamps would move rows to another hour or
day whenever the session zone is not UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybrook import fixed_values as fv

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
SECONDS_PER_HOUR = 3600


def epoch_ts(seconds: Column) -> Column:
    """Epoch seconds as a UTC ``timestamp_ntz``."""
    return F.timestamp_add("SECOND", seconds, F.expr(_EPOCH))


def in_epoch_range(seconds: Column) -> Column:
    """The seconds where a timestamp can hold them, else null."""
    return F.when(seconds.between(fv.EPOCH_MIN, fv.EPOCH_MAX), seconds)


def epoch_date(seconds: Column) -> Column:
    """Epoch seconds as a UTC date."""
    return epoch_ts(seconds).cast("date")


def epoch_hour(seconds: Column) -> Column:
    """Start of the UTC hour; floors before 1970 too. (``date_trunc`` would apply the session zone.)"""
    return epoch_ts(seconds - F.pmod(seconds, F.lit(SECONDS_PER_HOUR)))


def to_epoch(ts: Column) -> Column:
    """UTC ``timestamp_ntz`` back to whole epoch seconds.

    Built from date and clock parts, which read the value as it stands; ``timestamp_diff`` would
    first move it through the session zone and lose hours in daylight-saving gaps.
    """
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * SECONDS_PER_HOUR + F.minute(ts) * 60 + F.second(ts)


def hours_between(start: Column, end: Column) -> Column:
    """Whole hours from one epoch to another, truncated toward zero; may be negative."""
    return F.call_function("div", end - start, F.lit(SECONDS_PER_HOUR))


def now_seconds() -> Column:
    return F.unix_seconds(F.current_timestamp())
