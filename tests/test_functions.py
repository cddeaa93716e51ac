"""Column functions on hand-made edge rows and against small Python models."""

import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallybrook.functions.metrics import engagement, pct_change
from tallybrook.functions.text import clean_text, has_text
from tallybrook.functions.time import (
    epoch_date,
    epoch_hour,
    epoch_ts,
    hours_between,
    to_epoch,
)

FEW = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def column(spark, rows, ddl, *expressions):
    frame = spark.createDataFrame(rows, ddl)
    return [tuple(r) for r in frame.select(*expressions).collect()]


def test_clean_text_edges(spark):
    texts = ["C++ vs. C#: Čaj", "???", "\t\n", " ", None, "a_b\x0bc", "x😀y"]
    rows = column(
        spark, [(t,) for t in texts], "t string", clean_text(F.col("t")), has_text(F.col("t"))
    )
    assert rows == [
        ("C vs C aj", True), ("", True), ("", False), ("", False), (None, False), ("a b c", True),
        ("x y", True),
    ]


@FEW
@given(st.lists(st.text(), min_size=30, max_size=60))
def test_clean_text_is_the_two_step_definition(spark, texts):
    got = column(spark, [(t,) for t in texts], "t string", clean_text(F.col("t")))

    def model(t):
        blanked = re.sub(r"[^A-Za-z0-9\t\n\f\r ]", " ", t)
        return re.sub(r"[\t\n\f\r ]+", " ", blanked).strip(" ")

    assert [r[0] for r in got] == [model(t) for t in texts]


def test_times_ignore_the_session_zone(spark):
    gap = dt.datetime(2024, 3, 10, 2, 30)  # does not exist in New York
    seconds = int(gap.replace(tzinfo=dt.timezone.utc).timestamp())
    c = F.col("s")
    rows = column(
        spark, [(seconds,), (1000,), (-1,), (None,)], "s bigint",
        epoch_ts(c), epoch_date(c), epoch_hour(c), to_epoch(epoch_ts(c)),
    )
    assert rows == [
        (gap, dt.date(2024, 3, 10), dt.datetime(2024, 3, 10, 2), seconds),
        (dt.datetime(1970, 1, 1, 0, 16, 40), dt.date(1970, 1, 1), dt.datetime(1970, 1, 1), 1000),
        (dt.datetime(1969, 12, 31, 23, 59, 59), dt.date(1969, 12, 31), dt.datetime(1969, 12, 31, 23), -1),
        (None, None, None, None),
    ]


def test_hours_between_edges(spark):
    pairs = [(3599, 3601), (0, 7201), (7201, 0), (5, None)]
    rows = column(spark, pairs, "a bigint, b bigint", hours_between(F.col("a"), F.col("b")))
    assert [r[0] for r in rows] == [0, 2, -2, None]


EPOCHS = st.integers(-(10**10), 10**10)


@FEW
@given(st.lists(st.tuples(EPOCHS, EPOCHS), min_size=30, max_size=60))
def test_hours_between_truncates_toward_zero(spark, pairs):
    rows = column(spark, pairs, "a bigint, b bigint", hours_between(F.col("a"), F.col("b")))
    assert [r[0] for r in rows] == [
        abs(b - a) // 3600 * (1 if b >= a else -1) for a, b in pairs
    ]


def test_engagement_edges(spark):
    values = [(1000, 0, -9), (0, 5, -9), (999, 4, 5), (0, 0, -1), (0, 0, 0), (None, None, None)]
    rows = column(
        spark, values, "v bigint, a bigint, s bigint", engagement(F.col("v"), F.col("a"), F.col("s"))
    )
    assert [r[0] for r in rows] == [
        "HIGH_ENGAGEMENT", "HIGH_ENGAGEMENT", "POSITIVE", "NEGATIVE", "NEUTRAL", "NEUTRAL",
    ]


COUNTS = st.one_of(st.none(), st.integers(-20, 1100))


@FEW
@given(st.lists(st.tuples(COUNTS, COUNTS, COUNTS), min_size=30, max_size=60))
def test_engagement_first_match_wins(spark, values):
    rows = column(
        spark, values, "v bigint, a bigint, s bigint", engagement(F.col("v"), F.col("a"), F.col("s"))
    )

    def model(v, a, s):
        v, a, s = v or 0, a or 0, s or 0
        if v >= 1000 or a >= 5:
            return "HIGH_ENGAGEMENT"
        return "POSITIVE" if s >= 5 else "NEGATIVE" if s < 0 else "NEUTRAL"

    assert [r[0] for r in rows] == [model(*v) for v in values]


def test_pct_change_edges(spark):
    pairs = [(2, None), (2, 0), (3, 2)]
    rows = column(spark, pairs, "c bigint, p bigint", pct_change(F.col("c"), F.col("p")))
    assert [r[0] for r in rows] == [None, None, 50.0]
