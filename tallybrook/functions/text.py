"""Text clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_text(text: Column) -> Column:
    """ASCII letters and digits, single spaces between, none at the ends.

    Blanking every other character and then squeezing white space is the same as replacing each run
    of other characters by one space, so one pass over the text is enough. ``\\P{Alnum}`` is Java's
    ASCII class; spelled as a union of ranges the same pattern runs over ten times slower when
    several tasks share a JVM.
    """
    return F.trim(F.regexp_replace(text, r"\P{Alnum}+", " "))


def has_text(text: Column) -> Column:
    """True unless null, empty or Unicode white space only. Never null.

    ``trim`` would strip U+0020 only; the flag makes ``\\S`` use the Unicode White_Space property.
    """
    return F.coalesce(text.rlike(r"(?U)\S"), F.lit(False))
