"""Compute costly columns exactly once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_struct_columns(df: DataFrame, struct: Column) -> DataFrame:
    """Add the fields of a struct expression as columns that later steps cannot recompute.

    A filter on a plain projected column is pushed below the projection as a copy of the column's
    expression; with parsing in it, every mention would parse again. A generator over a one-element
    array gives real columns: the filter stays above it. A null struct gives nulls.
    """
    return df.select("*", F.inline(F.array(struct)))


def with_columns_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return with_struct_columns(df, F.struct(*[c.alias(name) for name, c in columns.items()]))
