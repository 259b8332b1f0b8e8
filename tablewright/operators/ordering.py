"""Sorting and picking rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.windows import order_column


def sort_rows(df: DataFrame, *order_by: str) -> DataFrame:
    """Sort by ``"date desc"``, ``"id"`` and so on; nulls come last either way.

    Spark range-partitions by all the sort columns, so an id at the end also
    splits a value that many rows share.
    """
    return df.orderBy(*[order_column(o) for o in order_by])


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.limit(rows)


def top_rows(df: DataFrame, rows: int, *order_by: str) -> DataFrame:
    """The first rows in an order; each task keeps only its own best rows."""
    return sort_rows(df, *order_by).limit(rows)


def example_row(df: DataFrame, column: str | None = None, value=None) -> DataFrame:
    """One row with the given value, or any row if no value is given."""
    if column is not None and value is not None:
        df = df.filter(F.col(column) == F.lit(value))
    return df.limit(1)


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return (df.select(*columns) if columns else df).distinct()
