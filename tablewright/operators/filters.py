"""Row filters. All of them reach the file scan as pushed-down predicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions import compare

# Fixed value: the smallest sale, in whole dollars, that counts as high value.
HIGH_VALUE_MINIMUM = 30_000_000


def filter_number(df: DataFrame, column: str, threshold, op: str = ">=") -> DataFrame:
    """Keep rows where the comparison holds; null rows drop."""
    return df.filter(compare(column, op, threshold))


def drop_rows(df: DataFrame, condition: Column | str) -> DataFrame:
    """Remove the rows that match, and those where the condition is unknown."""
    return df.filter(~(F.expr(condition) if isinstance(condition, str) else condition))


def high_value(df: DataFrame, column: str, minimum=HIGH_VALUE_MINIMUM) -> DataFrame:
    return filter_number(df, column, minimum, ">=")


def keep_members(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Keep rows whose value is in a literal set; for a table use ``semi_join``."""
    return df.filter(F.col(column).isin(*values))


def drop_nulls(df: DataFrame, *columns: str) -> DataFrame:
    """Remove rows where any of the columns (or of all columns) is null."""
    return df.dropna(subset=list(columns) or None)


def contains_rows(df: DataFrame, column: str, text: str) -> DataFrame:
    return df.filter(F.contains(F.col(column), F.lit(text)))
