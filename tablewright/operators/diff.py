"""Comparison of two tables as multisets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.aggregates import quoted


@dataclass(frozen=True)
class TableDiff:
    """``rows`` holds each differing row once, with its count on both sides."""

    missing_columns: list[str]
    extra_columns: list[str]
    rows: DataFrame | None

    def matches(self) -> bool:
        if self.missing_columns or self.extra_columns or self.rows is None:
            return False
        return self.rows.isEmpty()


def diff_tables(left: DataFrame, right: DataFrame) -> TableDiff:
    """Compare on the common columns, ignoring order but not repetition.

    Equal rows fold to one row with two counts before the shuffle, so a table
    that is one row many times over costs no more than any other. Null equals
    null and NaN equals NaN.
    """
    common = [c for c in left.columns if c in right.columns]
    missing = [c for c in left.columns if c not in right.columns]
    extra = [c for c in right.columns if c not in left.columns]
    if not common:
        return TableDiff(missing, extra, None)
    names = [quoted(c) for c in common]
    sides = left.select(*names, F.lit(1).alias("__left")).unionByName(
        right.select(*names, F.lit(0).alias("__left"))
    )
    rows = (
        sides.groupBy(*names)
        .agg(
            F.sum("__left").alias("left_count"),
            F.sum(1 - F.col("__left")).alias("right_count"),
        )
        .filter(F.col("left_count") != F.col("right_count"))
    )
    return TableDiff(missing, extra, rows)
