"""Composition of table transforms into one plan."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Protocol, runtime_checkable

from pyspark.sql import DataFrame

from tablewright.functions.conditional import COMPARISONS
from tablewright.operators.aggregates import aggregate
from tablewright.operators.columns import TEXT_TRANSFORMS, transform_text
from tablewright.operators.filters import filter_number
from tablewright.operators.joins import join_chain
from tablewright.operators.sql import sql_transform
from tablewright.operators.windows import window_columns


@runtime_checkable
class Step(Protocol):
    """Anything with ``apply(df) -> df``; a plain function will do as well."""

    def apply(self, df: DataFrame) -> DataFrame: ...


@dataclass(frozen=True)
class Chain:
    """Ordered steps that Catalyst sees as one plan; no job runs in between."""

    steps: Sequence[Step | Callable[[DataFrame], DataFrame]]

    def __post_init__(self):
        if not self.steps:
            raise ValueError("a chain needs at least one step")
        for step in self.steps:
            if not isinstance(step, Step) and not callable(step):
                raise TypeError(f"{type(step).__name__} has no apply(df) and is not callable")

    def apply(self, df: DataFrame) -> DataFrame:
        return reduce(
            lambda d, s: s.apply(d) if isinstance(s, Step) else d.transform(s), self.steps, df
        )


@dataclass(frozen=True)
class TextStep:
    column: str
    how: str = "upper"

    def __post_init__(self):
        if self.how not in TEXT_TRANSFORMS:
            raise ValueError(f"unknown transform {self.how!r}")

    def apply(self, df: DataFrame) -> DataFrame:
        return transform_text(df, self.column, self.how)


@dataclass(frozen=True)
class FilterStep:
    column: str
    threshold: float
    op: str = ">="

    def __post_init__(self):
        if self.op not in COMPARISONS:
            raise ValueError(f"unknown operator {self.op!r}")

    def apply(self, df: DataFrame) -> DataFrame:
        return filter_number(df, self.column, self.threshold, self.op)


@dataclass(frozen=True)
class SqlStep:
    sql: str
    tables: Mapping[str, DataFrame] | None = None

    def apply(self, df: DataFrame) -> DataFrame:
        return sql_transform(df, self.sql, self.tables)


@dataclass(frozen=True)
class WindowStep:
    expressions: Mapping[str, str]

    def apply(self, df: DataFrame) -> DataFrame:
        return window_columns(df, self.expressions)


@dataclass(frozen=True)
class AggregateStep:
    keys: Sequence[str]
    measures: Mapping[str, str]

    def apply(self, df: DataFrame) -> DataFrame:
        return aggregate(df, self.keys, self.measures)


@dataclass(frozen=True)
class JoinStep:
    joins: Sequence[tuple[DataFrame, str, str]]
    select: Sequence[str] = ("*",)
    how: str = "left"

    def apply(self, df: DataFrame) -> DataFrame:
        return join_chain(df, self.joins, self.select, self.how)
