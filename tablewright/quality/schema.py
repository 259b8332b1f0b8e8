"""Typed table schemas, checked in one pass.

A schema is a list of fields. Each field turns into boolean Columns, one for
each rule, so a table of any size is checked where its rows lie: rows are
flagged, never numbered and never collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from dataclasses import field as dataclass_field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.session import stage

ERROR_TYPE = "struct<`column`:string,`check`:string,failure_case:string>"
ERRORS = "_errors"


@dataclass(frozen=True)
class Field:
    """A column's type and rules. Null is an error unless ``nullable``."""

    data_type: str | None = None
    nullable: bool = False
    gt: float | None = None
    ge: float | None = None
    lt: float | None = None
    le: float | None = None
    eq: object = None
    isin: Sequence | None = None
    str_matches: str | None = None

    def rules(self, value: Column) -> list[tuple[str, Column]]:
        """``(check name, condition that is true for a failure)``."""
        found = []
        if not self.nullable:
            found.append(("not_nullable", value.isNull()))
        if self.gt is not None:
            found.append((f"greater_than({self.gt})", ~(value > F.lit(self.gt))))
        if self.ge is not None:
            found.append((f"greater_than_or_equal_to({self.ge})", ~(value >= F.lit(self.ge))))
        if self.lt is not None:
            found.append((f"less_than({self.lt})", ~(value < F.lit(self.lt))))
        if self.le is not None:
            found.append((f"less_than_or_equal_to({self.le})", ~(value <= F.lit(self.le))))
        if self.eq is not None:
            found.append((f"equal_to({self.eq})", ~(value == F.lit(self.eq))))
        if self.isin is not None:
            found.append((f"isin({list(self.isin)})", ~value.isin(*self.isin)))
        if self.str_matches is not None:
            # the pattern has to match from the first character on
            pattern = f"^(?:{self.str_matches})"
            found.append((f"str_matches('{self.str_matches}')", ~F.regexp_like(value, F.lit(pattern))))
        return found


@dataclass(frozen=True)
class TableSchema:
    """Fields by column name.

    ``coerce`` casts columns to their types first; a value that cannot be cast is
    an error of its row. ``strict`` is ``False`` (other columns may stay),
    ``True`` (other columns are an error) or ``"filter"`` (other columns go).
    """

    name: str
    fields: Mapping[str, Field] = dataclass_field(default_factory=dict)
    coerce: bool = True
    strict: bool | str = False

    def __post_init__(self):
        if self.strict not in (True, False, "filter"):
            raise ValueError('strict must be True, False or "filter"')


def schema_errors(df: DataFrame, schema: TableSchema) -> list[tuple[str, str, str]]:
    """``(column, check, failure case)`` for the columns themselves; reads no data."""
    errors = [
        (schema.name, "column_in_dataframe", c) for c in schema.fields if c not in df.columns
    ]
    if schema.strict is True:
        errors += [
            (schema.name, "column_in_schema", c) for c in df.columns if c not in schema.fields
        ]
    if not schema.coerce:
        actual = dict(df.dtypes)
        errors += [
            (c, f"dtype('{f.data_type}')", actual[c])
            for c, f in schema.fields.items()
            if f.data_type and c in actual and actual[c] != f.data_type
        ]
    return errors


@dataclass(frozen=True)
class _Rule:
    column: str
    check: str
    failed: Column
    case: Column


def _prepare(df: DataFrame, schema: TableSchema) -> tuple[DataFrame, list[_Rule], list[str]]:
    """The coerced table, with raw values kept aside where a cast may fail, and its rules."""
    fields = {c: f for c, f in schema.fields.items() if c in df.columns}
    kept = [c for c in df.columns if schema.strict != "filter" or c in fields]
    actual = dict(df.dtypes)
    casts = {
        c: f for c, f in fields.items() if schema.coerce and f.data_type and actual[c] != f.data_type
    }
    raw = {c: f"__raw_{i}" for i, c in enumerate(casts)}
    values = [
        F.col(c).try_cast(casts[c].data_type).alias(c) if c in casts else F.col(c) for c in kept
    ]
    table = df.select(*values, *[F.col(c).cast("string").alias(r) for c, r in raw.items()])
    rules = []
    for name, field in fields.items():
        value = F.col(name)
        uncast = F.lit(False)
        if name in casts:
            original = F.col(raw[name])
            uncast = value.isNull() & original.isNotNull()
            rules.append(_Rule(name, f"coerce_dtype('{field.data_type}')", uncast, original))
        for check, failed in field.rules(value):
            if check == "not_nullable" and name in casts:
                failed = failed & ~uncast
            # an unknown comparison (a null) is not a failure
            rules.append(
                _Rule(name, check, F.coalesce(failed, F.lit(False)), value.cast("string"))
            )
    return table, rules, kept


def _any(rules: list[_Rule]) -> Column:
    return reduce(lambda x, y: x | y, [r.failed for r in rules], F.lit(False))


def _entries(rules: list[_Rule]) -> Column:
    if not rules:
        return F.array().cast(f"array<{ERROR_TYPE}>")
    return F.array(
        *[
            F.when(
                r.failed,
                F.struct(
                    F.lit(r.column).alias("column"),
                    F.lit(r.check).alias("check"),
                    r.case.alias("failure_case"),
                ),
            )
            for r in rules
        ]
    )


def check_rows(df: DataFrame, schema: TableSchema) -> DataFrame:
    """The (coerced) rows with ``_errors``: the failed rules of each row."""
    table, rules, kept = _prepare(df, schema)
    return table.select(*kept, F.array_compact(_entries(rules)).alias(ERRORS))


def error_table(
    df: DataFrame, schema: TableSchema, keep: Sequence[str] = ()
) -> DataFrame:
    """One row for each failed rule of each row: column, check, failure case.

    ``keep`` names columns, such as an id, to carry along. Only rows that fail
    are expanded.
    """
    table, rules, _ = _prepare(df, schema)
    return (
        table.filter(_any(rules))
        .select(*keep, F.explode(_entries(rules)).alias("__error"))
        .filter(F.col("__error").isNotNull())
        .select(*keep, "__error.*")
    )


def validation_report(df: DataFrame, schema: TableSchema) -> DataFrame:
    """Failures by column and check, from one aggregate.

    Besides the rules that failed there is one row for ``*``: ``rows`` gives
    the record count and ``invalid_rows`` the rows with at least one error.
    """
    table, rules, _ = _prepare(df, schema)
    counts = [F.count_if(r.failed).alias(f"f{i}") for i, r in enumerate(rules)]
    totals = table.agg(
        *counts,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(_any(rules)).alias("invalid_rows"),
    )
    lines = [(r.column, r.check, F.col(f"f{i}")) for i, r in enumerate(rules)]
    lines += [("*", "rows", F.col("rows")), ("*", "invalid_rows", F.col("invalid_rows"))]
    lines += [(c, f"{check}: {case}", F.lit(1).cast("long")) for c, check, case in schema_errors(df, schema)]
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"), F.lit(check).alias("check"), n.alias("failures")
            )
            for c, check, n in lines
        ]
    )
    report = totals.select(F.explode(entries).alias("line")).select("line.*")
    return report.filter((F.col("failures") > 0) | (F.col("column") == "*"))


@dataclass(frozen=True)
class ValidationResult:
    """Counts are from one aggregate; ``errors`` and ``rows`` stay lazy.

    ``rows`` holds the (coerced) rows with their failed rules in ``_errors``.
    """

    valid: bool
    record_count: int
    error_count: int
    invalid_rows: int
    column_errors: list[tuple[str, str, str]]
    errors: DataFrame
    rows: DataFrame


def validate(df: DataFrame, schema: TableSchema, keep: Sequence[str] = ()) -> ValidationResult:
    """Check every rule on every row and report all failures."""
    table, rules, _ = _prepare(df, schema)
    column_errors = schema_errors(df, schema)
    failures = reduce(lambda x, y: x + y, [r.failed.cast("long") for r in rules], F.lit(0).cast("long"))
    row = table.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(failures), F.lit(0)), F.count_if(_any(rules))
    ).first()
    errors = error_table(df, schema, keep)
    return ValidationResult(
        valid=not column_errors and row[1] == 0,
        record_count=row[0],
        error_count=row[1] + len(column_errors),
        invalid_rows=row[2],
        column_errors=column_errors,
        errors=errors,
        rows=check_rows(df, schema),
    )


def valid_rows(df: DataFrame, schema: TableSchema) -> DataFrame:
    """The (coerced) rows without errors."""
    table, rules, kept = _prepare(df, schema)
    return table.filter(~_any(rules)).select(*kept)


def invalid_rows(df: DataFrame, schema: TableSchema) -> DataFrame:
    """The rows with errors, with the failed rules in ``_errors``."""
    return check_rows(df, schema).filter(F.size(ERRORS) > 0)


def remove_invalid(df: DataFrame, schema: TableSchema) -> tuple[DataFrame, int]:
    """The rows without errors, and how many were left out.

    The input is read once: its rows are stored with a flag, and both results
    come from there.
    """
    table, rules, kept = _prepare(df, schema)
    flagged = stage(table.withColumn("__wrong", _any(rules)), "checked-rows")
    removed = flagged.filter("__wrong").count()
    return flagged.filter(~F.col("__wrong")).select(*kept), removed
