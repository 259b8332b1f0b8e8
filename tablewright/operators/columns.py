"""Column shaping: which columns a table has, and under which names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.errors import MissingColumn
from tablewright.functions import strip, title_case


def _check(df: DataFrame, names, caller: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise MissingColumn(caller, missing, df.columns)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    _check(df, mapping, "rename")
    return df.withColumnsRenamed(dict(mapping))


def keep_only(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The listed columns, in the listed order."""
    _check(df, names, "keep_only")
    return df.select(*names)


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    _check(df, names, "drop_columns")
    return df.drop(*names)


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Drop the columns that are null in every row.

    The only operator whose schema depends on the data: it runs one aggregate
    that returns a single row. Not available on streams. An empty table loses
    all its columns.
    """
    if df.isStreaming:
        raise ValueError("drop_null_columns needs a batch table")
    # a numbered alias keeps names with dots out of the aggregate
    filled = [F.max(F.col(f"`{c}`").isNotNull()).alias(str(i)) for i, c in enumerate(df.columns)]
    row = df.agg(*filled).first()
    return df.select(*[F.col(f"`{c}`") for i, c in enumerate(df.columns) if row[i]])


def copy_column(df: DataFrame, source: str, target: str) -> DataFrame:
    return df.withColumn(target, F.col(source))


def add_constant(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def move_renamed_last(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns and put them at the end, in the order of the mapping."""
    _check(df, mapping, "move_renamed_last")
    kept = [F.col(c) for c in df.columns if c not in mapping]
    return df.select(*kept, *[F.col(old).alias(new) for old, new in mapping.items()])


def replace_in_place(df: DataFrame, replacements: Mapping[str, Column | str]) -> DataFrame:
    """New values for existing columns, which keep their positions."""
    _check(df, replacements, "replace_in_place")
    exprs = {k: F.expr(v) if isinstance(v, str) else v for k, v in replacements.items()}
    return df.withColumns(exprs)


TEXT_TRANSFORMS = {"upper": F.upper, "lower": F.lower, "title": title_case, "strip": strip}


def transform_text(df: DataFrame, column: str, how: str = "upper") -> DataFrame:
    """Apply ``upper``, ``lower``, ``title`` or ``strip`` to one column."""
    if how not in TEXT_TRANSFORMS:
        raise ValueError(f"unknown transform {how!r}; use one of {', '.join(TEXT_TRANSFORMS)}")
    return df.withColumn(column, TEXT_TRANSFORMS[how](F.col(column)))


def uppercase_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Upper-case the named text columns in one projection."""
    return df.withColumns({c: F.upper(F.col(c)) for c in columns})


def explode_list(df: DataFrame, column: str, keep_empty: bool = False) -> DataFrame:
    """One row per list element, under the same name.

    ``keep_empty`` keeps one row with a null for an empty or missing list.
    """
    unnest = F.explode_outer if keep_empty else F.explode
    return df.withColumn(column, unnest(F.col(column)))


def structs_from_columns(
    df: DataFrame, fields: Mapping[str, str], target: str
) -> DataFrame:
    """Turn columns into a list of one struct, ``{field: column}``, and drop them."""
    _check(df, fields.values(), "structs_from_columns")
    from tablewright.functions import list_of_struct

    return df.withColumn(target, list_of_struct(fields)).drop(*fields.values())
