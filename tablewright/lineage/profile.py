"""Statistics, examples and profiles of tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions import display_value
from tablewright.operators.ordering import example_row, preview


def output_statistics(df: DataFrame, stats: Mapping[str, str] | None = None) -> DataFrame:
    """One row of ``{name: SQL aggregate}``; by default the record count."""
    stats = stats or {"record_count": "count(*)"}
    return df.agg(*[F.expr(e).alias(n) for n, e in stats.items()])


def formatted_example(
    df: DataFrame,
    column: str | None = None,
    value=None,
    renames: Mapping[str, str] | None = None,
) -> DataFrame:
    """An example row as short text; ``renames`` is ``{new name: column}``.

    Renamed columns go to the end; one that does not exist is null.
    """
    row = example_row(df, column, value)
    text = {f.name: display_value(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields}
    missing = F.lit(None).cast("string")
    moved = {new: text.pop(old, missing) for new, old in (renames or {}).items()}
    return row.select(*[c.alias(n) for n, c in {**text, **moved}.items()])


def profile(df: DataFrame, rows: int = 5, metrics: Mapping[str, str] | None = None) -> dict:
    """Record count, columns, further metrics, and a lazy preview of a few rows.

    One aggregate for all the numbers.
    """
    stats = {"record_count": "count(*)", **(metrics or {})}
    numbers = output_statistics(df, stats).first().asDict()
    return {**numbers, "columns": df.columns, "preview": preview(df, rows)}


def stored_rows(spark: SparkSession, path: str) -> int:
    """Rows of a Parquet table, from the file footers."""
    return spark.read.parquet(path).count()


def raw_examples(
    tables: Mapping[str, DataFrame], ids: Mapping[str, tuple[str, object]] | None = None
) -> DataFrame:
    """An example of each table as rows of ``table, column, example``.

    ``ids`` gives the column and value that pick the row of a table.
    """
    parts = []
    for name, df in tables.items():
        column, value = (ids or {}).get(name, (None, None))
        example = formatted_example(df, column, value)
        parts.append(
            example.unpivot([], example.columns, "column", "example").select(
                F.lit(name).alias("table"), "column", "example"
            )
        )
    return reduce(DataFrame.unionByName, parts)
