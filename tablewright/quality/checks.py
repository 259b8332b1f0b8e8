"""Single checks. Each gives a table of one row (or one row per item) with
``passed``; nothing runs before the result is read or ``require`` is called."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.errors import CheckFailed, MissingColumn
from tablewright.operators.aggregates import sorted_items, value_counts
from tablewright.operators.joins import orphan_keys
from tablewright.quality.schema import TableSchema, error_table, schema_errors, _any, _prepare


def require_columns(df: DataFrame, columns: Sequence[str], caller: str = "table") -> DataFrame:
    """``df`` itself, or ``MissingColumn`` with the columns there are."""
    missing = set(columns) - set(df.columns)
    if missing:
        raise MissingColumn(caller, missing, df.columns)
    return df


def schema_contract(df: DataFrame, expected: Sequence[str]) -> tuple[list[str], list[str]]:
    """Missing and extra columns against the expected ones, both sorted."""
    actual, wanted = set(df.columns), set(expected)
    return sorted(wanted - actual), sorted(actual - wanted)


def threshold_check(df: DataFrame, column: str, minimum) -> DataFrame:
    """Whether no value lies below the minimum; also gives the smallest value."""
    return df.agg(
        F.count_if(F.col(column) < F.lit(minimum)).alias("below_threshold_count"),
        F.min(column).alias("min_value"),
    ).withColumn("passed", F.col("below_threshold_count") == 0)


def allowed_values(df: DataFrame, column: str, values: Sequence) -> tuple[DataFrame, DataFrame]:
    """The check and the distribution of the values. A null is not invalid."""
    check = df.agg(
        F.count_if(~F.col(column).isin(*values)).alias("invalid_count")
    ).withColumn("passed", F.col("invalid_count") == 0)
    return check, value_counts(df, column)


def minimum_rows(df: DataFrame, minimum: int) -> DataFrame:
    """Row count, minimum, and how many rows are short of it."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count",
        F.lit(minimum).cast("long").alias("minimum"),
        F.greatest(F.lit(0), F.lit(minimum) - F.col("row_count")).alias("shortfall"),
        (F.col("row_count") >= F.lit(minimum)).alias("passed"),
    )


def failure_rate(df: DataFrame, schema: TableSchema, maximum: float) -> DataFrame:
    """Share of rows that break a rule, against a maximum; an empty table has none."""
    table, rules, _ = _prepare(df, schema)
    return table.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(_any(rules)).alias("failed_rows")
    ).withColumns(
        {
            "failure_rate": F.coalesce(
                F.col("failed_rows") / F.nullif("total_rows", F.lit(0)), F.lit(0.0)
            ),
            "passed": F.coalesce(
                F.col("failed_rows") / F.nullif("total_rows", F.lit(0)), F.lit(0.0)
            )
            <= F.lit(maximum),
        }
    )


def value_range(df: DataFrame, column: str, above, below) -> DataFrame:
    """Whether ``above < min`` and ``max < below``."""
    return df.agg(F.min(column).alias("min_value"), F.max(column).alias("max_value")).withColumn(
        "passed",
        F.coalesce(
            (F.col("min_value") > F.lit(above)) & (F.col("max_value") < F.lit(below)),
            F.lit(True),
        ),
    )


def reference_check(
    child: DataFrame,
    parent: DataFrame,
    key: str,
    parent_key: str | None = None,
    sample: int = 10,
    label: str | None = None,
) -> DataFrame:
    """Distinct keys of ``child`` that ``parent`` lacks: their number and a sample.

    The sample holds the smallest keys as text; the count covers all of them. A
    missing key has no match either and counts once.
    """
    orphans = orphan_keys(child, parent, key, parent_key)
    first = orphans.orderBy(F.col(key).asc_nulls_last()).limit(sample)
    samples = first.agg(
        F.transform(sorted_items(F.col(key), F.col(key)), lambda k: k.cast("string"))
    ).scalar()
    return orphans.agg(F.count(F.lit(1)).alias("orphan_count")).select(
        F.lit(label or key).alias("reference"),
        "orphan_count",
        samples.alias("orphan_sample"),
        (F.col("orphan_count") == 0).alias("passed"),
    )


def foreign_keys(
    child: DataFrame, references: Mapping[str, tuple[DataFrame, str]], sample: int = 10
) -> DataFrame:
    """One reference check for each ``{key: (parent, parent key)}``."""
    return reduce(
        DataFrame.unionByName,
        [reference_check(child, p, k, pk, sample, label=k) for k, (p, pk) in references.items()],
    )


def require(results: DataFrame, name: str, label: str | None = None) -> None:
    """Raise ``CheckFailed`` unless every row passed. Runs the checks.

    ``results`` has one row for each declared check.
    """
    if label is None:
        label = next((c for c in ("check_name", "reference") if c in results.columns), None)
    shown: Column = F.col(label) if label else F.lit(name)
    failed = results.filter(~F.col("passed")).select(shown.alias("label")).collect()
    if failed:
        raise CheckFailed(name, [r["label"] for r in failed])


def write_when_passed(
    df: DataFrame,
    check: Callable[[DataFrame], DataFrame],
    write: Callable[[DataFrame], object],
    name: str = "check",
):
    """Run ``check`` on the staged table and ``write`` it only if all passed.

    The table is staged once, so what is written is what was checked.
    """
    from tablewright.session import stage

    checked = stage(df, name)
    require(check(checked), name)
    return write(checked)


def warnings_report(tables: Mapping[str, tuple[DataFrame, TableSchema]]) -> DataFrame:
    """The errors of several tables, each tagged with its table."""
    parts = []
    for name, (df, schema) in tables.items():
        parts.append(error_table(df, schema).withColumn("table", F.lit(name)))
        broken = schema_errors(df, schema)
        if broken:
            rows = df.sparkSession.createDataFrame(
                [(*e, name) for e in broken],
                "`column` string, `check` string, failure_case string, `table` string",
            )
            parts.append(rows)
    return reduce(DataFrame.unionByName, parts).select(
        "table", "column", "check", "failure_case"
    )


def warnings_status(report: DataFrame) -> DataFrame:
    """One row: ``clean`` or ``warnings``, and the number of warnings."""
    return report.agg(F.count(F.lit(1)).alias("warning_count")).select(
        F.when(F.col("warning_count") == 0, "clean").otherwise("warnings").alias("status"),
        "warning_count",
    )
