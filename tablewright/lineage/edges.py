"""Column lineage as a table of edges, so that it joins to data about columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.session import stage

EDGE_SCHEMA = (
    "output_table string, output_column string, source_table string, "
    "source_column string, kind string"
)


def column_lineage(
    spark: SparkSession,
    output: str,
    passthrough: Mapping[str, str] | None = None,
    rename: Mapping[str, tuple[str, str]] | None = None,
    computed: Mapping[str, Sequence[tuple[str, str]]] | None = None,
) -> DataFrame:
    """One row for each source column of each output column.

    ``passthrough`` maps a column to its source table, ``rename`` to a table and
    a column there, ``computed`` to several of those. A column named more than
    once follows the last of the three.
    """
    edges: dict[str, list[tuple[str, str, str]]] = {}
    for column, table in (passthrough or {}).items():
        edges[column] = [(table, column, "passthrough")]
    for column, (table, source) in (rename or {}).items():
        edges[column] = [(table, source, "rename")]
    for column, sources in (computed or {}).items():
        edges[column] = [(table, source, "computed") for table, source in sources]
    rows = [(output, column, *edge) for column, found in edges.items() for edge in found]
    return spark.createDataFrame(rows, EDGE_SCHEMA)


def passthrough_lineage(
    spark: SparkSession,
    output: str,
    source: str,
    columns: Sequence[str],
    renames: Mapping[str, str] | None = None,
) -> DataFrame:
    """Columns that come unchanged from one table, and renames ``{output: source}``."""
    return column_lineage(
        spark,
        output,
        passthrough={c: source for c in columns},
        rename={new: (source, old) for new, old in (renames or {}).items()},
    )


def trace_errors(edges: DataFrame, report: DataFrame) -> DataFrame:
    """Failures per output column, led back to the source columns.

    ``report`` has the columns ``column``, ``check`` and ``failures``.
    """
    return edges.join(report, F.col("output_column") == F.col("column")).select(
        *edges.columns, "check", "failures"
    )


def whole_lineage(edges: DataFrame, longest: int = 64) -> DataFrame:
    """Every column that each column of ``edges`` is made from, over any number of tables.

    output_table, output_column, source_table, source_column, steps (of the
    shortest way) and is_root (nothing is known of its own sources). A step
    doubles the length of the ways known, so a chain of n tables takes about
    log2(n) of them, and ends when it finds no new pair, cycles or not; ``longest``
    bounds the number of steps. Edges with a null end are left out.
    """
    ends = ["output_table", "output_column", "source_table", "source_column"]
    first = edges.select(*ends).dropna().distinct()
    first = stage(first.withColumn("steps", F.lit(1)), "lineage")
    known, before = first, None
    for _ in range(longest):
        left = known.select("output_table", "output_column", F.col("source_table").alias("t"), F.col("source_column").alias("c"), F.col("steps").alias("s"))
        right = known.select(F.col("output_table").alias("t"), F.col("output_column").alias("c"), "source_table", "source_column", "steps")
        joined = left.join(right, ["t", "c"]).select(*ends, (F.col("s") + F.col("steps")).alias("steps"))
        known = stage(known.unionByName(joined).groupBy(*ends).agg(F.min("steps").alias("steps")), "lineage")
        total = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("steps"), F.lit(0))).first()
        if tuple(total) == before:
            break
        before = tuple(total)
    made = first.select(F.col("output_table").alias("source_table"), F.col("output_column").alias("source_column")).distinct()
    return known.join(made.withColumn("made", F.lit(True)), ["source_table", "source_column"], "left").select(
        *ends, "steps", F.col("made").isNull().alias("is_root")
    )


def trace_to_roots(edges: DataFrame, report: DataFrame) -> DataFrame:
    """source_table, source_column, check, failures, outputs: failures of all columns that come from each root.

    ``report`` has the columns ``table``, ``column``, ``check`` and ``failures``.
    ``outputs`` counts the columns that fail; one that a root reaches on several
    ways counts once. A failing column without edges is its own root.
    """
    roots = whole_lineage(edges).filter("is_root")
    found = report.join(roots, (F.col("table") == F.col("output_table")) & (F.col("column") == F.col("output_column")), "left")
    at = found.select(
        F.coalesce("source_table", "table").alias("source_table"), F.coalesce("source_column", "column").alias("source_column"), "check", "failures"
    )
    return at.groupBy("source_table", "source_column", "check").agg(F.sum("failures").alias("failures"), F.count(F.lit(1)).alias("outputs"))
