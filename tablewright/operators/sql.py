"""SQL over tables and named views."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

INPUT = "_input"


def sql_transform(
    df: DataFrame, sql: str, tables: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Run Spark SQL with ``df`` as ``_input`` and further tables by name.

    Views of the same names that exist already are put back afterwards: an
    analysed plan keeps the tables it was built from.
    """
    spark = df.sparkSession
    named = {INPUT: df, **(tables or {})}
    before = {n: spark.table(n) for n in named if _is_temp_view(spark, n)}
    try:
        for name, table in named.items():
            table.createOrReplaceTempView(name)
        result = spark.sql(sql)
        result.schema  # noqa: B018 - resolve the names while the views exist
        return result
    finally:
        for name in named:
            if name in before:
                before[name].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)


def _is_temp_view(spark: SparkSession, name: str) -> bool:
    try:
        return spark.catalog.getTable(name).isTemporary
    except AnalysisException:
        return False


def sql_query(spark: SparkSession, sql: str) -> DataFrame:
    """Run Spark SQL on the views and tables of the session."""
    return spark.sql(sql)


def sql_to_parquet(
    spark: SparkSession,
    sql: str,
    path: str,
    upstream: Mapping[str, str] | None = None,
    compression: str = "zstd",
    mode: str = "overwrite",
) -> int:
    """Bind upstream Parquet paths as views, run the SQL, write; returns the rows.

    The count comes from the write itself, without another scan.
    """
    for name, source in (upstream or {}).items():
        spark.read.parquet(source).createOrReplaceTempView(name)
    seen = Observation(f"sql-to-parquet-{uuid.uuid4().hex}")
    result = spark.sql(sql).observe(seen, F.count(F.lit(1)).alias("rows"))
    result.write.mode(mode).option("compression", compression).parquet(path)
    return seen.get["rows"]


@dataclass
class SqlSteps:
    """Named SQL steps, each of which sees the views before it.

    A step marked with ``keep`` is staged to the shared folder: use it for a
    result that several later steps read.
    """

    spark: SparkSession

    def view(self, name: str, source: DataFrame | str) -> SqlSteps:
        """Bind a table or a Parquet path."""
        df = self.spark.read.parquet(source) if isinstance(source, str) else source
        df.createOrReplaceTempView(name)
        return self

    def step(self, name: str, sql: str, keep: bool = False) -> SqlSteps:
        from tablewright.session import stage

        result = self.spark.sql(sql)
        (stage(result, name) if keep else result).createOrReplaceTempView(name)
        return self

    def result(self, name: str) -> DataFrame:
        return self.spark.table(name)
