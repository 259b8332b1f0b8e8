"""Tables stored in buckets by their join key, so that joins of them need no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def write_bucketed(
    df: DataFrame, table: str, key: str, buckets: int, path: str | None = None, sort_by: Sequence[str] | None = None
) -> DataFrame:
    """Store ``df`` as the catalog table ``table`` in ``buckets`` by ``key``, replacing it; returns the table.

    Rows are dealt by key first, so each bucket is one file. Tables with the same
    key and number of buckets join by it without an exchange, as do tables of which
    one number of buckets divides the other. A key with a large part of all rows
    is one bucket: such a table is better joined unbucketed, where adaptive
    execution splits the key.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key, *(sort_by or ()))
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def drop_bucketed(spark: SparkSession, *tables: str) -> None:
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
