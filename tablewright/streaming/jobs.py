"""Structured Streaming jobs that keep their progress in a checkpoint."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tablewright.operators.chain import Chain
from tablewright.quality.checks import require
from tablewright.quality.contracts import Contract, run_contract
from tablewright.quality.schema import TableSchema, invalid_rows, valid_rows


def apply_steps(stream: DataFrame, steps: Sequence) -> DataFrame:
    """A chain of row-by-row steps on a stream."""
    return Chain(steps).apply(stream)


def enrich_stream(
    stream: DataFrame, static: DataFrame, key: str, columns: Sequence[str], how: str = "left"
) -> DataFrame:
    """Bring columns of a stored table to a stream; the table is re-read per batch."""
    return stream.join(static.select(key, *columns), key, how)


def read_files(
    spark: SparkSession,
    folder: str,
    schema: str | T.StructType,
    source_format: str = "parquet",
    files_per_batch: int | None = None,
    **options,
) -> DataFrame:
    """New files of a folder as a stream with a declared schema."""
    reader = spark.readStream.format(source_format).schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Start a query that handles what there is now, and wait for its end."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def incremental_harvest(
    spark: SparkSession,
    folder: str,
    schema: str | T.StructType,
    target: str,
    checkpoint: str,
    source_format: str = "csv",
    transform: Callable[[DataFrame], DataFrame] | None = None,
    **options,
) -> StreamingQuery:
    """Append the files that arrived since the last run to a raw Parquet table.

    The checkpoint remembers the files and the file sink commits each batch
    once, so a job that dies half way neither loses nor repeats rows.
    """
    stream = read_files(spark, folder, schema, source_format, **options)
    if transform:
        stream = transform(stream)
    writer = stream.writeStream.format("parquet").outputMode("append")
    return run_available(writer.option("checkpointLocation", checkpoint).option("path", target))


def write_checked(
    stream: DataFrame,
    schema: TableSchema,
    target: str,
    quarantine: str,
    checkpoint: str,
    contract: Contract | None = None,
) -> StreamingQuery:
    """Split every micro-batch into valid rows and quarantined ones.

    With a contract the valid rows are checked before they are written, and a
    failed check stops the query. Each batch has a folder of its own that is
    overwritten, so a batch that runs again leaves no rows twice.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            good = valid_rows(held, schema)
            if contract is not None:
                require(run_contract(good, contract, stored=True), contract.dataset)
            good.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")
            bad = invalid_rows(held, schema)
            bad.write.mode("overwrite").parquet(f"{quarantine}/batch_id={batch_id}")
        finally:
            held.unpersist()

    return run_available(
        stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    )


def as_event_time(df: DataFrame, column: str) -> DataFrame:
    """A time-zone-less timestamp as a timestamp, the type that watermarks take."""
    return df.withColumn(column, F.col(column).cast("timestamp"))
