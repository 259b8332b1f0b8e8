"""What several operators of this package share."""

from __future__ import annotations

import gc
import os
import time
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage

__all__ = ["documents", "few_tasks", "find_package", "identity", "join_counted", "labels", "map_batches", "slices", "stage", "stage_and_free", "table", "text_bytes", "word_count"]

# A word is a run of anything but these six ASCII characters. ``bytes.split()``
# splits at exactly the same ones.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"

# Rows handed to vectorised code at once. Texts differ in length a thousandfold,
# so a frame is cut by its bytes as well.
SLICE_BYTES = 4 << 20

HOT = 500  # rows from which a join key may count as hot
TASK_ROWS = 100_000  # rows of a few longs that a task takes with ease


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver has it, if it is not installed there."""
    environment, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*filter(None, known), root])


def stage_and_free(df: DataFrame, label: str) -> DataFrame:
    """``stage``, after which the shuffle files that ``df`` was made from may go.

    Nothing needs them any more, but Spark deletes them only when the driver
    collects the objects that stand for them, first in Python and then in the
    JVM, which may be long after. Both are asked to do so, a moment later, as
    Spark's listeners hold a query until they have heard of its end; no result
    depends on whether they do.
    """
    made = stage(df, label)
    jvm = df.sparkSession.sparkContext._jvm
    del df
    for _ in range(2):
        time.sleep(1)
        gc.collect()
        jvm.System.gc()
    return made


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels")


def word_count(text: Column) -> Column:
    """Words of a text, 0 for a null one, as long."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def identity(key: str = "doc_id", text: str = "text") -> tuple[Column, Column]:
    """128 bits that stand for a row's key and whole text, null or not.

    Rows that agree in both are one to the operators that use it. The hash skips
    nulls, so whether each is null is hashed as well.
    """
    both = F.col(key).isNull(), F.col(text).isNull(), F.col(key).cast("string"), F.col(text)
    return F.xxhash64(*both), F.xxhash64(F.lit(1), *both)


def text_bytes(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8 bytes, nulls as empty ones."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch of about ``SLICE_BYTES`` of ``column``, one row at least."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > SLICE_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size + 1
    if start < batch.num_rows:
        yield batch.slice(start)


def join_counted(rows: DataFrame, table: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Inner join of ``rows`` with ``table``, whose ``keys`` are unique and whose ``count`` says how many rows have them.

    Keys with more than a thousandth of all rows, and ``HOT`` rows, are at most a
    thousand; they are broadcast, so that no task gets all rows of one. Both
    tables should be stored, as they are read twice.
    """
    total = table.agg(F.coalesce(F.sum(count), F.lit(0))).first()[0]
    is_hot = F.col(count) > max(HOT, total // 1000)
    hot = F.broadcast(table.filter(is_hot))
    rest = rows.join(hot.select(*keys), keys, "left_anti").join(table.filter(~is_hot), keys)
    return rows.join(hot, keys).unionByName(rest)


def few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """``df``, which has at most ``rows`` rows, in as many tasks as these ask for, if it has more.

    Adaptive execution does so where it may coalesce partitions; a table of a few
    thousand rows that is written many times should not depend on it. Only the
    tasks after the last shuffle are fewer, so no more than narrow work on rows
    of a few longs should stand there.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)))


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, by: str = "text"
) -> DataFrame:
    """``function`` over bounded slices of each Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401  makes pa.compute there in a worker

        for batch in batches:
            for piece in slices(batch, by):
                made = function(piece)
                if made is not None and made.num_rows:
                    yield made

    return df.mapInArrow(run, schema)
