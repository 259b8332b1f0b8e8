"""Sinks. Every task writes its own files; counts come from the write itself."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.session import stage


@dataclass(frozen=True)
class WriteResult:
    """What was written where; ``metrics`` were collected during the write."""

    path: str
    metrics: Mapping[str, object]

    @property
    def rows(self) -> int:
        return self.metrics["record_count"]


def _observed(df: DataFrame, metrics: Mapping[str, Column] | None):
    seen = Observation(f"write-{uuid.uuid4().hex}")
    extra = [c.alias(n) for n, c in (metrics or {}).items()]
    return df.observe(seen, F.count(F.lit(1)).alias("record_count"), *extra), seen


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    compression: str = "zstd",
    partition_by: Sequence[str] = (),
    metrics: Mapping[str, Column] | None = None,
) -> WriteResult:
    """Parquet, by default with zstd; ``partition_by`` gives Hive-style folders.

    Rows are dealt out by the partition columns first, so that a folder does not
    get a file from each task. The dealing splits what is too large for one task
    (adaptive execution does, by bytes), so a folder with a large part of all
    rows stays spread out.
    """
    observed, seen = _observed(df, metrics)
    if partition_by:
        observed = observed.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = observed.write.mode(mode).option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return WriteResult(path, seen.get)


def clean_numbers(df: DataFrame) -> DataFrame:
    """NaN and infinities become null: JSON has no text for them.

    Also inside lists, structs and the values of maps; columns without floating point stay as they are.
    """
    cleaned = {
        f.name: _clean(F.col(f"`{f.name}`"), f.dataType)
        for f in df.schema.fields
        if _has_float(f.dataType)
    }
    return df.withColumns(cleaned) if cleaned else df


def _has_float(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _has_float(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return any(_has_float(f.dataType) for f in data_type.fields)
    if isinstance(data_type, T.MapType):
        return _has_float(data_type.valueType)
    return isinstance(data_type, (T.FloatType, T.DoubleType))


def _clean(value: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.ArrayType):
        if not _has_float(data_type.elementType):
            return value
        return F.transform(value, lambda x: _clean(x, data_type.elementType))
    if isinstance(data_type, T.MapType):
        if not _has_float(data_type.valueType):
            return value
        return F.transform_values(value, lambda _, v: _clean(v, data_type.valueType))
    if isinstance(data_type, T.StructType):
        fields = [_clean(value.getField(f.name), f.dataType).alias(f.name) for f in data_type]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        # false for NaN as well: NaN compares as the largest value
        return F.when(F.abs(value) < float("inf"), value)
    return value


def write_json(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    metrics: Mapping[str, Column] | None = None,
) -> WriteResult:
    """JSON Lines, one file per task, with nulls written out."""
    observed, seen = _observed(clean_numbers(df), metrics)
    observed.write.mode(mode).option("ignoreNullFields", False).json(path)
    return WriteResult(path, seen.get)


def write_json_array(df: DataFrame, path: str, mode: str = "overwrite") -> WriteResult:
    """One JSON array in the order of ``df``, in parts that every task writes.

    The part files in the order of their names, one after the other, are the
    document: each line is an element, after ``[`` in the first line and ``,`` in
    all others, and the last line ends in ``]``. ``read_json_array_parts`` reads
    the folder in parallel. An empty table gives ``[]``.
    """
    spark = df.sparkSession
    body = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    # stored, as the order within and among tasks has to stay what it was
    lines = stage(
        clean_numbers(df).select(F.monotonically_increasing_id().alias("at"), body.alias("body")), "json-lines"
    )
    first, last, rows = lines.agg(F.min("at"), F.max("at"), F.count(F.lit(1))).first()
    if not rows:
        spark.createDataFrame([("[]",)], "value string").write.mode(mode).text(path)
        return WriteResult(path, {"record_count": 0})
    opening = F.when(F.col("at") == first, "[").otherwise(",")
    closing = F.when(F.col("at") == last, "]").otherwise("")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = lines.repartitionByRange(tasks, "at").sortWithinPartitions("at")
    ordered.select(F.concat(opening, "body", closing).alias("value")).write.mode(mode).text(path)
    return WriteResult(path, {"record_count": rows})


def publish(
    spark: SparkSession,
    source: str | DataFrame,
    path: str,
    where: str | None = None,
    select: Sequence[str] = ("*",),
) -> WriteResult:
    """Filter and project a Parquet table into JSON Lines.

    Besides ``record_count`` the metrics hold ``filtered_from``, the rows before
    the filter. Of a stored table it is counted from the Parquet footers, so that
    the filter can still reach the scan; any other is computed once and counted
    on its way to the filter.
    """
    if isinstance(source, str):
        df = spark.read.parquet(source)
        total, before = df.count(), None
    else:
        before = Observation(f"before-{uuid.uuid4().hex}")
        df = source.observe(before, F.count(F.lit(1)).alias("rows"))
    kept = df.filter(where) if where else df
    result = write_json(kept.selectExpr(*select), path)
    if before is not None:
        total = before.get["rows"]
    return WriteResult(path, {**result.metrics, "filtered_from": total})


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", **options) -> WriteResult:
    """CSV with a header and doubled quotes; white space at the ends of a text stays.

    Text with line breaks is written as it is; ``read_csv(…, multiline=True)``
    reads it back.
    """
    observed, seen = _observed(df, None)
    writer = observed.write.mode(mode).option("header", True).option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.options(**options).csv(path)
    return WriteResult(path, seen.get)


XML_RECORDS = 50_000  # in one file


def write_xml(
    df: DataFrame, path: str, record_tag: str, root_tag: str, mode: str = "overwrite", records: int = XML_RECORDS, **options
) -> WriteResult:
    """XML files of at most ``records`` rows each, one ``record_tag`` element a row.

    A file of XML is read whole by one task, so files have to stay small however
    many rows a task has. Rows are dealt out evenly first, in as many parts as
    adaptive execution finds their bytes to need.
    """
    observed, seen = _observed(df, None)
    writer = observed.hint("rebalance").write.mode(mode).format("xml").option("maxRecordsPerFile", records)
    writer.option("rootTag", root_tag).option("rowTag", record_tag).options(**options).save(path)
    return WriteResult(path, seen.get)


def write_relational(
    df: DataFrame, url: str, table: str, mode: str = "overwrite", batch_size: int = 10_000, **options
) -> None:
    """A table of a relational database over JDBC."""
    writer = df.write.format("jdbc").mode(mode)
    writer.options(url=url, dbtable=table, batchsize=str(batch_size), **options).save()
