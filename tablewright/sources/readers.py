"""Sources. Where a schema is declared, no read needs a pass to infer it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.errors import MissingTable
from tablewright.quality.checks import require_columns

# Short view names and the raw folders they stand for.
RAW_VIEWS = {
    "sales": "sales_raw",
    "artworks": "artworks_raw",
    "artists": "artists_raw",
    "media": "media",
}


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType | None = None,
    multiline: bool = False,
    **options,
) -> DataFrame:
    """A CSV file or folder with a header; a malformed row raises.

    Without a schema the types are inferred, which reads the files once more.
    ``multiline`` allows line breaks inside quotes; then a file cannot be split,
    and one task reads it from end to end.
    """
    reader = spark.read.option("header", True).option("mode", "FAILFAST").option("escape", '"')
    reader = reader.option("multiLine", multiline)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.options(**options).csv(path)


def harvest_csv(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType | None,
    raw_dir: str,
    table: str,
    raw_schema: str = "raw",
    **options,
) -> str:
    """Replace a raw Parquet table by the contents of CSV files; returns its path."""
    target = f"{raw_dir.rstrip('/')}/{raw_schema}/{table}"
    read_csv(spark, path, schema, **options).write.mode("overwrite").parquet(target)
    return target


def relational_options(
    url: str,
    table: str,
    key: str | None = None,
    bounds: tuple | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    **options,
) -> dict[str, str]:
    """Reader options; with a key and its bounds the table is read in slices."""
    found = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **options}
    if key is not None:
        if bounds is None:
            raise ValueError("a sliced read needs the bounds of its key")
        found |= {
            "partitionColumn": key,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return found


def read_relational(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    """A table of a relational database over JDBC (see ``relational_options``)."""
    return spark.read.format("jdbc").options(**relational_options(url, table, **kwargs)).load()


def show_raw_tables(spark: SparkSession, folder: str) -> list[str]:
    """Names of the sub-folders, on any file system that Spark can reach."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        raise FileNotFoundError(f"folder not found: {folder}")
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory())


def read_parquet_table(
    spark: SparkSession,
    folder: str,
    table: str,
    required: Sequence[str] | None = None,
    caller: str = "read",
) -> DataFrame:
    """A Parquet table by folder and name, with its columns checked."""
    try:
        df = spark.read.parquet(f"{folder}/{table}")
    except AnalysisException:
        available = show_raw_tables(spark, folder)
        if table not in available:
            raise MissingTable(caller, table, available) from None
        raise FileNotFoundError(f"[{caller}] no Parquet files in {folder}/{table}") from None
    return require_columns(df, required or (), caller)


def read_raw_table(
    spark: SparkSession,
    raw_dir: str,
    table: str,
    schema: str = "raw",
    required: Sequence[str] | None = None,
    caller: str = "read",
) -> DataFrame:
    """A harvested table, ``{raw_dir}/{schema}/{table}``."""
    return read_parquet_table(spark, f"{raw_dir.rstrip('/')}/{schema}", table, required, caller)


def read_raw_tables(
    spark: SparkSession,
    raw_dir: str,
    *tables: tuple[str, Sequence[str] | None],
    schema: str = "raw",
    caller: str = "read",
) -> dict[str, DataFrame]:
    """Several harvested tables, each with its required columns or ``None``."""
    return {
        name: read_raw_table(spark, raw_dir, name, schema, required, caller)
        for name, required in tables
    }


def register_views(
    spark: SparkSession,
    raw_dir: str,
    views: Sequence[str] | Mapping[str, str] | None = None,
    schema: str = "raw",
) -> None:
    """Temp views with short names over raw tables.

    ``views`` picks short names or maps names to folders; a name without a
    known folder stands for the folder of the same name.
    """
    if views is None:
        chosen = RAW_VIEWS
    elif isinstance(views, Mapping):
        chosen = views
    else:
        chosen = {v: RAW_VIEWS.get(v, v) for v in views}
    for view, table in chosen.items():
        read_raw_table(spark, raw_dir, table, schema).createOrReplaceTempView(view)


def read_table(
    spark: SparkSession,
    table: str,
    schema: str = "default",
    required: Sequence[str] | None = None,
    caller: str = "read",
) -> DataFrame:
    """A catalog table; a missing one names those there are."""
    if not spark.catalog.databaseExists(schema):
        raise MissingTable(caller, f"{schema}.{table}", [])
    if not spark.catalog.tableExists(f"{schema}.{table}"):
        names = [t.name for t in spark.catalog.listTables(schema) if not t.isTemporary]
        raise MissingTable(caller, f"{schema}.{table}", names)
    return require_columns(spark.table(f"{schema}.{table}"), required or (), caller)


def read_json_array(
    spark: SparkSession, path: str, schema: str | T.StructType | None = None
) -> DataFrame:
    """A file that holds one JSON array; for large data prefer JSON Lines.

    One such file cannot be split, so one task reads it.
    """
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_json_array_parts(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """The folder of a JSON array in parts (``sinks.write_json_array``), read in parallel."""
    kind = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    body = F.regexp_replace("value", r"^[\[,]|\]$", "")
    lines = spark.read.text(path).select(body.alias("body")).filter("body <> ''")
    return lines.select(F.from_json("body", kind).alias("row")).select("row.*")


def read_json_lines(
    spark: SparkSession, path: str, schema: str | T.StructType
) -> DataFrame:
    """JSON Lines, read in parallel with a declared schema."""
    return spark.read.schema(schema).json(path)


def read_partitioned(spark: SparkSession, path: str, **values) -> DataFrame:
    """A Hive-style partitioned table; the values prune whole folders."""
    df = spark.read.parquet(path)
    for column, value in values.items():
        df = df.filter(F.col(column) == F.lit(value))
    return df
