"""Registered queries: each reads the given tables and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_SCHEMAS: dict[str, StructType] = {}

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class Tables:
    """The given tables by attribute: ``t.lineitem``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        path = self.folder.rstrip("/") + f"/{name}.parquet"
        # finding the schema is a job of its own: once for each file is enough
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)


def query(oracle: str | None = None):
    """Register ``fn(t: Tables) -> DataFrame`` under its name, with its SQL if any."""

    def add(fn):
        QUERIES[fn.__name__] = lambda spark, folder: fn(Tables(spark, folder))
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn

    return add
