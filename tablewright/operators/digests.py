"""Comparison of stored tables by digests: only ranges that differ are read again.

A table is stored in ranges of a hash of its key, with a digest of each range: the
number of rows and the sums of two hashes of each row. Sums do not depend on the
order of rows and count repeated ones, and those of ranges add up to those of wider
ranges, so the digests form a tree. Two tables are compared from the root down, and
the rows of leaves that differ by ``diff_tables``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.aggregates import quoted
from tablewright.operators.diff import TableDiff, diff_tables

RANGE = "__range"
FAN = 16  # children of a node
_DIGEST = "level int, node int, rows long, first decimal(38,0), second decimal(38,0)"


def with_range(df: DataFrame, key: Sequence[str], ranges: int) -> DataFrame:
    """``df`` with the range of each row; a null key column is a value like any other."""
    parts = [c for k in key for c in (quoted(k).isNull(), quoted(k))]
    return df.withColumn(RANGE, F.pmod(F.xxhash64(*parts), F.lit(ranges)).cast("int"))


def digest_tree(ranged: DataFrame, columns: Sequence[str], ranges: int, fan: int = FAN) -> DataFrame:
    """level, node, rows, first, second: level 0 are the ranges, each level above adds up ``fan`` nodes of it.

    ``columns`` are digested in their given order. Ranges without rows have no node.
    """
    parts = [c for name in columns for c in (quoted(name).isNull(), quoted(name))]
    sums = [F.count(F.lit(1)).alias("rows")]
    for seed, name in enumerate(("first", "second")):
        row = F.xxhash64(F.lit(seed), *parts).cast("decimal(20,0)")
        sums.append(F.sum(row).cast("decimal(38,0)").alias(name))
    leaves = ranged.groupBy(F.col(RANGE).alias("node")).agg(*sums)
    steps, width = [], 1
    while True:
        steps.append(F.struct(F.lit(len(steps)).alias("level"), F.floor(F.col("node") / width).cast("int").alias("above")))
        if width >= ranges:
            break
        width *= fan
    up = leaves.withColumn("step", F.explode(F.array(*steps)))
    return up.groupBy("step.level", F.col("step.above").alias("node")).agg(
        F.sum("rows").alias("rows"), *[F.sum(c).cast("decimal(38,0)").alias(c) for c in ("first", "second")]
    )


@dataclass(frozen=True)
class RangedTable:
    """A table stored at ``path`` in ranges, with its digests."""

    spark: SparkSession
    path: str
    schema: T.StructType
    key: Sequence[str]
    ranges: int = 256
    fan: int = FAN

    def write(self, df: DataFrame) -> None:
        """Store the rows, and then their digests from what was stored; both replace what was there."""
        names = [quoted(f.name) for f in self.schema]
        dealt = with_range(df.select(*names), self.key, self.ranges)
        dealt.repartition(RANGE).write.mode("overwrite").partitionBy(RANGE).parquet(f"{self.path}/rows")
        tree = digest_tree(self._rows(), sorted(f.name for f in self.schema), self.ranges, self.fan)
        tree.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/digests")

    def _rows(self) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField(RANGE, T.IntegerType())])
        return self.spark.read.schema(schema).parquet(f"{self.path}/rows")

    def digests(self) -> DataFrame:
        return self.spark.read.schema(_DIGEST).parquet(f"{self.path}/digests")

    def rows(self, ranges: Sequence[int] | None = None) -> DataFrame:
        """All rows, or those of some ranges; the others are not read."""
        found = self._rows()
        if ranges is not None:
            found = found.filter(F.col(RANGE).isin(list(ranges)))
        return found.drop(RANGE)


def differing_ranges(left: DataFrame, right: DataFrame, fan: int = FAN) -> list[int]:
    """The leaves whose digests differ, found from the root down: below equal nodes nothing is looked at."""
    both = left.unionByName(right)
    level = both.agg(F.max("level")).first()[0]
    nodes = [] if level is None else [0]
    while nodes:
        sides = [
            side.filter((F.col("level") == level) & F.col("node").isin(nodes)).select("node", F.struct("rows", "first", "second").alias(name))
            for side, name in ((left, "l"), (right, "r"))
        ]
        differ = sides[0].join(sides[1], "node", "full").filter(~F.col("l").eqNullSafe(F.col("r")))
        nodes = sorted(r[0] for r in differ.select("node").collect())  # as many as there are ranges, at most
        if level == 0:
            break
        nodes, level = [n * fan + k for n in nodes for k in range(fan)], level - 1
    return nodes


def diff_stored(left: RangedTable, right: RangedTable) -> tuple[TableDiff, list[int]]:
    """``diff_tables`` of two stored tables, and the ranges that it had to read.

    Both need the same columns, key, ranges and fan. Tables that agree are compared
    by one row.
    """
    settings = [(list(t.key), t.ranges, t.fan, sorted((f.name, f.dataType.simpleString()) for f in t.schema)) for t in (left, right)]
    if settings[0] != settings[1]:
        raise ValueError("tables are compared by digests of the same columns, key, ranges and fan")
    ranges = differing_ranges(left.digests(), right.digests(), left.fan)
    return diff_tables(left.rows(ranges), right.rows(ranges)), ranges
