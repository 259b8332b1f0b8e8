"""Keyed tables that runs append to, replace or merge into, one version after another.

Rows are dealt into buckets by a hash of the key. A version is a small manifest
that names the folder of each bucket; it is written last, as a new numbered
folder, so a run that dies half way leaves the version before it in force, and of
two runs at once one fails. A merge reads and writes only the buckets that its
rows touch.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.aggregates import quoted
from tablewright.session import stage

DISPOSITIONS = ("append", "replace", "merge")
_BUCKET, _RANK = "__bucket", "__newest"
_MANIFEST = "version long, bucket int, folder string, batch long"


@dataclass(frozen=True)
class Snapshots:
    """A table at ``path``, in versions.

    ``key`` names its columns of identity. ``newest`` are the columns that order
    rows of one key, greatest last: a row never gives way to an older one, however
    late that arrives. Rows that tie in them are ordered by all their other
    columns, so that the order of arrival decides nothing.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    key: Sequence[str]
    newest: Sequence[str] = ()
    buckets: int = 64

    def versions(self) -> DataFrame:
        """All manifests: version, bucket, folder, batch."""
        try:
            return self.spark.read.schema(_MANIFEST).json(f"{self.path}/versions/*")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _MANIFEST)

    def _current(self) -> tuple[int, int, dict[int, list[str]]]:
        """Number and batch of the last version, and the folders of its buckets."""
        rows = self.versions()
        last = rows.agg(F.max("version")).first()[0]
        if last is None:
            return 0, -1, {}
        folders: dict[int, list[str]] = {}
        batch = -1
        for row in rows.filter(F.col("version") == last).collect():  # a few for each bucket
            batch = row.batch
            if row.bucket >= 0:
                folders.setdefault(row.bucket, []).append(row.folder)
        return last, batch, folders

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of its last version or a given one; empty before the first."""
        rows = self.versions()
        if version is None:
            version = rows.agg(F.max("version")).first()[0]
        own = rows.filter((F.col("version") == F.lit(version)) & (F.col("bucket") >= 0))
        return self._read([r[0] for r in own.select("folder").distinct().collect()])

    def _read(self, paths: Sequence[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*sorted(paths))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[quoted(k) for k in self.key]), F.lit(self.buckets)).cast("int")

    def _last(self, df: DataFrame) -> DataFrame:
        """One row for each key: the newest. Null keys are keys like any other."""
        names = [f.name for f in self.schema]
        order = [*self.newest, *[c for c in names if c not in self.newest and c not in self.key]]
        rest = F.struct(*[quoted(c) for c in order]) if order else F.lit(0)
        found = df.groupBy(*[quoted(k) for k in self.key]).agg(F.max(rest).alias(_RANK))
        return found.select(*[quoted(c) if c in self.key else F.col(_RANK).getField(c).alias(c) for c in names])

    def _write(self, df: DataFrame) -> dict[int, str]:
        """Write rows by bucket to a new folder; the folder of each bucket that has rows."""
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        dealt = df.select(*[quoted(f.name) for f in self.schema]).withColumn(_BUCKET, self._bucket())
        dealt.repartition(_BUCKET).write.partitionBy(_BUCKET).parquet(folder)
        made = self.spark.read.schema(dealt.schema).parquet(folder)  # there may be no files
        return {r[0]: f"{folder}/{_BUCKET}={r[0]}" for r in made.select(_BUCKET).distinct().collect()}

    def run(self, df: DataFrame, disposition: str = "merge", batch: int | None = None) -> int:
        """Add the rows of ``df`` as a new version and return its number.

        ``append`` keeps all rows, ``replace`` drops those before it, ``merge`` keeps
        the newest row of each key. A ``batch`` that is not above the last one has
        been handled before and changes nothing.
        """
        if disposition not in DISPOSITIONS:
            raise ValueError(f"unknown disposition {disposition!r}")
        version, done, folders = self._current()
        if batch is not None and batch <= done:
            return version
        if disposition == "append":
            made = {b: [*folders.get(b, []), f] for b, f in self._write(df).items()}
        elif disposition == "replace":
            folders, made = {}, {b: [f] for b, f in self._write(df).items()}
        else:
            new = stage(self._last(df), "merged")  # read twice: for its buckets and for its rows
            touched = [r[0] for r in new.select(self._bucket().alias("b")).distinct().collect()]
            old = self._read([f for b in touched for f in folders.get(b, [])])
            made = {b: [f] for b, f in self._write(self._last(old.unionByName(new))).items()}
        manifest = {**folders, **made}
        rows = [(version + 1, b, f, done if batch is None else batch) for b, own in manifest.items() for f in own]
        rows = rows or [(version + 1, -1, "", done if batch is None else batch)]
        table = self.spark.createDataFrame(rows, _MANIFEST).coalesce(1)
        table.write.mode("error").json(f"{self.path}/versions/{version + 1:012d}")
        return version + 1
