"""Session settings and the shared staging folder.

Nothing here holds data. ``stage`` is the only place where the library writes
an intermediate result: it puts a Parquet table in the folder that the cluster
names in ``spark.checkpoint.dir``, so that a lost executor can re-read it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Below this many rows a global (unpartitioned) window may run in one task.
# Every use is behind a count; larger inputs take the distributed route, which
# gives the same rows (tests/test_operators.py holds both against each other).
SINGLE_TASK_ROWS = 100_000

# Settings that the plans rely on. They are Spark's own run-time answers to
# skew and to sides that turn out small.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a local read keeps the few tasks of the side before it: one large file would
    # keep the rest of a plan in one task
    "spark.sql.adaptive.localShuffleReader.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # looking up the call site of every Column doubles the time to build wide rules
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "tablewright", master: str | None = None, **conf) -> SparkSession:
    """A session with the recommended settings; ``conf`` keys use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


_OWN_FOLDERS: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the session.

    Only a local master may fall back to a folder of its own: on a cluster a
    machine-local folder would be lost with the machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for staged tables")
    application = spark.sparkContext.applicationId
    if application not in _OWN_FOLDERS:  # the setting itself is fixed when a session starts
        _OWN_FOLDERS[application] = tempfile.mkdtemp(prefix="tablewright-stage-")
    return _OWN_FOLDERS[application]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, under a folder for each application.

    Nothing is ever overwritten there; the folder can go when the application
    has ended.
    """
    application = spark.sparkContext.applicationId
    return f"{checkpoint_dir(spark)}/{application}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and read it back, cutting its lineage."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stages(spark: SparkSession) -> None:
    """Delete every table that this application has staged.

    For a long-lived session between two runs: DataFrames that read a staged
    table cannot be used any more.
    """
    path = f"{checkpoint_dir(spark)}/{spark.sparkContext.applicationId}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
