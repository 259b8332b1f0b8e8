"""Streams whose input arrives again, late or in corrected form, and what is known of each batch."""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tablewright.operators.aggregates import quoted
from tablewright.sources.snapshots import Snapshots
from tablewright.streaming.jobs import run_available


def harvest_into(
    stream: DataFrame,
    table: Snapshots,
    checkpoint: str,
    disposition: str = "merge",
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Files that arrived since the last run, each micro-batch one version of ``table``.

    The manifest remembers the batch, so one that runs again after a failure
    changes nothing. With ``merge`` a file that is delivered again, corrected or
    late, replaces the rows of its keys unless they are newer already.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        table.run(transform(batch) if transform else batch, disposition, batch_id)

    return run_available(stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint))


def once_per_key(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """The first delivery of each event of a stream.

    Keys are remembered until the watermark, ``delay`` behind the newest event
    time, has passed them, so the state holds the events of that time only. An
    event repeated within the delay is dropped; what is later than that is
    dropped as well, whether it is a repetition or not. ``event_time`` is a
    timestamp, or one without a zone, which is taken in the session's.
    """
    timed = stream.withColumn(event_time, quoted(event_time).cast("timestamp"))
    return timed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def profile_columns(columns: Sequence[str]) -> list[Column]:
    """Rows, and for each column its nulls, in one aggregate."""
    nulls = [F.count_if(quoted(c).isNull()).alias(f"nulls_{i}") for i, c in enumerate(columns)]
    return [F.count(F.lit(1)).alias("rows"), *nulls]


class BatchProfiles(StreamingQueryListener):
    """Rows and nulls of each micro-batch, as the query itself has counted them.

    The counts are observed while a batch is written, so nothing is read twice.
    Add it to the session before the query starts, start the query on
    ``observed(stream)``, and read ``table`` when it has ended.
    """

    def __init__(self, name: str, columns: Sequence[str]):
        self.name, self.columns = name, list(columns)
        self._batches: dict[int, list[int]] = {}
        self._ended = threading.Event()

    def observed(self, stream: DataFrame) -> DataFrame:
        return stream.observe(self.name, *profile_columns(self.columns))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found = event.progress.observedMetrics.get(self.name)
        if found is not None:
            self._batches[event.progress.batchId] = [int(v) for v in found]

    def onQueryTerminated(self, event) -> None:
        self._ended.set()

    def table(self, like: DataFrame, wait: float = 60.0) -> DataFrame:
        """batch_id, column_name, rows, nulls, null_rate: one row for each batch with rows and each column.

        Waits until the session has told of the query's end. ``like`` is any
        DataFrame of the session.
        """
        if not self._ended.wait(wait):
            raise TimeoutError(f"no end of the query that {self.name!r} observes after {wait} seconds")
        rows = [
            (batch, column, counts[0], nulls)
            for batch, counts in sorted(self._batches.items())
            if counts[0]
            for column, nulls in zip(self.columns, counts[1:], strict=True)
        ]
        schema = T.StructType.fromDDL("batch_id long, column_name string, rows long, nulls long")
        made = like.sparkSession.createDataFrame(rows, schema)
        return made.withColumn("null_rate", F.col("nulls") / F.col("rows"))


def run_profiled(stream: DataFrame, name: str, columns: Sequence[str], start: Callable[[DataFrame], StreamingQuery]) -> DataFrame:
    """Run a query on ``stream`` and return the table of its ``BatchProfiles``; ``start`` starts it and waits for its end."""
    session = stream.sparkSession
    profiles = BatchProfiles(name, columns)
    session.streams.addListener(profiles)
    try:
        start(profiles.observed(stream))
        return profiles.table(stream)
    finally:
        session.streams.removeListener(profiles)


def merged_profile(batches: DataFrame) -> DataFrame:
    """column_name, rows, nulls, null_rate over all batches."""
    summed = batches.groupBy("column_name").agg(F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"))
    return summed.withColumn("null_rate", F.col("nulls") / F.col("rows"))
