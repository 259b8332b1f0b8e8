"""Documents for a search index and their delivery in batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.publishing._batches import batches_of
from tablewright.session import stage
from tablewright.sources.sinks import clean_numbers

BATCH_SCHEMA = (
    "`index` string, first_id string, sent long, failed long, failed_ids array<string>, error string"
)
REPORT_COLUMNS = ["index", "first_id", "sent", "failed", "failed_ids", "error"]


def search_documents(
    df: DataFrame, name: str, prefix: str = "", id_field: str | None = None
) -> DataFrame:
    """``_index``, ``_id`` and ``_source`` (JSON of the whole row) for each row.

    The id is ``id_field``, else a column ``id``, else a column ``_id``, else
    null. NaN and infinities become null.
    """
    chosen = next((c for c in (id_field, "id", "_id") if c and c in df.columns), None)
    identity = F.col(chosen).cast("string") if chosen else F.lit(None).cast("string")
    clean = clean_numbers(df)
    return clean.select(
        F.lit(prefix + name).alias("_index"),
        identity.alias("_id"),
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("_source"),
    )


def bulk_batches(
    documents: DataFrame,
    sender: Callable[[list[dict]], int | Iterable[str]],
    batch_size: int = 500,
) -> DataFrame:
    """Send documents in batches, once, and give one stored row for each batch.

    ``sender`` gets a list of ``{"_index", "_id", "_source"}`` and returns how
    many of them failed, or their ids. An exception counts the whole batch as
    failed and its text is kept in ``error``. Every task sends its own rows, in
    full batches but for its last one.

    The documents are sent when this is called, and what happened is stored: to
    use the result twice does not send them again. A task that is lost runs
    again, so a sender has to be idempotent: documents with an id overwrite
    themselves.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches_of(frames, batch_size):
            items, error, ids = batch.to_dict("records"), None, None
            try:
                outcome = sender(items)
                failed = outcome if isinstance(outcome, int) else len(ids := [str(i) for i in outcome])
            except Exception as problem:
                error = f"{type(problem).__name__}: {problem}"
                failed, ids = len(items), [i["_id"] for i in items]
            first = items[0]
            row = (first["_index"], first["_id"], len(items) - failed, failed, ids, error)
            yield pd.DataFrame([row], columns=REPORT_COLUMNS)

    sent = documents.select("_index", "_id", "_source").mapInPandas(send, BATCH_SCHEMA)
    return stage(sent, "bulk-batches")


def bulk_totals(batches: DataFrame) -> DataFrame:
    """Sent and failed documents and batches per index."""
    return batches.groupBy("index").agg(
        F.sum("sent").alias("sent"),
        F.sum("failed").alias("failed"),
        F.count(F.lit(1)).alias("batches"),
    )


def write_bulk_files(
    documents: DataFrame, path: str, batch_size: int = 500, mode: str = "overwrite"
) -> None:
    """Documents as bulk files of at most ``batch_size``: an action and a source line for each.

    Written by Spark, so the folder may be on any file system that the cluster
    reaches, and a task that runs again leaves its files once.
    """
    target = F.struct(F.col("_index"), F.col("_id"))
    action = F.to_json(F.struct(target.alias("index")))
    lines = documents.select(F.concat(action, F.lit("\n"), F.col("_source")).alias("value"))
    lines.write.mode(mode).option("maxRecordsPerFile", batch_size).text(path)
