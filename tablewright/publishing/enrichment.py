"""Texts enriched with embeddings from a given batch function."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewright.operators.windows import number_rows
from tablewright.publishing._batches import batches_of

ENRICHED_SCHEMA = (
    "embedding_id string, text string, embedding array<float>, model string, "
    "dimensions long, total_tokens long, processing_time_ms double"
)
STORE_SCHEMA = "text_key string, embedding array<float>, model string, dimensions long, total_tokens long"
_KEY = "__text_key"
# Texts of one request. Services set a limit; this is a common one.
BATCH = 128


def embed_texts(
    df: DataFrame,
    text: str,
    embed: Callable[[list[str]], tuple[Sequence[Sequence[float]], int]],
    model: str,
    id_column: str | None = None,
    order_by: Sequence[str] | None = None,
    batch_size: int = BATCH,
    retry_wait: float = 1.0,
) -> DataFrame:
    """id, text, embedding, model, dimensions, tokens, time per text, created_at.

    ``embed`` maps a list of texts to their vectors and the number of tokens of
    the whole batch; it is tried twice, and a second failure fails the task.
    Tokens and time are spread evenly over the batch. ``batch_size`` has to fit
    the service behind ``embed``; a task's batches are full but for its last one.

    Ids come from ``id_column``, or are ``embedding_{n}``, counted from 0 in the
    order of ``order_by``, which must end in a unique column.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    if id_column is not None:
        ids = df.select(F.col(id_column).cast("string").alias("id"), F.col(text).alias("text"))
    elif order_by:
        numbered = number_rows(df, order_by, "__n")
        ids = numbered.select(
            F.concat(F.lit("embedding_"), F.col("__n") - 1).alias("id"), F.col(text).alias("text")
        )
    else:
        raise ValueError("embed_texts needs an id column or an order for its ids")

    def call(texts: list[str]):
        try:
            return embed(texts)
        except Exception:
            time.sleep(retry_wait)
            return embed(texts)

    def enrich(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches_of(frames, batch_size):
            began = time.perf_counter()
            vectors, tokens = call(batch["text"].tolist())
            elapsed = (time.perf_counter() - began) * 1000
            yield pd.DataFrame(
                {
                    "embedding_id": batch["id"].to_numpy(),
                    "text": batch["text"].to_numpy(),
                    "embedding": list(vectors),
                    "model": model,
                    "dimensions": [len(v) for v in vectors],
                    "total_tokens": tokens // len(batch),
                    "processing_time_ms": elapsed / len(batch),
                }
            )

    return ids.mapInPandas(enrich, ENRICHED_SCHEMA).withColumn(
        "created_at", F.current_timestamp()
    )


def text_key(text: str, model: str) -> Column:
    """What a stored vector is found by: a SHA-256 of the model and the text."""
    return F.sha2(F.concat_ws("\n", F.lit(model), F.col(text)), 256)


def embed_once(
    df: DataFrame,
    text: str,
    embed: Callable[[list[str]], tuple[Sequence[Sequence[float]], int]],
    model: str,
    store: str,
    batch_size: int = BATCH,
    retry_wait: float = 1.0,
) -> DataFrame:
    """``df`` with ``embedding``, ``model``, ``dimensions`` and ``total_tokens``, each text paid for once.

    ``store`` is a folder of Parquet in which vectors are kept by the content of
    the text and the model. Only texts that are not in it are sent, equal ones
    once, and stored before the result is returned; the result reads the store,
    so no action on it, and no later run on the same texts, calls the service.
    A task that is tried again sends its own batches again. Null texts are not
    sent and have no vector; an unfinished run leaves nothing in the store.
    """
    spark = df.sparkSession
    keyed = df.withColumn(_KEY, F.when(F.col(text).isNotNull(), text_key(text, model)))
    texts = keyed.filter(F.col(_KEY).isNotNull()).groupBy(_KEY).agg(F.first(text).alias("text"))
    schema = StructType.fromDDL(STORE_SCHEMA)
    known = spark.read.schema(schema).parquet(store) if _exists(spark, store) else spark.createDataFrame([], schema)
    missing = texts.join(known.select(F.col("text_key").alias(_KEY)), _KEY, "left_anti")
    made = embed_texts(missing, "text", embed, model, _KEY, batch_size=batch_size, retry_wait=retry_wait)
    row = made.select(F.col("embedding_id").alias("text_key"), *[f.name for f in schema if f.name != "text_key"])
    row.write.mode("append").parquet(store)
    found = spark.read.schema(schema).parquet(store).dropDuplicates(["text_key"])
    columns = found.select(F.col("text_key").alias(_KEY), "embedding", "model", "dimensions", "total_tokens")
    return keyed.join(columns, _KEY, "left").drop(_KEY)


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
