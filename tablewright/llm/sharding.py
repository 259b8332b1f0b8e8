"""Sharding by sampled splitters.

Rows are put in the order of a key and cut into ranges of nearly equal bytes.
Splitters come from a sample in which a row's chance grows with its size;
exact sums of the ranges show which are overfull, and those are sampled again
and subdivided. Runs of ranges make the shards.

The key is a hash of the text and then of the row, so that equal texts are
neighbours: a first set of splitters falls between texts only, and a group of
copies is cut where it overfills a range by itself.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

RANGES = 1024
OVERSAMPLE = 16  # sampled keys for each range
FULL = 2  # times its share of bytes that a range may hold
OWN_BITS = 28  # bits of the key that tell copies of a text apart


def _keyed(docs: DataFrame, text: str, key: str) -> DataFrame:
    """(key, size, text_crc32, place): narrow rows, stored, so that what comes later reads the same."""
    group = F.shiftright(F.xxhash64(text), OWN_BITS)
    own = F.shiftrightunsigned(F.xxhash64(F.lit(1), key), 64 - OWN_BITS + 8)
    row = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(256))  # parts even rows that are equal throughout
    place = F.shiftleft(F.shiftleft(group, OWN_BITS - 8).bitwiseOR(own), 8).bitwiseOR(row)
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    crc = F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0).cast("long"))
    return stage(docs.select(F.col(key).alias("key"), size.alias("size"), crc.alias("text_crc32"), place.alias("place")), "sizes")


def _range_of(splitters: np.ndarray):
    """The range of a place: the number of splitters at or below it."""

    @F.pandas_udf("int")
    def found(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(splitters, place.to_numpy(), side="right").astype(np.int32))

    return found(F.col("place"))


def _filled(rows: DataFrame, splitters: np.ndarray) -> pd.DataFrame:
    """Bytes and rows of every range, empty ones included."""
    sums = rows.groupBy(_range_of(splitters).alias("range")).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    return sums.toArrow().to_pandas().set_index("range").reindex(range(len(splitters) + 1), fill_value=0)


def _sampled(rows: DataFrame, per_byte: float, place: Column) -> pd.DataFrame:
    """Places with the weight that each stands for; a row's chance is its size times ``per_byte``, up to 1."""
    chance = F.least(F.col("size") * F.lit(per_byte), F.lit(1.0))
    dice = F.pmod(F.xxhash64("place", "size"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    drawn = rows.filter(dice < chance).select(place.alias("place"), (F.col("size") / chance).alias("weight"))
    return drawn.groupBy("place").agg(F.sum("weight").alias("weight")).toArrow().to_pandas().sort_values("place")


def _quantiles(sample: pd.DataFrame, parts: int) -> np.ndarray:
    """Up to ``parts`` - 1 different places that cut the sampled weight evenly."""
    if sample.empty or parts < 2:
        return np.empty(0, np.int64)
    summed = sample["weight"].to_numpy().cumsum()
    cuts = np.searchsorted(summed, summed[-1] * np.arange(1, parts) / parts)
    return np.unique(sample["place"].to_numpy(np.int64)[cuts])


def splitters(rows: DataFrame, ranges: int = RANGES) -> tuple[np.ndarray, pd.DataFrame]:
    """Places that cut ``rows`` (place, size) into about ``ranges`` ranges, and what each range holds.

    The driver gets about ``OVERSAMPLE`` keys and one sum for each range, however
    many rows there are.
    """
    total = rows.agg(F.sum("size")).first()[0] or 0
    if not total:
        return np.empty(0, np.int64), pd.DataFrame({"bytes": [0], "rows": [0]})
    texts = F.shiftleft(F.shiftright("place", OWN_BITS), OWN_BITS)
    cuts = _quantiles(_sampled(rows, ranges * OVERSAMPLE / total, texts), ranges)
    while True:
        held = _filled(rows, cuts)
        over = held.index[held["bytes"] > FULL * total / ranges]
        if not len(over):
            return cuts, held
        inside = rows.withColumn("range", _range_of(cuts)).filter(F.col("range").isin([int(r) for r in over]))
        sample = _sampled(inside, ranges * OVERSAMPLE / total, F.col("place"))
        owner = np.searchsorted(cuts, sample["place"].to_numpy(), side="right")
        more = [_quantiles(sample[owner == r], int(held["bytes"][r] * ranges // total) + 1) for r in over]
        after = np.unique(np.concatenate([cuts, *more]))
        if len(after) == len(cuts):  # what is left over is single places
            return cuts, held
        cuts = after


def shard(docs: DataFrame, shards: int = 8, ranges: int = RANGES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, size, text_crc32, shard, slot): each row's shard, of nearly equal bytes, and its place there.

    A row's size is the bytes of its text, none for a null one, plus 1. Slots run
    from 0 without a gap, in the order of texts; equal texts stand together
    unless they fill more than a range. Repeated rows are rows of their own.
    Fewer rows than shards leave shards empty; an empty table gives no rows;
    other columns are not looked at.
    """
    rows = _keyed(docs, text, key)
    cuts, held = splitters(rows, ranges)
    ends = held["bytes"].to_numpy().cumsum()
    # a range goes to the shard in whose even share its middle falls
    middle = ends - held["bytes"].to_numpy() / 2
    of_range = np.minimum((middle * shards / max(ends[-1], 1)).astype(np.int64), shards - 1)
    counts = held["rows"].to_numpy()
    base = counts.cumsum() - counts
    first = pd.Series(base).groupby(of_range).transform("min").to_numpy()
    table = pd.DataFrame({"range": np.arange(len(held), dtype=np.int32), "shard": of_range.astype(np.int32), "base": base - first})
    # one row for each range, a few thousand at most
    known = F.broadcast(docs.sparkSession.createDataFrame(table, "range int, shard int, base long"))
    within = Window.partitionBy("range").orderBy("place", "key", "text_crc32", "size")
    return (
        rows.withColumn("range", _range_of(cuts))
        .withColumn("__row", F.row_number().over(within) - 1)
        .join(known, "range")
        .select(F.col("key").alias(key), "size", "text_crc32", "shard", (F.col("base") + F.col("__row")).alias("slot"))
    )
