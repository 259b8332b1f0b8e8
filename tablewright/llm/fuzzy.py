"""Context-triggered piecewise hashing of whole texts.

A rolling hash over the last ``WINDOW`` bytes decides where chunks end, so an
edit disturbs the chunks near it and no others. A chunk gives one letter. The
block size, the mean length of a chunk, is a power of two times ``LEAST_BLOCK``
that follows the text's length; a fingerprint holds the letters at ``SIZES``
block sizes, each twice the one before, so that texts of somewhat different
length can be compared at a size that both have.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import slices, stage

WINDOW = 7
LEAST_BLOCK = 3
LETTERS = 128  # chunks at the smallest block size are at most about so many, and half of it at least
SIZES = 3
RUN = 4  # so many letters in a row must be common to both for any likeness, fewer in short ones
REPEAT = 3  # letters of a longer run of one letter are not compared
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)

_LONG_RUN = re.compile(r"(.)\1{%d,}" % REPEAT)
_ODD = 0x9E3779B97F4A7C15
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def _rolling(data: np.ndarray) -> np.ndarray:
    """A hash of the ``WINDOW`` bytes that end at each byte, fewer at the start."""
    made = np.zeros(len(data), np.uint32)
    for back in range(min(WINDOW, len(data))):
        factor = np.uint32(pow(0x01000193, back + 1, 1 << 32))
        made[back:] += (data[: len(data) - back] + np.uint32(1)) * factor
    made ^= made >> np.uint32(15)
    made *= np.uint32(0x2C1B3C6D)
    made ^= made >> np.uint32(13)
    return made


def _letters(sums: np.ndarray, down: np.ndarray, ends: np.ndarray) -> bytes:
    """A letter for each chunk, from prefix sums of the text; ``ends`` are places after the chunks' last bytes."""
    starts = np.append(0, ends[:-1])
    hashed = (sums[ends] - sums[starts]) * down[starts]
    hashed ^= hashed >> np.uint64(29)
    hashed *= np.uint64(0xC2B2AE3D27D4EB4F)
    return ALPHABET[(hashed >> np.uint64(58)).astype(np.int64)].tobytes()


def _grow(size: int) -> None:
    global _powers, _inverse
    if size > len(_powers):
        steps = np.ones((2, 1 << size.bit_length()), np.uint64)
        steps[0, 1:], steps[1, 1:] = _ODD, pow(_ODD, -1, 1 << 64)
        _powers, _inverse = np.cumprod(steps, axis=1, dtype=np.uint64)


def fingerprint(text: bytes) -> str:
    """``block:letters:letters at twice the block:at four times``; without text no letters."""
    if not text:
        return f"{LEAST_BLOCK}" + ":" * SIZES
    data = np.frombuffer(text, np.uint8).astype(np.uint32)
    _grow(len(data))
    hashes = _rolling(data)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data + np.uint32(1)) * _powers[: len(data)], dtype=np.uint64, out=sums[1:])
    block = LEAST_BLOCK
    while block * LETTERS < len(data):
        block *= 2
    made, size = [], block
    for _ in range(SIZES):
        ends = np.flatnonzero(hashes % np.uint32(size) == np.uint32(size - 1)) + 1
        if not len(ends) or ends[-1] < len(data):
            ends = np.append(ends, len(data))
        made.append(_letters(sums, _inverse, ends).decode())
        size *= 2
    return ":".join([str(block), *made])


def _distance(a: str, b: str) -> int:
    """Insertions and deletions that turn one into the other, by bits of whole numbers."""
    places: dict[str, int] = {}
    for i, letter in enumerate(a):
        places[letter] = places.get(letter, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for letter in b:
        held = row & places.get(letter, 0)
        row = ((row + held) | (row - held)) & full
    common = len(a) - row.bit_count()
    return len(a) + len(b) - 2 * common


def _alike(a: str, b: str) -> float:
    if a == b:
        return 1.0
    a, b = (_LONG_RUN.sub(r"\1" * REPEAT, letters) for letters in (a, b))
    if not a or not b:
        return 0.0
    run = max(1, min(RUN, len(a) // 4, len(b) // 4))
    if {a[i : i + run] for i in range(len(a) - run + 1)}.isdisjoint(b[i : i + run] for i in range(len(b) - run + 1)):
        return 0.0
    return 1 - _distance(a, b) / (len(a) + len(b))


def likeness(a: str, b: str) -> float:
    """0 to 1: by the edit distance of the letters at the smallest block size that both fingerprints have.

    1 only for equal fingerprints; 0 where no block size is common to both.
    """
    if a == b:
        return 1.0
    (size, *own), (other, *its) = a.split(":"), b.split(":")
    size, other = int(size), int(other)
    for block, letters in zip((size << i for i in range(SIZES)), own, strict=True):
        for its_block, its_letters in zip((other << i for i in range(SIZES)), its, strict=True):
            if block == its_block:
                return min(_alike(letters, its_letters), 0.999)
    return 0.0


def fingerprints(docs: DataFrame, target: str = "fingerprint", text: str = "text") -> DataFrame:
    """``docs`` with the fingerprint of each whole text; a null one is empty."""
    from .common import map_batches, text_bytes

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    names = docs.columns

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [fingerprint(t) for t in text_bytes(batch.column(text))]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], [*names, target])

    return map_batches(docs, of, f"{schema}, `{target}` string", text)


def edited(own: str, following: str) -> str:
    """The text whose last half is replaced by as much of the beginning of the following one."""
    half = len(own) // 2
    return own[: len(own) - half] + following[:half]


def edit_trial(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next).

    ``edited`` is the SHA-256 of the edited text. The next document is the one of
    the next smaller key, null keys come after all others, equal keys are told
    apart by a hash of the text, and the last is followed by the first. A single
    document follows itself. Null texts are empty; an empty table gives no rows;
    other columns are not looked at.

    Texts are dealt out by ranges of keys once, sorted, and walked through. What
    a walk cannot settle, its last row, is stored with its text, as is its first
    row, and each meets the first row of the next range that has any: two rows
    for each range.
    """
    import hashlib

    kind = docs.schema[key].dataType.simpleString()
    arrow_key = to_arrow_type(docs.schema[key].dataType)
    spark = docs.sparkSession
    names = ["kind", "part", "key", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "text"]
    types = [pa.int8(), pa.int32(), arrow_key, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.string()]
    schema = (
        f"kind byte, part int, key {kind}, n_chars long, edited string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double, text string"
    )

    def settled(part: int, key, own: str, print_: str, following: str, next_print: str) -> tuple:
        body = edited(own, following).encode()
        changed = fingerprint(body)
        near = likeness(print_, changed), likeness(print_, next_print)
        return 0, part, key, len(own), hashlib.sha256(body).hexdigest(), print_, changed, *near, None

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        before = None
        for batch in batches:
            for piece in slices(batch, "text"):
                rows = []
                for part, key, body in zip(*(piece.column(c).to_pylist() for c in ("part", "key", "text")), strict=True):
                    own = body or ""
                    print_ = fingerprint(own.encode())
                    if before is None:
                        rows.append((1, part, key, None, None, print_, None, None, None, own))
                    else:
                        rows.append(settled(*before, own, print_))
                    before = part, key, own, print_
                if rows:
                    yield batch_of(rows)
        if before is not None:
            part, key, own, print_ = before
            yield batch_of([(2, part, key, None, None, print_, None, None, None, own)])

    order = [F.desc_nulls_last("key"), F.col("tie")]
    narrow = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("tie"), F.col(text).alias("text"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = narrow.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    walked = stage(dealt.mapInArrow(walk, schema), "walked")

    ends = walked.filter("kind > 0")
    parts = sorted(r["part"] for r in ends.filter("kind = 1").select("part").collect())  # one for each range
    follows = spark.createDataFrame(list(zip(parts, [*parts[1:], *parts[:1]], strict=True)), "part int, next int")
    heads = ends.filter("kind = 1").select(
        F.col("part").alias("next"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print")
    )
    open_rows = ends.filter("kind = 2").join(follows, "part").join(heads, "next")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = ("part", "key", "text", "fingerprint", "next_text", "next_print")
        for batch in batches:
            rows = [settled(*row) for row in zip(*(batch.column(c).to_pylist() for c in wanted), strict=True)]
            if rows:
                yield batch_of(rows)

    done = walked.filter("kind = 0").union(
        open_rows.select("part", "key", "text", "fingerprint", "next_text", "next_print").mapInArrow(close, schema)
    )
    return done.select(F.col("key").alias(key), *names[3:9])
