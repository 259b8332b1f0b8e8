"""Packing tokenised documents into sequences by minimum bin slack.

Only lengths decide a packing, and there are at most ``size`` of them. So the
plan is made on the histogram of lengths, which is as small for a petabyte as
for a file, and then carried out by joins: rows are numbered within their length
and each number is looked up in the plan.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import identity, map_batches, stage

SIZE = 2048
SALTS, PART = 256, 500_000  # parts that the rows of one length are numbered in, at least, and rows of all lengths that ask for another one
CACHED_UNITS = 300_000  # units of text whose ids a Python worker remembers


@cache
def tokenizer(path: str):
    """The tokenizer of a file, once for each Python worker."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def _fast(path: str):
    """An encoder of byte-level BPE files by the same merges, and the file's special tokens.

    ``tiktoken`` runs the vocabulary of ``path`` several times faster than the
    library that the file is made for; texts with special tokens go to the latter.
    """
    import json

    import tiktoken

    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    special = {t["content"] for t in made["added_tokens"]}
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in printable} | {
        chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in printable)
    }
    ranks = {
        bytes(byte_of[c] for c in token): rank for token, rank in made["model"]["vocab"].items() if token not in special
    }
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), sorted(special)


class Encoder:
    """Text to the bytes of its ids, little-endian unsigned 32-bit each.

    The vocabulary's pattern lets a piece begin with one space and never holds
    one elsewhere, so where single spaces part the words, a text falls into units
    that are encoded alike wherever they stand. Units are remembered, up to
    ``CACHED_UNITS``; texts with other white space beside a space are encoded whole.
    """

    def __init__(self, path: str):
        self.whole = tokenizer(path)
        self.fast, self.special = _fast(path)
        self.units: dict[str, bytes] = {}

    def _encode(self, text: str) -> bytes:
        return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        first, *rest = text.split(" ")
        if not rest:
            return self._encode(text)
        if any(u != u.strip() or not u for u in (first, *rest)):
            return self._encode(text)
        units = self.units
        made = [self._encode(first)]
        for unit in rest:
            ids = units.get(unit)
            if ids is None:
                if len(units) >= CACHED_UNITS:
                    units.clear()
                ids = units[unit] = self._encode(" " + unit)
            made.append(ids)
        return b"".join(made)


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces(
    docs: DataFrame, path: str, end: int = 1, size: int = SIZE, ids: bool = False, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """(key, r1, r2, start, length, ids_crc32, doc_tokens[, ids]): documents cut at every ``size`` ids.

    A document is the ids of its text and then ``end``; a null text is empty and
    gives that one id. With ``ids`` the piece's ids come along, as bytes.
    """
    import zlib

    kind = docs.schema[key].dataType.simpleString()
    stop = np.array([end], "<u4").tobytes()

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        encode = encoder(path)
        source, starts, lengths, sums, totals, held = [], [], [], [], [], []
        for row, body in enumerate(batch.column("text").to_pylist()):
            made = encode(body or "") + stop
            total = len(made) // 4
            for start in range(0, total, size):
                part = made[4 * start : 4 * (start + size)]
                source.append(row)
                starts.append(start)
                lengths.append(len(part) // 4)
                sums.append(zlib.crc32(part))
                totals.append(total)
                if ids:
                    held.append(part)
        taken = batch.select(["key", "r1", "r2"]).take(pa.array(source, pa.int64()))
        columns = [*taken.columns, *(pa.array(c, pa.int64()) for c in (starts, lengths, sums, totals))]
        names = ["key", "r1", "r2", "start", "length", "ids_crc32", "doc_tokens"]
        if ids:
            columns.append(pa.array(held, pa.binary()))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names)

    r1, r2 = identity(key, text)
    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), r1.alias("r1"), r2.alias("r2"))
    schema = f"key {kind}, r1 long, r2 long, start long, length long, ids_crc32 long, doc_tokens long"
    made = map_batches(narrow, cut, schema + (", ids binary" if ids else ""))
    return made.withColumnRenamed("key", key)


def _best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of the lengths at hand whose sum comes closest to ``room`` from below.

    Bit s of a set says that sum s can be reached. Lengths come in one by one,
    longest first, each as often as it is there, in doubling steps; walking the
    steps back from the best sum gives how many of each were used.
    """
    full = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted((n for n in counts if n <= room), reverse=True):
        left, times = min(counts[length], room // length), 1
        while left:
            take = min(times, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & full
            left -= take
            times *= 2
        if reach >> room & 1:
            break
    at = reach.bit_length() - 1
    used: dict[int, int] = {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            at -= length * take
            used[length] = used.get(length, 0) + take
    return used


def plan(histogram: dict[int, int], size: int = SIZE) -> list[tuple[dict[int, int], int]]:
    """[(lengths of a bin with their counts, number of such bins)], using up the histogram.

    The longest remaining length opens a bin and the best multiset of the rest
    fills it. The bin is repeated as long as its lengths last, so every step uses
    up one length at least.
    """
    left = {n: c for n, c in histogram.items() if c}
    made = []
    while left:
        longest = max(left)
        left[longest] -= 1
        rest = {n: c for n, c in left.items() if c}
        used = _best_fill(rest, size - longest)
        left[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        times = min(left[n] // c for n, c in used.items())
        made.append((used, times))
        for n, c in used.items():
            left[n] -= c * times
            if not left[n]:
                del left[n]
    return made


def _runs(steps: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, ranks, per bin, first sequence, offset of the first in a bin) for each step and length."""
    ranks: dict[int, int] = {}
    sequence, rows = 0, []
    for used, times in steps:
        offset = 0
        for length, per in sorted(used.items(), reverse=True):
            first = ranks.get(length, 0)
            rows.append((length, first, per * times, per, sequence, offset))
            ranks[length] = first + per * times
            offset += per * length
        sequence += times
    return rows


def pack(items: DataFrame, size: int = SIZE, salts: int | None = None) -> DataFrame:
    """``items`` with ``copy``, ``sequence_id`` and ``offset``; needs length (1 to ``size``), r1, r2 and start.

    Rows are numbered within (length, salt), a salt being drawn from the row's
    identity, and the counts of the salts before are added: a length that a third
    of all rows have is numbered in ``salts`` parts, by default one for each
    ``PART`` rows, so that a part keeps its size at any number of rows. The plan has a row for each
    step and length, at most ``size`` steps, and is joined to the length's
    numbers as a range. Repeated rows are placed one by one; ``copy`` numbers
    them from 0, the pieces of one copy alike. An empty table gives
    no rows. ``items`` has to be a stored table, as it is read twice.
    """
    spark = items.sparkSession
    if salts is None:
        salts = max(SALTS, items.count() // PART)  # read from the file footers
    salted = items.withColumn("__salt", F.pmod(F.xxhash64("r1", "start"), F.lit(salts)).cast("int"))
    counts = stage(salted.groupBy("length", "__salt").agg(F.count("*").alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = F.sum("n").over(Window.partitionBy("length").orderBy("__salt")) - F.col("n")
    offsets = counts.select("length", "__salt", before.alias("__before"))
    order = Window.partitionBy("length", "__salt").orderBy("r1", "r2", "start")
    number = F.row_number().over(order)
    numbered = salted.join(offsets, ["length", "__salt"]).withColumns(
        {"__rank": F.col("__before") + number - 1, "copy": (number - F.rank().over(order)).cast("long")}
    )
    runs = spark.createDataFrame(
        _runs(plan(histogram, size)),
        "length long, first long, ranks long, per long, sequence long, base long",
    )
    by_length = runs.groupBy("length").agg(
        F.array_sort(F.collect_list(F.struct("first", "per", "sequence", "base"))).alias("__runs")
    )
    # at most ``size`` rows with ``size`` runs each: its size depends on that parameter alone
    placed = numbered.join(F.broadcast(by_length), "length")
    run = F.element_at(F.filter("__runs", lambda r: r["first"] <= F.col("__rank")), -1)
    within = F.col("__rank") - F.col("__run.first")
    return (
        placed.withColumn("__run", run)
        .withColumn("sequence_id", F.col("__run.sequence") + F.floor(within / F.col("__run.per")).cast("long"))
        .withColumn("offset", F.col("__run.base") + within % F.col("__run.per") * F.col("length"))
        .select(*items.columns, "copy", "sequence_id", "offset")
    )


def pack_documents(
    docs: DataFrame, path: str, end: int = 1, size: int = SIZE, ids: bool = False, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Every document's pieces, placed: (key, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    With ``ids`` also the row's identity, the pieces' ids and the number of the
    copy: (key, r1, r2, start, length, ids_crc32, doc_tokens, ids, copy,
    sequence_id, offset). ``sequences`` makes the sequences of that, and (r1, r2,
    copy) tells the documents apart, repeated rows included.
    """
    placed = pack(stage(pieces(docs, path, end, size, ids, text, key), "pieces"), size)
    return placed if ids else placed.drop("r1", "r2", "copy")


def sequences(placed: DataFrame, size: int = SIZE, pad: int = 0) -> DataFrame:
    """(sequence_id, ids): the padded sequences of placed pieces that carry their ``ids`` bytes."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"]))
    fill = pad.to_bytes(4, "little") * size
    return placed.groupBy("sequence_id").agg(joined.alias("ids")).select(
        "sequence_id", F.substring(F.concat("ids", F.lit(fill)), 1, 4 * size).alias("ids")
    )
