"""Removal of lines that many documents share, kept reversible.

The state of a corpus is two tables. ``counts`` holds, for every line key, the
exact number of documents that have it; ``filters`` holds, for every shard of
the keys, a cuckoo filter of the keys that reach the threshold. Adding documents
raises counts and puts keys that cross the threshold into their filter; deleting
documents lowers counts and takes keys out again, which a cuckoo filter can do
and a Bloom filter cannot. Lines are tried against the filter of their shard,
and the few that pass are settled by the exact counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import identity, map_batches, stage, text_bytes

STRIPPED = b" \t\n\x0b\x0c\r"
SLOTS = 4
SHARDS = 64  # at least; more where they would hold more than SHARD_KEYS keys each
SHARD_KEYS = 200_000
SALTS = 64
KICKS = 500


class CuckooFilter:
    """A set of 64-bit hashes with rare false positives and with deletion.

    Each hash has a 16-bit tag and two buckets of ``SLOTS`` places; a full bucket
    moves a tag to its other bucket. ``add`` returns False if no place is found for
    all; tags may be lost then, and the caller builds a larger filter.
    """

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def sized(cls, items: int) -> CuckooFilter:
        buckets = 1 << max(3, int(np.ceil(np.log2(max(items, 1) / (SLOTS * 0.8)))))
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def of(cls, hashes: np.ndarray) -> CuckooFilter:
        size = len(hashes)
        while True:
            made = cls.sized(size)
            if made.add(hashes):
                return made
            size = 2 * size + SLOTS

    @classmethod
    def from_bytes(cls, blob: bytes) -> CuckooFilter:
        return cls(np.frombuffer(blob, np.uint16).reshape(-1, SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = np.uint64(len(self.table) - 1)
        tags = (hashes >> np.uint64(48)).astype(np.uint16)
        tags[tags == 0] = 1  # 0 marks a free place
        first = hashes & mask
        return tags, first.astype(np.int64), self._other(first, tags).astype(np.int64)

    def _other(self, bucket: np.ndarray, tags: np.ndarray) -> np.ndarray:
        spread = tags.astype(np.uint64) * np.uint64(0x9E3779B1)
        return (bucket ^ spread) & np.uint64(len(self.table) - 1)

    def _put(self, tags: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        """Place tags where their buckets have room, as many of each bucket as fit; which of them found none."""
        by = np.argsort(buckets, kind="stable")
        own = buckets[by]
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else np.empty(0, np.int64)
        rank = np.arange(len(own)) - np.repeat(first, np.diff(np.append(first, len(own))))
        taken = self.table[own] != 0
        fits = rank < SLOTS - taken.sum(axis=1)
        free = np.argsort(taken, axis=1, kind="stable")  # free places first
        self.table[own[fits], free[fits, rank[fits]]] = tags[by][fits]
        left = np.ones(len(tags), bool)
        left[by[fits]] = False
        return left

    def add(self, hashes: np.ndarray) -> bool:
        """Add all at once: into the first bucket, the second one, and then by moving a tag out of each full bucket."""
        tags, bucket, other = self._places(hashes)
        left = self._put(tags, bucket)
        tags, other = tags[left], other[left]
        left = self._put(tags, other)
        tags, other = tags[left], other[left]
        for kick in range(KICKS):
            if not len(tags):
                return True
            _, chosen = np.unique(other, return_index=True)  # one tag moves out of a bucket at a time
            at, slot = other[chosen], kick % SLOTS
            moved = self.table[at, slot].copy()
            self.table[at, slot] = tags[chosen]
            rest = np.ones(len(tags), bool)
            rest[chosen] = False
            next_bucket = self._other(at.astype(np.uint64), moved).astype(np.int64)
            tags, other = np.concatenate([tags[rest], moved]), np.concatenate([other[rest], next_bucket])
            left = self._put(tags, other)
            tags, other = tags[left], other[left]
        return not len(tags)

    def remove(self, value: int) -> bool:
        tags, first, second = self._places(np.array([value], np.uint64))
        for bucket in (int(first[0]), int(second[0])):
            found = np.flatnonzero(self.table[bucket] == tags[0])
            if len(found):
                self.table[bucket, found[0]] = 0
                return True
        return False

    def has(self, hashes: np.ndarray) -> np.ndarray:
        tags, first, second = self._places(hashes)
        return ((self.table[first] == tags[:, None]) | (self.table[second] == tags[:, None])).any(axis=1)


def line_keys(text: bytes) -> list[bytes]:
    """A 128-bit hash of each line's key: ends stripped, A-Z lower-cased; empty for an empty key."""
    digest = xxhash.xxh3_128_digest
    return [digest(k) if k else b"" for k in (line.strip(STRIPPED).lower() for line in text.split(b"\n"))]


def occurrences(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(r1, r2, k1, k2): each distinct line key of each row once; empty keys are left out."""

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, keys = [], []
        for row, body in enumerate(text_bytes(batch.column("text"))):
            found = {k for k in line_keys(body) if k}
            rows += [row] * len(found)
            keys += found
        halves = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
        owners = batch.select(["r1", "r2"]).take(pa.array(rows, pa.int64()))
        columns = [*owners.columns, pa.array(halves[:, 0]), pa.array(halves[:, 1])]
        return pa.RecordBatch.from_arrays(columns, ["r1", "r2", "k1", "k2"])

    r1, r2 = identity(key, text)
    narrow = docs.select(F.col(text).alias("text"), r1.alias("r1"), r2.alias("r2"))
    return map_batches(narrow, of, "r1 long, r2 long, k1 long, k2 long")


def _shard(shards: int):
    return F.pmod(F.col("k1"), F.lit(shards)).cast("int")


def _filter_of(keys: pa.Table) -> pa.Table:
    blob = CuckooFilter.of(keys.column("k1").to_numpy().view(np.uint64)).to_bytes()
    return pa.table({"shard": keys.column("shard").slice(0, 1), "filter": pa.array([blob], pa.binary())})


def _filters_of(counts: DataFrame, least: int, shards: int) -> DataFrame:
    held = counts.filter(f"n >= {least}").select(_shard(shards).alias("shard"), "k1")
    return held.groupBy("shard").applyInArrow(_filter_of, "shard int, filter binary")


@dataclass
class LineIndex:
    """Exact counts and sharded filters of a corpus; every change makes new stored tables.

    ``shards`` grow with the keys: when those at the threshold outgrow them, all
    filters are built anew from the counts, in twice as many as are needed.
    """

    counts: DataFrame
    filters: DataFrame
    least: int
    shards: int

    @classmethod
    def empty(cls, spark, least: int = 10, shards: int = SHARDS) -> LineIndex:
        counts = spark.createDataFrame([], "k1 long, k2 long, n long")
        return cls(counts, spark.createDataFrame([], "shard int, filter binary"), least, shards)

    @classmethod
    def of(cls, found: DataFrame, least: int = 10, shards: int = SHARDS) -> LineIndex:
        """The index of the documents whose line keys ``found`` (r1, r2, k1, k2) holds."""
        counts = stage(found.groupBy("k1", "k2").agg(F.count("*").alias("n")), "line-counts")
        needed = -(-counts.filter(f"n >= {least}").count() // SHARD_KEYS)
        shards = 2 * needed if needed > shards else shards
        return cls(counts, stage(_filters_of(counts, least, shards), "line-filters"), least, shards)

    def insert(self, docs: DataFrame, text: str = "text", key: str = "doc_id") -> LineIndex:
        """The index with ``docs`` added; each row counts as a document."""
        return self._changed(occurrences(docs, text, key), 1)

    def delete(self, docs: DataFrame, text: str = "text", key: str = "doc_id") -> LineIndex:
        """The index as if ``docs``, which were inserted before, had never been."""
        return self._changed(occurrences(docs, text, key), -1)

    def _changed(self, found: DataFrame, sign: int) -> LineIndex:
        delta = found.groupBy("k1", "k2").agg((sign * F.count("*")).alias("change"))
        zero = F.lit(0).cast("long")
        both = self.counts.join(delta, ["k1", "k2"], "full").select(
            "k1", "k2", F.coalesce("n", zero).alias("old"), (F.coalesce("n", zero) + F.coalesce("change", zero)).alias("n")
        )
        after = stage(both, "line-counts")
        crossed = after.filter(f"(old >= {self.least}) <> (n >= {self.least})")
        counts = after.filter("n > 0").select("k1", "k2", "n")
        needed = -(-after.filter(f"n >= {self.least}").count() // SHARD_KEYS)
        if needed > self.shards:
            shards = 2 * needed
            return LineIndex(counts, stage(_filters_of(counts, self.least, shards), "line-filters"), self.least, shards)
        return LineIndex(counts, stage(self._filters(crossed, counts), "line-filters"), self.least, self.shards)

    def _filters(self, crossed: DataFrame, counts: DataFrame) -> DataFrame:
        """The filters after keys crossed the threshold; a filter that overflows is built anew from the counts."""
        least = self.least
        ours = crossed.select(_shard(self.shards).alias("shard"), "k1", (F.col("n") >= least).alias("up"))

        def change(left: pa.Table, right: pa.Table) -> pa.Table:
            shard = (left if left.num_rows else right).column("shard")[0].as_py()
            keys = right.column("k1").to_numpy().view(np.uint64)
            up = right.column("up").to_numpy().astype(bool)
            if left.num_rows:
                made = CuckooFilter.from_bytes(left.column("filter")[0].as_py())
                for gone in keys[~up].tolist():
                    made.remove(gone)
                fits = made.add(keys[up])
            else:
                made, fits = CuckooFilter.of(keys[up]), True
            blob = made.to_bytes() if fits else None
            return pa.table({"shard": pa.array([shard], pa.int32()), "filter": pa.array([blob], pa.binary())})

        changed = stage(
            self.filters.groupBy("shard").cogroup(ours.groupBy("shard")).applyInArrow(change, "shard int, filter binary"),
            "line-filters",
        )

        over = changed.filter("filter is null").select("shard")
        held = counts.filter(f"n >= {least}").select(_shard(self.shards).alias("shard"), "k1")
        rebuilt = held.join(over, "shard", "left_semi").groupBy("shard").applyInArrow(_filter_of, "shard int, filter binary")
        return changed.filter("filter is not null").unionByName(rebuilt)

    def shared(self, found: DataFrame, salts: int = SALTS) -> DataFrame:
        """The rows of ``found`` (r1, r2, k1, k2) whose key is in at least ``least`` documents.

        Each filter goes to ``salts`` tasks, so that the rows of a line that a
        third of all documents have are tried in as many parts.
        """
        lines = found.select(
            _shard(self.shards).alias("shard"),
            F.pmod(F.xxhash64("r1"), F.lit(salts)).cast("int").alias("salt"),
            F.lit(1).alias("kind"), "r1", "r2", "k1", "k2", F.lit(None).cast("binary").alias("filter"),
        )
        nothing = F.lit(None).cast("long")
        copies = self.filters.select(
            "shard", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(0).alias("kind"),
            nothing.alias("r1"), nothing.alias("r2"), nothing.alias("k1"), nothing.alias("k2"), "filter",
        )
        # a filter comes before the rows of its shard and salt
        dealt = copies.union(lines).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")

        def tried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, held = None, None
            for batch in batches:
                place = list(zip(batch.column("shard").to_pylist(), batch.column("salt").to_pylist(), strict=True))
                kinds = batch.column("kind").to_numpy()
                keys = batch.column("k1").fill_null(0).to_numpy().view(np.uint64)
                passed = np.zeros(len(place), bool)
                breaks = [i for i in range(len(place)) if i == 0 or kinds[i] == 0 or place[i] != place[i - 1]]
                for start, stop in zip(breaks, [*breaks[1:], len(place)], strict=True):
                    if place[start] != at:
                        at, held = place[start], None
                    if kinds[start] == 0:
                        held = CuckooFilter.from_bytes(batch.column("filter")[start].as_py())
                        start += 1
                    if held is not None and stop > start:
                        passed[start:stop] = held.has(keys[start:stop])
                yield batch.select(["r1", "r2", "k1", "k2"]).filter(pa.array(passed))

        likely = dealt.mapInArrow(tried, "r1 long, r2 long, k1 long, k2 long")
        sure = self.counts.filter(f"n >= {self.least}").select("k1", "k2")
        return likely.join(sure, ["k1", "k2"], "left_semi")


MADE = ("__kept", "__lines", "__dropped")


def drop_lines(docs: DataFrame, found: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with ``__kept`` (text), ``__lines`` and ``__dropped``; ``found`` has the keys to drop by row.

    Columns of these three names are replaced.
    """
    fields = [f for f in docs.schema if f.name not in MADE]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    names = [f.name for f in fields]

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept, total, gone = [], [], []
        bodies = text_bytes(batch.column("body"))
        for body, k1, k2 in zip(bodies, batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), strict=True):
            lines = body.split(b"\n")
            total.append(len(lines))
            if k1:
                drop = {k.tobytes() for k in np.array([k1, k2], np.int64).T}
                lines = [ln for ln, k in zip(lines, line_keys(body), strict=True) if k not in drop]
                body = b"\n".join(lines)
            gone.append(total[-1] - len(lines))
            kept.append(body)
        made = [pa.array(kept, pa.binary()).cast(pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())]
        return pa.RecordBatch.from_arrays([*batch.column("row").flatten(), *made], [*names, *MADE])

    r1, r2 = identity(key, text)
    drops = found.groupBy("r1", "r2").agg(F.collect_set(F.struct("k1", "k2")).alias("k")).select("r1", "r2", "k.k1", "k.k2")
    # the row travels whole, so that no name of its own can clash with these
    row = F.struct(*[F.col(f"`{n}`") for n in names]).alias("row")
    rows = docs.select(row, F.col(text).alias("body"), r1.alias("r1"), r2.alias("r2"))
    joined = rows.join(drops, ["r1", "r2"], "left")
    return map_batches(joined, cut, f"{kinds}, __kept string, __lines long, __dropped long", "body")


def dedup_lines(docs: DataFrame, least: int = 10, text: str = "text", key: str = "doc_id", shards: int = SHARDS) -> DataFrame:
    """``docs`` with ``__kept``, ``__lines`` and ``__dropped``: lines in at least ``least`` documents go everywhere.

    A null or empty text is one empty line, and empty lines always stay. A line
    that a document repeats counts once for it; repeated rows count each. An
    empty table gives no rows; other columns pass through.
    """
    found = stage(occurrences(docs, text, key), "line-keys")
    return drop_lines(docs, LineIndex.of(found, least, shards).shared(found), text, key)
