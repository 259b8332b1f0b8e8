"""Removal of repeated passages, found through difference-cover anchors.

A window of ``WINDOW`` words that occurs at i and at j contains, at one common
shift below ``PERIOD``, a place where both i and j fall on the cover: every
difference modulo the period is one of two cover members. So only anchors of
``WINDOW - PERIOD + 1`` words at cover places are hashed and compared, 4 of 13
places, and still every repeat shares an anchor. Around shared anchors the match
is extended: the full windows that contain one are compared by 96 hash bits in
the order of documents and places, and all but the first of each lose words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import identity, join_counted, map_batches, stage, stage_and_free, text_bytes

PERIOD = 13
COVER = (0, 1, 3, 9)  # all differences modulo 13 occur among these
BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64


class _Powers:
    """Powers of ``BASE`` and of its inverse modulo 2**64, as long as asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if count > len(self.up):
            size = 1 << int(count).bit_length()
            inverse = pow(BASE, -1, 1 << 64)
            steps = np.full((2, size), 1, np.uint64)
            steps[0, 1:], steps[1, 1:] = BASE, inverse
            self.up, self.down = np.cumprod(steps, axis=1, dtype=np.uint64)
        return self.up[:count], self.down[:count]


_powers = _Powers()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """128 bits for each word, as two rows of unsigned 64-bit numbers."""
    digests = b"".join(map(xxhash.xxh3_128_digest, words))
    return np.ascontiguousarray(np.frombuffer(digests, np.uint64).reshape(-1, 2).T)


def rolling(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive words, from prefix sums."""
    count = hashes.shape[-1] - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    up, down = _powers(len(hashes))
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up, dtype=np.uint64, out=sums[1:])
    made = (sums[size:] - sums[:-size]) * down[:count]
    made ^= made >> np.uint64(32)
    return made * np.uint64(0xD6E8FEB86659FD93)


def _cover(count: int) -> np.ndarray:
    places = (np.arange(0, count, PERIOD)[:, None] + np.array(COVER)).ravel()
    return places[places < count]


def anchors(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of a document's anchors; ``hashes`` is the first row of its word hashes."""
    made = rolling(hashes, window - PERIOD + 1)
    places = _cover(len(made))
    return places, made[places].view(np.int64)


def _tag(r1: str = "r1"):
    """32 bits of a row's identity, by which its anchors find it. Rows that share them at most compare more windows than needed."""
    return F.shiftright(F.col(r1), 32).cast("int")


def _keyed(docs: DataFrame, text: str, key: str) -> DataFrame:
    r1, r2 = identity(key, text)
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text"), r1.alias("r1"), r2.alias("r2"))


def _shared_anchors(docs: DataFrame, window: int) -> DataFrame:
    """(tag, h): anchors that occur twice or more, by row.

    What repeats within a slice of documents is known to be shared there and
    travels by row; one marker per slice tells the others. So an anchor that a
    third of all documents have is not gathered in one task.
    """

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        hashes, tags = [], []
        own = batch.column("tag").to_numpy()
        for row, body in enumerate(text_bytes(batch.column("text"))):
            words = body.split()
            if len(words) >= window:
                made = anchors(word_hashes(words)[0], window)[1]
                hashes.append(made)
                tags.append(np.full(len(made), own[row]))
        if not hashes:
            return None
        found, where, counts = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
        tag = np.concatenate(tags)
        many = counts[where] > 1
        pairs = np.unique(np.stack([found[where[many]], tag[many].astype(np.int64)]), axis=1)
        kind = np.concatenate(
            [np.zeros((~many).sum(), np.int8), np.ones(pairs.shape[1], np.int8), np.full((counts > 1).sum(), 2, np.int8)]
        )
        h = np.concatenate([found[where[~many]], pairs[0], found[counts > 1]])
        t = np.concatenate([tag[~many], pairs[1].astype(np.int32), np.zeros((counts > 1).sum(), np.int32)])
        return pa.RecordBatch.from_arrays([pa.array(kind), pa.array(h), pa.array(t.astype(np.int32))], ["kind", "h", "tag"])

    made = map_batches(docs.select(_tag().alias("tag"), "text"), cut, "kind byte, h long, tag int")
    by = F.when(F.col("kind") == 1, F.xxhash64("tag", "h")).otherwise(F.col("h"))
    dealt = made.repartition(by).sortWithinPartitions("h")

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row, of whose hash more may come
        for batch in batches:
            kind, h, tag = (batch.column(c).to_numpy() for c in ("kind", "h", "tag"))
            known = kind == 1
            if known.any():
                yield pa.RecordBatch.from_arrays([pa.array(tag[known]), pa.array(h[known])], ["tag", "h"])
            kind, h, tag = kind[~known], h[~known], tag[~known]
            if not len(h):
                continue
            before = held is not None and held[1] == h[0]
            same = h[1:] == h[:-1]
            shared = (np.append(before, same) | np.append(same, False)) & (kind == 0)
            if before and held[0] == 0 and not held[3]:
                yield pa.RecordBatch.from_arrays([pa.array([held[2]]), pa.array([held[1]])], ["tag", "h"])
            yield pa.RecordBatch.from_arrays([pa.array(tag[shared]), pa.array(h[shared])], ["tag", "h"])
            held = (kind[-1], h[-1], tag[-1], bool(shared[-1]))

    return stage_and_free(dealt.mapInArrow(repeated, "tag int, h long"), "shared-anchors")


def _copies(docs: DataFrame) -> DataFrame:
    """(r1, r2): rows whose whole text stands in an earlier document; all of their windows start there too."""
    narrow = docs.filter("text is not null and key is not null").select(
        "key", "r1", "r2", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2")
    )
    narrow = stage(narrow, "text-hashes")
    first = narrow.groupBy("t1", "t2").agg(F.min("key").alias("least"), F.count("*").alias("n")).filter("n > 1")
    return join_counted(narrow, stage(first, "copied-texts"), ["t1", "t2"], "n").filter("key > least").select("r1", "r2")


def words_joined(words: list[bytes]) -> bytes:
    return b" ".join(words)


def dedup_passages(
    docs: DataFrame,
    window: int = 20,
    render: Callable[[list[bytes]], bytes] = words_joined,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """(key, n_words, n_removed, kept): rows without the words of windows that start earlier.

    Earlier means in a row of smaller key, or at a smaller place of the same key;
    null keys come last. ``kept`` is what ``render`` makes of the words left.
    Null and empty texts have no words. Rows that repeat another's key and text
    are the same document and lose the same words. An empty table gives no rows;
    other columns are not looked at. ``window`` has to exceed ``PERIOD``.
    """
    if window <= PERIOD:
        raise ValueError(f"window has to be more than {PERIOD} words")
    kind = docs.schema[key].dataType.simpleString()
    arrow_key = to_arrow_type(docs.schema[key].dataType)
    rows = _keyed(docs, text, key)
    nothing = F.lit(None)
    parts = (
        _shared_anchors(rows, window).select("tag", F.lit(0).alias("kind"), "h", nothing.cast("long").alias("r2"),
                                             nothing.cast(kind).alias("key"), nothing.cast("string").alias("text"))
        .union(_copies(rows).select(_tag().alias("tag"), F.lit(1).alias("kind"), nothing.cast("long"), "r2",
                                          nothing.cast(kind), nothing.cast("string")))
        .union(rows.select(_tag().alias("tag"), F.lit(2).alias("kind"), nothing.cast("long"), "r2", "key", "text"))
    )
    # a row's anchors come before the row itself
    dealt = parts.repartition("tag").sortWithinPartitions("tag", "kind")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, known, copied, out = None, [], set(), _Judged(arrow_key)
        for batch in batches:
            kinds, tags = batch.column("kind").to_numpy(), batch.column("tag").to_numpy()
            h = batch.column("h").fill_null(0).to_numpy()
            r2 = batch.column("r2").fill_null(0).to_numpy()
            start = 0
            for i in [*np.flatnonzero(kinds > 0).tolist(), len(kinds)]:
                if i > start:  # rows of kind 0, perhaps of several tags
                    if tags[i - 1] != at:
                        at, known, copied = tags[i - 1], [], set()
                    known.append(h[start:i][tags[start:i] == at])
                start = i + 1
                if i == len(kinds):
                    break
                if tags[i] != at:
                    at, known, copied = tags[i], [], set()
                if kinds[i] == 1:
                    copied.add(r2[i])
                    continue
                body = batch.column("text")[i].as_py() or ""
                words = body.encode().split()
                row = batch.column("key")[i].as_py(), out.number(), len(words)
                if len(words) >= window and r2[i] in copied:
                    out.closed(row, len(words), render([]))
                elif len(words) >= window and known and len(starts := _beside(words, known, window)):
                    out.opened(row, body, word_hashes(words), starts, window)
                else:
                    out.closed(row, 0, render(words))
                if out.full():
                    yield out.flush()
        if out.rows:
            yield out.flush()

    judged = stage_and_free(dealt.mapInArrow(judge, _Judged.schema.format(kind)), "passages")
    return _settle(judged, window, render, kind, arrow_key).withColumnRenamed("key", key)


def _beside(words: list[bytes], known: list[np.ndarray], window: int) -> np.ndarray:
    """Starts of the windows that hold an anchor which is known to be shared."""
    places, own = anchors(word_hashes(words)[0], window)
    count = len(words) - window + 1
    hit = np.zeros(len(words) + 1, np.int64)
    hit[places[np.isin(own, np.concatenate(known))] + 1] = 1
    seen = np.cumsum(hit)
    return np.flatnonzero(seen[PERIOD : PERIOD + count] > seen[:count])


class _Judged:
    """Rows judged so far. Open ones have windows (w, x: hash bits and place) still to be compared.

    Before they leave, windows that repeat among the rows at hand are settled:
    only the first has to travel, and the places of the others go to ``late``.
    """

    schema = "key {}, row long, n_words long, n_removed long, kept binary, text string, w array<long>, x array<long>, late binary"
    names = ["key", "row", "n_words", "n_removed", "kept", "text", "w", "x", "late"]

    def __init__(self, arrow_key: pa.DataType):
        self.types = [arrow_key, *[pa.int64()] * 3, pa.binary(), pa.string(), *[pa.list_(pa.int64())] * 2, pa.binary()]
        self.given = TaskContext.get().partitionId() << 33
        self._clear()

    def number(self) -> int:
        """Another number for each row of the table that is written."""
        self.given += 1
        return self.given

    def _clear(self):
        self.rows, self.spans, self.windows, self.held = [], [], [], 0

    def full(self) -> bool:
        return self.held > 1 << 23

    def closed(self, row: tuple, removed: int, kept: bytes) -> None:
        self.rows.append([*row, removed, kept, None, None, None, None])
        self.held += len(kept) + 64

    def opened(self, row: tuple, body: str, hashes: np.ndarray, starts: np.ndarray, window: int) -> None:
        high = rolling(hashes[1], window)[starts] & np.uint64(0xFFFFFFFF00000000)
        self.spans.append(len(self.rows))
        self.windows.append((rolling(hashes[0], window)[starts], high | starts.astype(np.uint64)))
        self.rows.append([*row, None, None, body, None, None, None])
        self.held += len(body) + 16 * len(starts)

    def flush(self) -> pa.RecordBatch:
        if self.spans:
            w, x = (np.concatenate(c) for c in zip(*self.windows, strict=True))
            sizes = [len(w) for w, _ in self.windows]
            owner = np.repeat(np.arange(len(sizes)), sizes)
            keys = pa.array([self.rows[i][0] for i in self.spans], self.types[0])
            level = _levels(keys)[owner]
            place = (x & np.uint64(0xFFFFFFFF)).astype(np.int64)
            by, late = _not_first(w, x >> np.uint64(32), level, place)
            gone = np.zeros(len(w), bool)
            gone[by] = late
            stops = np.cumsum(sizes)
            for i, start, stop in zip(self.spans, stops - sizes, stops, strict=True):
                stays, lost = ~gone[start:stop], gone[start:stop]
                own_w, own_x = w[start:stop][stays].view(np.int64), x[start:stop][stays].view(np.int64)
                self.rows[i][6:] = [own_w, own_x, place[start:stop][lost].astype("<i4").tobytes()]
        columns = zip(*self.rows, strict=True)
        made = [pa.array(list(c), t) for c, t in zip(columns, self.types, strict=True)]
        self._clear()
        return pa.RecordBatch.from_arrays(made, self.names)


def _levels(keys: pa.Array) -> np.ndarray:
    """Numbers in the order of the keys, equal for equal ones, nulls last."""
    import pyarrow.compute as pc

    return pc.rank(keys, null_placement="at_end", tiebreaker="dense").to_numpy()


def _not_first(w: np.ndarray, top: np.ndarray, level: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the windows and, in it, which start after the first that is alike.

    A window at the key and place of the first, in a row that repeats the
    first's, does not start after it.
    """
    by = np.lexsort((place, level, top, w))
    w, top, level, place = w[by], top[by], level[by], place[by]
    start = np.append(True, (w[1:] != w[:-1]) | (top[1:] != top[:-1]))[: len(w)]
    head = np.maximum.accumulate(np.where(start, np.arange(len(w)), 0))
    return by, (level != level[head]) | (place != place[head])


def _settle(judged: DataFrame, window: int, render, kind: str, arrow_key: pa.DataType) -> DataFrame:
    """Open rows lose the words of every window that is not the first of its hash.

    Places go back to their rows by the number that each row was stored with.
    """
    clear = judged.filter("text is null").select("key", "n_words", "n_removed", "kept")
    opened = judged.filter("text is not null")
    listed = opened.select("key", "row", F.explode(F.arrays_zip("w", "x")).alias("z")).select("key", "row", "z.w", "z.x")
    top, place = F.shiftrightunsigned("x", 32), F.col("x").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    dealt = listed.repartition("w").sortWithinPartitions("w", top, F.asc_nulls_last("key"), place)

    def later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = None  # the head of the run that the last batch ended in
        for batch in batches:
            if first is not None:
                batch = pa.concat_batches([first, batch])
            w, x = (batch.column(c).to_numpy().view(np.uint64) for c in ("w", "x"))
            top, place = x >> np.uint64(32), (x & np.uint64(0xFFFFFFFF)).astype(np.int32)
            start = np.append(True, (w[1:] != w[:-1]) | (top[1:] != top[:-1]))[: len(w)]
            head = np.maximum.accumulate(np.where(start, np.arange(len(w)), 0))
            if len(w):
                level = _levels(batch.column("key"))
                late = (level != level[head]) | (place != place[head])
                columns = [batch.column("row"), pa.array(place)]
                yield pa.RecordBatch.from_arrays(columns, ["row", "place"]).filter(pa.array(late))
                first = batch.slice(int(head[-1]), 1)

    gone = dealt.mapInArrow(later, "row long, place int")
    nothing = F.lit(None)
    parts = gone.select(
        "row", F.lit(0).alias("kind"), "place", nothing.cast(kind).alias("key"), nothing.cast("binary").alias("late"), nothing.cast("string").alias("text")
    ).union(opened.select("row", F.lit(1), nothing.cast("int"), "key", "late", "text"))
    # the places of a row come before the row itself
    regrouped = parts.repartition("row").sortWithinPartitions("row", "kind")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            kinds, keys, rows = batch.column("kind"), batch.column("key"), batch.column("row").to_pylist()
            place = batch.column("place").fill_null(0).to_numpy()
            out, first = [], 0
            for i in [*np.flatnonzero(kinds.to_numpy() == 1).tolist(), len(rows)]:
                if i > first:  # places, of the row at i or, at the end of a batch, of one in the next
                    if rows[i - 1] != at:
                        at, held = rows[i - 1], []
                    while rows[first] != at:
                        first += 1
                    held.append(place[first:i])
                first = i + 1
                if i == len(rows):
                    break
                if rows[i] != at:
                    at, held = rows[i], []
                words = batch.column("text")[i].as_py().encode().split()
                late = np.frombuffer(batch.column("late")[i].as_py(), "<i4")
                starts = np.unique(np.concatenate([late, *held]))
                edge = np.zeros(len(words) + 1, np.int64)
                edge[starts] += 1
                edge[starts + window] -= 1
                gone = np.cumsum(edge)[:-1] > 0
                kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                out.append((keys[i].as_py(), len(words), int(gone.sum()), render(kept)))
            if out:
                types = [arrow_key, pa.int64(), pa.int64(), pa.binary()]
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "n_words", "n_removed", "kept"])

    return clear.union(regrouped.mapInArrow(cut, f"key {kind}, n_words long, n_removed long, kept binary"))
