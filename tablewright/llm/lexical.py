"""Ranked lexical search: MaxScore whose bounds come from pairs of terms.

Documents are indexed in blocks: one row holds the postings of a few megabytes
of text. Once the corpus statistics are known, the postings of the terms that
queries ask for are turned into impacts, and two kinds of lists are stored beside
them, cut into runs of ``RUN`` documents: the maximum impact of each term, and, for
pairs of terms that a query holds, the maximum *joint* impact over the documents
that hold both. A document's share of a pair is at most the greatest of the joint
maximum and the two single ones, mostly far below the sum of the latter. A query
adds up these bounds for each run and looks only at runs that can still reach its
k-th best score, which a first look at a few blocks gives it to begin with.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import slices, stage, text_bytes

RUN = 128  # documents that share a bound
BLOCK_BYTES = 12 << 20  # text of a block
FIRST = 16  # one block in so many is looked at first
QUERY_BYTES = 8 << 20  # text of the queries that are held at once

# Everything but digits, letters and bytes from 0x80 on ends a term.
_SPLIT = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """The terms of a text, only A-Z lower-cased."""
    return text.translate(_SPLIT).split()


def _joined(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts).astype(kind, copy=False) if parts else np.empty(0, kind)


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)])


def build(docs: DataFrame, text: str = "text", key: str = "doc_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The index of ``docs``, stored: a row for each block of documents.

    ``keys`` and ``sizes`` (terms with repeats) are its documents, those without
    terms left out; ``terms`` its distinct terms in byte order; ``counts`` in how
    many documents each occurs; ``docs`` and ``tfs`` its postings by term.
    """
    kind = docs.schema[key].dataType
    names = ["keys", "sizes", "terms", "counts", "docs", "tfs"]

    def block(parts: list[tuple]) -> pa.RecordBatch:
        keys, sizes = pa.concat_arrays([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        coded = pa.chunked_array([p[2] for p in parts]).unify_dictionaries()
        vocabulary = coded.chunk(0).dictionary
        order = pc.sort_indices(vocabulary)
        rank = np.empty(len(order), np.int64)
        rank[order.to_numpy()] = np.arange(len(order))
        held, at = [], 0
        for own, chunk in zip((p[1] for p in parts), coded.chunks, strict=True):
            number = np.repeat(np.arange(at, at + len(own)), own)
            held.append(np.stack(np.unique(rank[chunk.indices.to_numpy()] * len(keys) + number, return_counts=True)))
            at += len(own)
        held, tfs = np.concatenate(held, axis=1)
        by = np.argsort(held)
        held, tfs = held[by], tfs[by]
        counts = np.bincount(held // len(keys), minlength=len(order))
        row = [
            pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
            pa.array([sizes.tobytes()], pa.binary()),
            pa.ListArray.from_arrays(pa.array([0, len(order)], pa.int32()), vocabulary.take(order)),
            *[pa.array([a.astype(np.int32).tobytes()], pa.binary()) for a in (counts, held % len(keys), tfs)],
        ]
        return pa.RecordBatch.from_arrays(row, names)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for piece in slices(batch, "text"):
                bodies = text_bytes(piece.column("text"))
                found = [terms(body) for body in bodies]
                sizes = np.array([len(f) for f in found], np.int64)
                coded = pa.array([t for f in found for t in f], pa.binary()).dictionary_encode()
                parts.append((piece.column("key").filter(pa.array(sizes > 0)), sizes[sizes > 0], coded))
                size += sum(map(len, bodies))
                if size > block_bytes:
                    if any(len(p[1]) for p in parts):
                        yield block(parts)
                    parts, size = [], 0
        if any(len(p[1]) for p in parts):
            yield block(parts)

    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"keys array<{kind.simpleString()}>, sizes binary, terms array<binary>, counts binary, docs binary, tfs binary"
    return stage(narrow.mapInArrow(blocks, schema), "index")


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _statistics(index: DataFrame, asked: list[bytes]) -> tuple[int, int, np.ndarray]:
    """Documents, terms with repeats, and in how many documents each term of ``asked``, ascending, occurs."""
    sent = index.sparkSession.sparkContext.broadcast(asked)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {t: i for i, t in enumerate(sent.value)}
        df, whole = np.zeros(len(place) + 2, np.int64), len(place)
        for batch in batches:
            for own, sizes, counts in zip(*(batch.column(c).to_pylist() for c in ("terms", "sizes", "counts")), strict=True):
                counts, sizes = np.frombuffer(counts, np.int32), np.frombuffer(sizes, np.int64)
                at = np.array([place.get(t, -1) for t in own], np.int64)
                df[at[at >= 0]] += counts[at >= 0]
                df[whole:] += len(sizes), sizes.sum()
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(df[used])], ["at", "n"])

    counted = index.select("terms", "sizes", "counts").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    found = np.zeros(len(asked) + 2, np.int64)
    for row in counted.toLocalIterator():  # at most one row for each term of the queries held
        found[row.at] = row.n
    return int(found[-2]), int(found[-1]), found[:-2]


class _Plan:
    """Queries at hand: their terms as numbers, in the order of falling weight, cut into pairs from the back."""

    def __init__(self, ids: list, asked: list[list[int]], weights: np.ndarray, run: int):
        self.ids, self.weights, self.run = ids, weights, run
        self.parts: list[list[tuple[int, ...]]] = []
        pairs: dict[tuple[int, int], int] = {}
        for own in asked:
            own = sorted((t for t in own if weights[t] > 0), key=lambda t: (-weights[t], t))
            head = [(own[0],)] if len(own) % 2 else []
            two = [tuple(own[i : i + 2]) for i in range(len(head), len(own), 2)]
            for p in two:
                pairs.setdefault(p, len(pairs))
            self.parts.append([*head, *two])
        self.pairs = list(pairs)
        self.number = pairs


def _impacts(index: DataFrame, sent, documents: int, total: int) -> DataFrame:
    """Each block's impacts and bounds for the terms and pairs of the queries at hand, stored.

    Impacts are without the weight of the term. ``top_*`` lists hold (run, maximum
    impact) by term, ``pair_*`` lists (run, maximum joint impact, weighted) by pair
    over the documents that hold both terms.
    """
    names = ["keys", "n", "own", "starts", "docs", "impacts", "top_starts", "top_runs", "top_most", "pair_starts", "pair_runs", "pair_most"]

    def block(keys: pa.Array, own: list[bytes], sizes: bytes, counts: bytes, docs: bytes, tfs: bytes) -> pa.RecordBatch:
        asked, plan = sent.value
        place = {t: i for i, t in enumerate(asked)}
        sizes = np.frombuffer(sizes, np.int64)
        counts, docs, tfs = (np.frombuffer(a, np.int32) for a in (counts, docs, tfs))
        starts = _starts(counts)
        norms = 50 + (50 * sizes * documents) // total
        held = [(place[t], i) for i, t in enumerate(own) if t in place and plan.weights[place[t]] > 0]
        lists = [docs[starts[i] : starts[i + 1]] for _, i in held]
        impacts = [
            (1_000_000_000 * tf) // (1000 * tf + 20 * norms[d])
            for d, tf in ((d, tfs[starts[i] : starts[i + 1]].astype(np.int64)) for d, (_, i) in zip(lists, held, strict=True))
        ]

        def runs(d: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            run = d // plan.run
            new = np.flatnonzero(np.append(True, run[1:] != run[:-1])) if len(run) else np.empty(0, np.int64)
            return run[new], np.maximum.reduceat(most, new) if len(new) else most[:0]

        top = [runs(d, m) for d, m in zip(lists, impacts, strict=True)]
        at = {t: n for n, (t, _) in enumerate(held)}
        joint, row = [], np.full(len(sizes), -1)
        by_first = defaultdict(list)
        for number, (a, b) in enumerate(plan.pairs):
            if a in at and b in at:
                by_first[a].append((number, b))
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for a, seconds in by_first.items():
            one = at[a]
            row[lists[one]] = np.arange(len(lists[one]))
            for number, b in seconds:
                two = at[b]
                place_a = row[lists[two]]
                both = place_a >= 0
                if both.any():
                    sums = plan.weights[a] * impacts[one][place_a[both]] + plan.weights[b] * impacts[two][both]
                    found[number] = runs(lists[two][both], sums)
            row[lists[one]] = -1
        empty = np.empty(0, np.int64), np.empty(0, np.int64)
        joint = [found.get(n, empty) for n in range(len(plan.pairs))]

        def packed(array: np.ndarray, kind) -> pa.Array:
            return pa.array([np.asarray(array).astype(kind).tobytes()], pa.binary())

        made = [
            pa.array([keys], pa.list_(keys.type)),
            pa.array([len(sizes)], pa.int64()),
            packed(np.array([t for t, _ in held]), np.int32),
            packed(_starts(np.array([len(d) for d in lists], np.int64)), np.int64),
            packed(_joined(lists, np.int32), np.int32),
            packed(_joined(impacts, np.int64), np.int32),
            packed(_starts(np.array([len(r) for r, _ in top], np.int64)), np.int64),
            packed(_joined([r for r, _ in top], np.int32), np.int32),
            packed(_joined([m for _, m in top], np.int64), np.int32),
            packed(_starts(np.array([len(r) for r, _ in joint], np.int64)), np.int64),
            packed(_joined([r for r, _ in joint], np.int32), np.int32),
            packed(_joined([m for _, m in joint], np.int64), np.int64),
        ]
        return pa.RecordBatch.from_arrays(made, names)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rest = (batch.column(c)[i].as_py() for c in ("terms", "sizes", "counts", "docs", "tfs"))
                yield block(batch.column("keys")[i].values, *rest)

    kind = index.schema["keys"].dataType.simpleString()
    schema = f"keys {kind}, n long, " + ", ".join(f"{n} binary" for n in names[2:])
    return stage(index.mapInArrow(blocks, schema), "impacts")


class _Block:
    """One row of ``_impacts``."""

    def __init__(self, batch: pa.RecordBatch, i: int, run: int):
        def array(name: str, kind) -> np.ndarray:
            return np.frombuffer(batch.column(name)[i].as_py(), kind)

        self.keys, self.n = batch.column("keys")[i].values, batch.column("n")[i].as_py()
        self.at = {t: n for n, t in enumerate(array("own", np.int32).tolist())}
        self.starts, self.docs, self.impacts = array("starts", np.int64), array("docs", np.int32), array("impacts", np.int32)
        self.top = array("top_starts", np.int64), array("top_runs", np.int32), array("top_most", np.int32)
        self.pair = array("pair_starts", np.int64), array("pair_runs", np.int32), array("pair_most", np.int64)
        self.run, self.runs = run, (self.n - 1) // run + 1

    def bound(self, plan: _Plan, part: tuple[int, ...]) -> np.ndarray | None:
        """By run, the most that a document can get from one or two terms; None if the block has neither."""
        held = [t for t in part if t in self.at]
        if not held:
            return None
        most = np.zeros(self.runs, np.int64)
        for t in held:
            starts, runs, top = self.top
            i, j = starts[self.at[t] : self.at[t] + 2]
            most[runs[i:j]] = np.maximum(most[runs[i:j]], plan.weights[t] * top[i:j])
        if len(held) == 2:
            starts, runs, joint = self.pair
            number = plan.number[part]
            i, j = starts[number : number + 2]
            most[runs[i:j]] = np.maximum(most[runs[i:j]], joint[i:j])
        return most

    def best(self, plan: _Plan, parts: list[tuple[int, ...]], k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(document, score) of documents that may be among the k best, of score ``least`` or more."""
        known = [(p, b) for p in parts if (b := self.bound(plan, p)) is not None]
        rest = np.zeros((len(known) + 1, self.runs), np.int64)  # bounds of what is still to be added
        for i in range(len(known) - 1, -1, -1):
            rest[i] = rest[i + 1] + known[i][1]
        alive = rest[0] >= max(least, 1)
        scores = np.zeros(self.runs * self.run, np.int64)
        for i, (part, _) in enumerate(known):
            if not alive.any():
                break
            for t in part:
                if t in self.at:
                    start, stop = self.starts[self.at[t] : self.at[t] + 2]
                    docs = self.docs[start:stop]
                    looked = alive[docs // self.run]
                    scores[docs[looked]] += plan.weights[t] * self.impacts[start:stop][looked]
            alive &= scores.reshape(-1, self.run).max(axis=1) + rest[i + 1] >= max(least, 1)
        scores = np.where(np.repeat(alive, self.run), scores, 0)[: self.n]
        docs = np.flatnonzero(scores >= max(least, 1))
        if len(docs) > k:
            edge = np.partition(scores[docs], len(docs) - k)[len(docs) - k]
            docs = docs[scores[docs] >= edge]
        return docs, scores[docs]


def _rank_keys(keys: pa.Array) -> np.ndarray:
    """Numbers in the order of the keys, nulls last."""
    return pc.rank(keys, null_placement="at_end", tiebreaker="dense").to_numpy()


def _found(impacts: DataFrame, sent, k: int, kind: str, arrow_key: pa.DataType, least) -> DataFrame:
    """(query, key, score): of each task and query, the k best documents, ties to the least key."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, plan = sent.value
        floor = list(least.value)
        heaps: list[list[int]] = [[] for _ in plan.parts]  # the k best scores so far
        held: list[list[tuple[pa.Array, np.ndarray]]] = [[] for _ in plan.parts]
        for batch in batches:
            for i in range(batch.num_rows):
                block = _Block(batch, i, plan.run)
                level = None
                for q, parts in enumerate(plan.parts):
                    docs, scores = block.best(plan, parts, k, floor[q])
                    if not len(docs):
                        continue
                    if len(docs) > k:  # ties at the edge
                        level = _rank_keys(block.keys) if level is None else level
                        kept = np.lexsort((level[docs], -scores))[:k]
                        docs, scores = docs[kept], scores[kept]
                    held[q].append((block.keys.take(pa.array(docs)), scores))
                    for s in scores.tolist():
                        if len(heaps[q]) < k:
                            heapq.heappush(heaps[q], s)
                        elif s > heaps[q][0]:
                            heapq.heapreplace(heaps[q], s)
                    if len(heaps[q]) == k:
                        floor[q] = max(floor[q], heaps[q][0])
                    if sum(len(s) for _, s in held[q]) > 8 * k:
                        held[q] = [_best(held[q], k)]
        for q, found in enumerate(held):
            if found:
                keys, scores = _best(found, k)
                query = pa.array(np.full(len(scores), q), pa.int32())
                yield pa.RecordBatch.from_arrays([query, keys, pa.array(scores)], ["query", "key", "score"])

    def _best(found: list, k: int) -> tuple[pa.Array, np.ndarray]:
        keys = pa.concat_arrays([f[0] for f in found])
        scores = np.concatenate([f[1] for f in found])
        kept = np.lexsort((_rank_keys(keys), -scores))[:k]
        return keys.take(pa.array(kept)), scores[kept]

    return impacts.mapInArrow(search, f"query int, key {kind}, score long")


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _bytes(text: Column) -> Column:
    return F.coalesce(F.sum(F.octet_length(text)), F.lit(0))


def search(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 50,
    text: str = "text",
    key: str = "doc_id",
    query_text: str = "text",
    query_key: str = "item_id",
) -> DataFrame:
    """(query_key, rank, key, score): the k documents of highest score above 0 for each query.

    Equal scores are in the order of the document's key, null last; rows that
    repeat a document are documents of their own, and rows of one query key are
    one query of all their terms. Null and empty texts have no terms, no rows and
    no part in the statistics; an empty table on either side gives no rows; other
    columns are not looked at.

    Queries are held in rounds of about ``QUERY_BYTES`` of text, each against all
    blocks; the driver gets their terms and counts, and k rows a query at most
    from the first look.
    """
    index = build(docs, text, key, BLOCK_BYTES)
    sizes = queries.agg(_bytes(F.col(query_text))).first()[0]
    rounds = int(sizes // QUERY_BYTES) + 1
    found = None
    for turn in range(rounds):
        part = queries.filter(F.pmod(F.xxhash64(F.col(query_key)), F.lit(rounds)) == turn) if rounds > 1 else queries
        made = _round(index, part.select(F.col(query_key).alias("id"), F.col(query_text).alias("text")), k, query_key, key)
        found = made if found is None else found.union(made)
    return found


def _round(index: DataFrame, queries: DataFrame, k: int, query_key: str, key: str) -> DataFrame:
    spark = index.sparkSession
    asked: dict = defaultdict(set)
    for row in queries.toLocalIterator():
        asked[row.id].update(terms((row.text or "").encode()))
    ids = list(asked)
    vocabulary = sorted(set().union(*asked.values())) if asked else []
    documents, total, df = _statistics(index, vocabulary)
    weights = np.array([weight(documents, int(n)) if n else 0 for n in df], np.int64)
    place = {t: i for i, t in enumerate(vocabulary)}
    plan = _Plan(ids, [[place[t] for t in asked[i]] for i in ids], weights, RUN)
    sent = spark.sparkContext.broadcast((vocabulary, plan))
    impacts = _impacts(index, sent, documents, max(total, 1))
    kind = index.schema["keys"].dataType.elementType
    arrow_key = to_arrow_type(kind)

    none = spark.sparkContext.broadcast([0] * len(ids))
    few = impacts.filter(F.pmod(F.xxhash64("docs", "n"), F.lit(FIRST)) == 0)
    least = [0] * len(ids)
    first = _top(_found(few, sent, k, kind.simpleString(), arrow_key, none), k).filter(F.col("rank") == k)
    for row in first.select("query", "score").toLocalIterator():  # a score that k documents reach
        least[row["query"]] = row["score"]
    known = spark.sparkContext.broadcast(least)
    best = _top(_found(impacts, sent, k, kind.simpleString(), arrow_key, known), k)
    names = spark.createDataFrame(
        [(n, i) for n, i in enumerate(ids)], f"query int, `{query_key}` {queries.schema['id'].dataType.simpleString()}"
    )
    return best.join(F.broadcast(names), "query").select(query_key, "rank", F.col("key").alias(key), "score")
