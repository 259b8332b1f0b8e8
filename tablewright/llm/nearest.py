"""Nearest neighbours by multi-index hashing.

Vectors become binary codes: they are turned by rotations that were learned to
lie close to the corners of the cube (iterative quantisation), and the signs are
kept. Codes are cut into substrings, and each substring has an index from its
value to the rows that have it. A code within Hamming distance r of a query has
a substring within a share of r by the pigeonhole principle, so probing the
values near the query's substrings retrieves every code within r. Those are
ranked again by the vectors themselves.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

CODE_BITS = 256
SUB_BITS = 16
TRAINED = 4096  # vectors that the rotations are learned from at most
TRIED = 64  # queries that the radius is learned from at most
COVERED = 0.97  # share of the true neighbours of those queries that the radius has to reach
QUERY_BLOCK = 1024
ROW_BLOCK = 65536


def usable(vector: Column, size: int | Column) -> Column:
    """A vector of the right length whose components are finite and not all 0."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) == size) & finite & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, size)


@dataclass
class Codes:
    """Mean, rotations (vector size x code bits) and the radius to probe."""

    mean: np.ndarray
    turn: np.ndarray
    radius: int = 0

    @classmethod
    def learn(cls, vectors: np.ndarray, bits: int = CODE_BITS, steps: int = 20, seed: int = 0) -> Codes:
        mean = vectors.mean(axis=0)
        centred = vectors - mean
        dice, size = np.random.default_rng(seed), vectors.shape[1]
        turns = []
        for _ in range(-(-bits // size)):
            turn = np.linalg.qr(dice.normal(size=(size, size)))[0]
            for _ in range(steps):  # nearest corners, then the rotation that brings the vectors nearest to them
                left, _, right = np.linalg.svd(centred.T @ np.sign(centred @ turn))
                turn = left @ right
            turns.append(turn)
        return cls(mean, np.concatenate(turns, axis=1)[:, :bits])

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """The codes as rows of ``SUB_BITS`` wide substrings."""
        signs = (vectors - self.mean) @ self.turn > 0
        return np.packbits(signs, axis=1).view(np.uint16)


@cache
def _near_values(reach: int) -> np.ndarray:
    """Values of a substring with at most ``reach`` bits set: what a probe is combined with."""
    found = [sum(1 << b for b in c) for n in range(reach + 1) for c in combinations(range(SUB_BITS), n)]
    return np.array(found, np.uint16)


class Index:
    """For each substring, rows by its value."""

    def __init__(self, codes: np.ndarray):
        self.codes = np.ascontiguousarray(codes)
        self.wide = self.codes.view(np.uint64)
        self.rows = np.argsort(codes, axis=0, kind="stable").astype(np.int32)
        values = np.arange((1 << SUB_BITS) + 1)
        self.starts = [np.searchsorted(codes[self.rows[:, s], s], values).astype(np.int32) for s in range(codes.shape[1])]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows at most ``radius`` bits away, all of them.

        If no substring of the first a were within t, and no other within t - 1,
        the distance would be more than the radius.
        """
        subs = len(self.starts)
        share, rest = divmod(radius, subs)
        hit = np.zeros(len(self.codes), bool)
        for s, starts in enumerate(self.starts):
            reach = share if s <= rest else share - 1
            if reach < 0:
                continue
            values = code[s] ^ _near_values(min(reach, SUB_BITS))
            low, counts = starts[values], starts[values.astype(np.int64) + 1] - starts[values]
            low, counts = low[counts > 0], counts[counts > 0]
            if len(low):
                places = np.repeat(low - np.append(0, counts.cumsum()[:-1]), counts) + np.arange(counts.sum())
                hit[self.rows[places, s]] = True
        found = np.flatnonzero(hit)
        far = np.bitwise_count(self.wide[found] ^ code.view(np.uint64)).sum(axis=1)
        return found[far <= radius]


def _best(ids: np.ndarray, vectors: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` rows of largest inner product, ties to the smaller id, without the query's own."""
    scores = (vectors * query).sum(axis=1)  # row by row, so that equal vectors score equally
    other = ids != own
    ids, scores = ids[other], scores[other]
    if len(ids) > k:
        floor = np.partition(scores, len(ids) - k)[len(ids) - k]
        ids, scores = ids[scores >= floor], scores[scores >= floor]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    query_block: int = QUERY_BLOCK,
    row_block: int = ROW_BLOCK,
) -> DataFrame:
    """(query_id, rank, key, score): for each query the ``k`` nearest rows found, by inner product.

    ``queries`` has the columns of ``vectors``; a row of the query's own key is
    no candidate. Blocks of queries meet blocks of rows, each pair of blocks in a
    task of its own with the indexes of its rows, and the best of each pair are
    merged: at most ``k`` rows for each query and block of rows. If a block of
    rows has fewer than ``k`` within the radius, the radius grows there.

    Vectors that are null, zero, of another length or hold null or non-finite
    components take no part, nor do null keys. Repeated rows are candidates
    each. The length is that of most vectors that are usable otherwise. With
    fewer rows than ``k`` all are returned; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    out = "query_id long, row long, score double"
    plain = [F.col(key).cast("long").alias("row"), F.transform(vector, lambda x: x.cast("double")).alias("v")]
    sized = vectors.select(*plain).filter("row is not null and v is not null")
    whole = sized.filter(usable(F.col("v"), F.size("v")))
    size = whole.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    size = size["size"] if size else 1
    rows = stage(sized.filter(usable(F.col("v"), size)), "vectors")
    asked = stage(
        queries.select(*plain).filter(F.col("row").isNotNull() & usable(F.col("v"), size)), "queries"
    )
    counts = rows.count(), asked.count()
    if not all(counts):
        return spark.createDataFrame([], f"query_id long, rank int, `{key}` long, score double")
    model = _learned(rows, asked, size, k)
    blocks = -(-counts[0] // row_block), -(-counts[1] // query_block)

    def dealt(df: DataFrame, count: int, copies: int, side: str, other: str) -> DataFrame:
        block = F.pmod(F.xxhash64("row", "v"), F.lit(count)).cast("int").alias(side)
        return df.select(block, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias(other), "row", "v")

    left = dealt(rows, blocks[0], blocks[1], "of_rows", "of_queries").groupBy("of_rows", "of_queries")
    right = dealt(asked, blocks[1], blocks[0], "of_queries", "of_rows").groupBy("of_rows", "of_queries")
    sent = spark.sparkContext.broadcast(model)

    def meet(here: pa.Table, there: pa.Table) -> pa.Table:
        made = [], [], []
        if here.num_rows and there.num_rows:
            own = here.column("row").to_numpy(), _matrix(here.column("v").combine_chunks(), size)
            asks = there.column("row").to_numpy(), _matrix(there.column("v").combine_chunks(), size)
            codes = sent.value
            index = Index(codes.of(own[1]))
            for ask, query, code in zip(*asks, codes.of(asks[1]), strict=True):
                radius = codes.radius
                found = index.within(code, radius)
                while len(found) <= k and len(found) < here.num_rows:
                    radius = min(2 * radius + 8, CODE_BITS)
                    found = index.within(code, radius)
                ids, scores = _best(own[0][found], own[1][found], query, ask, k)
                made[0].append(np.full(len(ids), ask))
                made[1].append(ids)
                made[2].append(scores)
        columns = [np.concatenate(m) if m else np.empty(0, t) for m, t in zip(made, (np.int64, np.int64, float), strict=True)]
        return pa.table(dict(zip(("query_id", "row", "score"), columns, strict=True)))

    met = left.cogroup(right).applyInArrow(meet, out)
    # a query has at most k rows from each block of rows
    best = met.groupBy("query_id").agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("order"), "row", "score"))), 1, k).alias("best")
    )
    return best.select("query_id", F.posexplode("best").alias("at", "one")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("one.row").alias(key), "one.score"
    )


def _learned(rows: DataFrame, asked: DataFrame, size: int, k: int) -> Codes:
    """Rotations from a bounded sample, and the radius that reaches most true neighbours of a few queries.

    The few queries are compared with all rows, so that the radius fits a corpus
    of this size and not that of the sample.
    """

    def bounded(df: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
        found = df.orderBy(F.xxhash64("row", "v"), "row").limit(most).toArrow()
        return found.column("row").to_numpy(), _matrix(found.column("v").combine_chunks(), size)

    codes = Codes.learn(bounded(rows, TRAINED)[1])
    ids, vectors = bounded(asked, TRIED)
    sent = rows.sparkSession.sparkContext.broadcast((ids, vectors, codes))

    def compare(batches):
        import heapq

        ids, vectors, codes = sent.value
        wide, best = codes.of(vectors).view(np.uint64), [[] for _ in ids]
        for batch in batches:
            own, held = batch.column("row").to_numpy(), _matrix(batch.column("v"), size)
            scores, code = vectors @ held.T, codes.of(held).view(np.uint64)
            for q, ask in enumerate(ids):
                top = np.argsort(-scores[q])[: k + 1]
                far = np.bitwise_count(code[top] ^ wide[q]).sum(axis=1)
                more = [(float(scores[q, t]), int(f)) for t, f in zip(top, far, strict=True) if own[t] != ask]
                best[q] = heapq.nlargest(k, best[q] + more)
        flat = [(q, s, f) for q, found in enumerate(best) for s, f in found]
        if flat:
            names = ("query", "score", "far")
            yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*flat, strict=True)), strict=True)))

    near = rows.mapInArrow(compare, "query long, score double, far long").toArrow().to_pandas()
    true = near.sort_values(["query", "score"], ascending=[True, False]).groupby("query").head(k)
    codes.radius = int(np.quantile(true["far"], COVERED, method="higher")) if len(true) else CODE_BITS
    return codes
