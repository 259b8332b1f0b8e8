"""The trie of all conversations' turns, finished shard by shard around a broadcast skeleton.

A conversation is a path: 24 bytes a turn, of which 16 are a digest of role and
text and 8 the length of the text. Distinct paths are ordered as bytes, so the
conversations below a node are neighbours. Splitters, drawn by a hash and
weighed by turns, cut that order into ranges. The prefixes of the splitters are
the skeleton: only their nodes can reach over a border. Each range is one task,
which walks its sorted paths with a stack and finishes every other node; what it
knows of skeleton nodes are partial aggregates, which are added up and rolled up
along the skeleton.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

TURN = 24  # bytes of a turn in a path
SHARD_TURNS = 100_000  # turns of a range, more where there are MOST ranges
MOST, DEEP = 16_384, 32  # ranges, and turns of a splitter: the skeleton has at most their product of nodes
PIECE = 1 << 20  # bytes of a list of members that travel in one row

NOTHING = hashlib.sha256(b"").hexdigest()


def _turn(role: Column, text: Column) -> Column:
    """The bytes of a turn in a path, as hexadecimal text; null role and text are empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    return F.concat(digest, F.lower(F.lpad(F.hex(F.octet_length(text).cast("long")), 16, "0")))


def paths(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, path): one row for each conversation.

    Turns are in the order of ``turn``, null first, then of role and of a hash of
    role and text, so turns of one number have a fixed order and repeated rows are
    repeated turns. Rows without a key take no part. A path is one cell: a
    conversation can have some 40 million turns.
    """
    narrow = turns.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("conv_id"),
        F.struct(F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), _turn(F.col(role), F.col(text)).alias("t")).alias("s"),
    )
    ordered = F.transform(F.sort_array(F.collect_list("s")), lambda s: s["t"])
    return narrow.groupBy("conv_id").agg(F.unhex(F.array_join(ordered, "")).alias("path"))


def rethreaded(held: DataFrame, block: int = 5, most: int = 9) -> DataFrame:
    """(conv_id, path): each conversation behind the first turns of the first one of its block.

    ``h``, the CRC-32 of the decimal id modulo ``most``, says how many: the turns
    before ``h`` are those of conversation ``conv_id - conv_id % block`` (none if
    it is absent), the turns from ``h`` on its own.
    """
    first = held.filter(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("base"), F.substring("path", 1, TURN * (most - 1)).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    joined = held.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % block}).join(first, "base", "left")
    own = F.substring("path", F.col("h") * TURN + 1, F.length("path"))
    head = F.substring(F.coalesce("head", F.lit(b"")), F.lit(1), F.col("h") * TURN)
    return joined.select("conv_id", F.concat(head, own).alias("path"))


def _digest(path: str = "path") -> Column:
    return F.unhex(F.md5(path))


def member_lists(held: DataFrame) -> DataFrame:
    """(digest, ends): SHA-256 of the decimal ids, ascending and comma-joined, of the conversations of each path.

    Ids are range-partitioned by path and id, so that a path which a third of all
    conversations have is read by many tasks. A list inside one task is hashed
    there; the pieces of the others, up to ``PIECE`` bytes each, meet in the order
    of their ids, as a SHA-256 can only be taken from front to back.
    """
    dealt = held.select(_digest().alias("digest"), "conv_id").repartitionByRange("digest", "conv_id")

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, first, ids, size, whole, out = None, 0, [], 0, False, []

        def piece() -> tuple:
            return at, first, ",".join(map(str, ids)).encode(), None

        def made() -> pa.RecordBatch:
            types = [pa.binary(), pa.int64(), pa.binary(), pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], ["digest", "first", "piece", "ends"]
            )

        for batch in batches:
            for digest, conv in zip(batch.column("digest").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if digest != at:
                    if ids:
                        last = piece()
                        out.append((at, first, None, hashlib.sha256(last[2]).hexdigest()) if whole else last)
                    # the first list may have begun in the task before
                    whole, at, first, ids, size = at is not None, digest, conv, [], 0
                elif size > PIECE:
                    out.append(piece())
                    whole, first, ids, size = False, conv, [], 0
                ids.append(conv)
                size += 21
            if out:
                yield made()
                out = []
        if ids:  # the last list may go on in the next task
            out.append(piece())
            yield made()

    found = stage(
        dealt.sortWithinPartitions("digest", "conv_id").mapInArrow(runs, "digest binary, first long, piece binary, ends string"), "members"
    )
    pieces = found.filter("piece is not null").select("digest", "first", "piece")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            done = []
            for digest, piece in zip(batch.column("digest").to_pylist(), batch.column("piece").to_pylist(), strict=True):
                if digest != at:
                    if state is not None:
                        done.append((at, state.hexdigest()))
                    at, state = digest, hashlib.sha256(piece)
                else:
                    state.update(b"," + piece)
            if done:
                yield pa.RecordBatch.from_pylist([{"digest": d, "ends": e} for d, e in done])
        if state is not None:
            yield pa.RecordBatch.from_pylist([{"digest": at, "ends": state.hexdigest()}])

    chained = pieces.repartition("digest").sortWithinPartitions("digest", "first").mapInArrow(joined, "digest binary, ends string")
    return found.filter("piece is null").select("digest", "ends").union(chained)


def _splitters(distinct: DataFrame, shards: int) -> list[bytes]:
    """At most ``shards`` - 1 borders: quantiles, by turns, of paths drawn by a hash and cut after ``DEEP`` turns."""
    drawn = (
        distinct.orderBy(F.xxhash64("path"), "path")
        .limit(2 * shards)
        .select(F.substring("path", 1, TURN * DEEP).alias("path"), (F.length("path") / TURN + 1).alias("weight"))
        .toArrow()
    )
    rows = sorted(zip(drawn.column("path").to_pylist(), drawn.column("weight").to_pylist(), strict=True))
    sums = list(accumulate(w for _, w in rows))
    if not rows:
        return []
    at = [bisect_right(sums, sums[-1] * k / shards) for k in range(1, shards)]
    return sorted({rows[i][0] for i in at if i < len(rows)})


class Skeleton:
    """The trie of the splitters: node 0 is the root; ``down`` gives a child by node and turn."""

    def __init__(self, splitters: list[bytes]):
        self.down: dict[tuple[int, bytes], int] = {}
        self.up, self.turns = [-1], [b""]
        for path in splitters:
            node = 0
            for at in range(0, len(path), TURN):
                turn = path[at : at + TURN]
                child = self.down.get((node, turn))
                if child is None:
                    child = self.down[node, turn] = len(self.up)
                    self.up.append(node)
                    self.turns.append(turn)
                node = child

    def rows(self) -> Iterator[dict]:
        """Each node with its parent, the bytes of its last text and all nodes from itself up to the root."""
        above = [[0]]
        for node, turn in enumerate(self.turns):
            if node:
                above.append([node, *above[self.up[node]]])
            yield {"id": node, "up": self.up[node], "depth": len(above[node]) - 1, "bytes": int.from_bytes(turn[16:], "big"), "above": above[node]}


_NODE = "id int, up int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string"
_ARROW = [pa.int32(), pa.int32(), *[pa.int64()] * 7, pa.string()]
_NAMES = [part.split()[0] for part in _NODE.split(", ")]


class _Open:
    """A node whose conversations are being read."""

    __slots__ = ("children", "ends", "id", "least", "leaves", "n", "saved", "turn", "waiting")

    def __init__(self, skeleton_id: int, turn: bytes):
        self.id, self.turn, self.ends = skeleton_id, turn, None
        self.least, self.n, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.waiting: list[list] = []  # finished children that still lack this node's least member


def _walk(skeleton: Skeleton, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of a range of sorted distinct paths; those of the skeleton hold partial aggregates."""
    stack, out, before = [_Open(0, b"")], [], b""

    def close() -> None:
        node, depth = stack.pop(), len(stack)
        above = stack[-1] if stack else None
        if node.id < 0:
            node.saved += (node.n - 1) * int.from_bytes(node.turn[16:], "big")
            node.leaves += not node.children
            above.children += 1
        row = [None if node.id < 0 else node.id, None, node.least, depth, None, node.n, node.children, node.leaves, node.saved, node.ends]
        for child in node.waiting:
            child[4] = node.least
            out.append(child)
        if node.id >= 0:
            if node.n:
                out.append(row)
        elif above.id >= 0:
            row[1] = above.id
            out.append(row)
        else:
            above.waiting.append(row)
        if above is not None:
            above.n += node.n
            above.leaves += node.leaves
            above.saved += node.saved
            above.least = node.least if above.least is None else min(above.least, node.least)

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _ARROW, strict=True)], _NAMES)

    for batch in batches:
        for path, n, least, ends in zip(*(batch.column(c).to_pylist() for c in ("path", "n", "least", "ends")), strict=True):
            shared, limit = 0, min(len(path), len(before))
            while shared < limit and path[shared : shared + TURN] == before[shared : shared + TURN]:
                shared += TURN
            while len(stack) > shared // TURN + 1:
                close()
            for at in range(shared, len(path), TURN):
                turn, parent = path[at : at + TURN], stack[-1].id
                stack.append(_Open(skeleton.down.get((parent, turn), -1) if parent >= 0 else -1, turn))
            top, before = stack[-1], path
            top.n += n
            top.least = least if top.least is None else min(top.least, least)
            top.ends = ends
        if len(out) > 20_000:
            yield made()
            out = []
    while stack:
        close()
    if out:
        yield made()


def prefix_trie(held: DataFrame, shards: int | None = None) -> DataFrame:
    """Nodes of the trie of ``held`` (conv_id, path): see ``_NODE``; ``conv_id`` is a node's least member.

    A node stands for a sequence of turns that conversations start with; the root
    for none. ``n_leaves`` and ``saved_tokens`` are sums over the node and all below
    it, ``ends`` is the digest of the ids of the conversations that end in it.
    Conversations without turns end in the root; an empty table has no nodes.
    ``shards`` ranges are dealt, by default as many as the turns ask for.

    Equal paths fold before anything is dealt. Paths that agree in more than
    ``DEEP`` turns share a range however many they are.
    """
    held = stage(held, "paths")
    spark = held.sparkSession
    folded = held.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"))
    lists = member_lists(held)
    distinct = stage(folded.withColumn("digest", _digest()).join(lists, "digest").select("path", "n", "least", "ends"), "distinct")
    if shards is None:
        turns = distinct.agg(F.coalesce(F.sum(F.length("path") / TURN), F.lit(0.0))).first()[0]
        shards = min(MOST, max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(turns / SHARD_TURNS) + 1))
    splitters = _splitters(distinct, shards)
    sent = spark.sparkContext.broadcast(splitters)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        borders = sent.value
        for batch in batches:
            shard = [bisect_right(borders, p) for p in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard, pa.int32())], [*batch.schema.names, "shard"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _walk(Skeleton(sent.value), batches)

    dealt = distinct.mapInArrow(deal, "path binary, n long, least long, ends string, shard int")
    ranges = dealt.repartitionById(len(splitters) + 1, "shard").sortWithinPartitions("path")
    found = stage(ranges.mapInArrow(walk, _NODE), "trie")

    skeleton = spark.createDataFrame(
        pa.Table.from_pylist(
            list(Skeleton(splitters).rows()),
            pa.schema([("id", pa.int32()), ("up", pa.int32()), ("depth", pa.int64()), ("bytes", pa.int64()), ("above", pa.list_(pa.int32()))]),
        )
    )
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    reduced = found.filter("id is not null").groupBy("id").agg(F.min("conv_id").alias("conv_id"), F.max("ends").alias("ends"), *sums)
    nodes = stage(reduced.join(skeleton, "id"), "skeleton")  # as few rows as the skeleton has
    below = nodes.filter("up >= 0").groupBy(F.col("up").alias("id")).agg(F.count(F.lit(1)).alias("more"))
    nodes = nodes.join(below, "id", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    own = nodes.select(
        F.explode("above").alias("id"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("own_saved"),
        (F.col("n_children") == 0).cast("long").alias("own_leaf"),
    )
    rolled = own.groupBy("id").agg(F.sum("own_saved").alias("own_saved"), F.sum("own_leaf").alias("own_leaf"))
    of_parent = nodes.select(F.col("id").alias("up"), F.col("conv_id").alias("of_parent"))
    done = nodes.join(rolled, "id").join(of_parent, "up", "left")
    whole = done.select(
        "conv_id", "depth", F.col("of_parent").alias("parent_conv_id"), "n_convs", "n_children",
        (F.col("n_leaves") + F.col("own_leaf")).alias("n_leaves"), (F.col("saved_tokens") + F.col("own_saved")).alias("saved_tokens"), "ends",
    )
    inner = found.filter("id is null").join(F.broadcast(of_parent), "up", "left")
    rest = inner.select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "of_parent").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens", "ends",
    )
    return whole.union(rest).withColumn("ends", F.coalesce("ends", F.lit(NOTHING)))
