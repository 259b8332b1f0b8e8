"""SimHash fingerprints, linked through an inverted index of byte positions.

Two 64-bit fingerprints that differ in at most ``max_bits`` bits share at least
``8 - max_bits`` of their 8 bytes, position by position. The index counts on
that: a posting list stands for a choice of that many positions and their bytes,
so a pair meets in a list exactly if its tally of shared bytes reaches the
guaranteed minimum. (Lists of a single byte would each hold 1/256 of all
fingerprints, and tallying over them would emit a number of pairs that grows
with the square of the corpus.) Within a list only the other ``max_bits`` bytes
are free, so it never holds more than 256 ** max_bits distinct fingerprints.

At 2 bits of 64 few copies with changed words are linked. ``keep_dissimilar``
looks for those: fingerprints of 64 bytes over five words, an index of pairs of
positions (of three of them for very many texts), a tally of shared bytes, links
of at most ``BITS`` differing bits, and then an exact check of these on the texts.
An index of some choices misses a few pairs, so those whose fingerprints meet in no
list are looked up by their rarest shingles (``sharing``), of which similar texts
have one in common for certain.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.windows import number_rows
from .common import identity, join_counted, map_batches, slices, stage, text_bytes
from .components import connected_components

SEED = 42
FEW = 256  # lists up to this length are compared pair by pair

# Near copies by similarity: bytes of a fingerprint, bytes that candidates share,
# rows of a list that are compared at once, and partners in one list beyond which
# pairs are thinned at first. At a Jaccard similarity of 0.8 a byte is shared with a
# probability of 0.27, 17 of 64 on average.
WIDE, SHARED, TOGETHER, PARTNERS = 64, 8, 1024, 8
# Bits in which linked fingerprints of WIDE bytes differ at most. At a similarity of 0.8
# about 78 differ, 160 if a text of five shingles gets a sixth that decides all ties, with
# a deviation of 8 to 11; in unlike texts 256.
BITS = 216
# Choices of positions that are indexed, by their number of positions, and texts from
# which three are taken, so that lists stay some thousand rows long.
CHOICES, MANY = {2: 48, 3: 160}, 1 << 27
# The commonest shingles that are known by their counts, and shingles that a task counts at once.
KNOWN, COUNTED = 1 << 16, 1 << 19
SHORT = 1 << 15  # bytes of a text's shingles, 8 each, up to which they are sent to blocks of rows


def fingerprint(text: bytes, words: int = 3) -> int:
    """SimHash of the word shingles of a text, ASCII letters lower-cased.

    A text of fewer words is one shingle; without words it is 0. A bit is set
    if more than half of the shingles, repeats included, have it.
    """
    found = text.lower().split()
    if not found:
        return 0
    flat = b" ".join(found)
    size = min(words, len(found))
    lengths = np.fromiter(map(len, found), np.int64, len(found)) + 1
    ends = np.cumsum(lengths)
    starts = (ends - lengths)[: len(found) - size + 1].tolist()
    stops = (ends - 1)[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(flat[i:j], SEED) for i, j in zip(starts, stops, strict=True)], dtype=">u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        block = hashes[at : at + (1 << 14)].view(np.uint8)
        counts += np.unpackbits(block).reshape(-1, 64).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, fp, r1, r2): fingerprint and identity of each row as signed longs; null texts count as empty."""

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = np.array([fingerprint(t, words) for t in text_bytes(batch.column("text"))], np.uint64)
        columns = [batch.column("key"), pa.array(made.view(np.int64)), batch.column("r1"), batch.column("r2")]
        return pa.RecordBatch.from_arrays(columns, ["key", "fp", "r1", "r2"])

    kind = docs.schema[key].dataType.simpleString()
    r1, r2 = identity(key, text)
    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), r1.alias("r1"), r2.alias("r2"))
    return map_batches(narrow, of, f"key {kind}, fp long, r1 long, r2 long")


def _masks(max_bits: int) -> list[int]:
    """For each choice of positions that must agree, the mask of their bytes."""
    return [sum(0xFF << (8 * p) for p in kept) for kept in combinations(range(8), 8 - max_bits)]


def _stars(values: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of a posting list that have a partner, each with the least one it reaches there."""
    count = len(values)
    if count <= FEW:
        near = np.bitwise_count(values[:, None] ^ values[None, :]) <= max_bits
    else:
        near = None
        place = {v: i for i, v in enumerate(values.tolist())}
        free = int(np.bitwise_or.reduce(values ^ values[0]))
        bits = [1 << b for b in range(64) if free >> b & 1]
        flips = [sum(c) for n in range(1, max_bits + 1) for c in combinations(bits, n)]
    root = np.full(count, -1)
    for first in np.argsort(values):  # ascending, so a component meets its least member first
        if root[first] >= 0:
            continue
        root[first] = first
        todo = [first]
        while todo:
            at = todo.pop()
            if near is not None:
                found = np.flatnonzero(near[at])
            else:
                value = int(values[at])
                found = [place[value ^ f] for f in flips if value ^ f in place]
            for other in found:
                if root[other] < 0:
                    root[other] = first
                    todo.append(other)
    linked = root != np.arange(count)
    return values[linked], values[root[linked]]


def links(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """(a, b): edges that connect distinct fingerprints ``fp`` as the links at ``max_bits`` bits do.

    A list's members are tied to the least one that they reach inside the list,
    so a list of n fingerprints gives fewer than n edges, not n squared.
    """
    masks = _masks(max_bits)

    def signed(mask: int) -> int:
        return mask - (1 << 64) if mask >> 63 else mask

    postings = prints.select(
        "fp",
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(signed(m)).cast("long")) for m in masks])).alias(
            "choice", "bytes"
        ),
    )
    dealt = postings.repartition("choice", "bytes").sortWithinPartitions("choice", "bytes")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((3, 0), np.int64)

        def edges(rows: np.ndarray, starts: np.ndarray) -> pa.RecordBatch | None:
            stops = np.append(starts[1:], rows.shape[1])
            made = []
            for i, j in zip(starts[stops - starts > 1], stops[stops - starts > 1], strict=True):
                made.append(_stars(np.unique(rows[2, i:j]).view(np.uint64), max_bits))
            if not made:
                return None
            a, b = (np.concatenate([m[k] for m in made]).view(np.int64) for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("choice", "bytes", "fp")])
            rows = np.concatenate([held, rows.astype(np.int64)], axis=1)
            if not rows.shape[1]:
                continue
            new = np.flatnonzero((np.diff(rows[:2], axis=1) != 0).any(axis=0)) + 1
            starts = np.concatenate([[0], new])
            held = rows[:, starts[-1] :]
            if len(starts) > 1 and (out := edges(rows[:, : starts[-1]], starts[:-1])):
                yield out
        if held.shape[1] and (out := edges(held, np.array([0]))):
            yield out

    return dealt.mapInArrow(verify, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, max_bits: int = 2, words: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, fp, r1, r2, component, root): each row's fingerprint and the least key that it reaches through links.

    Rows of equal fingerprints, exact copies among them, are folded before
    anything is paired; ``root``, a fingerprint, names the component. Repeated
    rows get the same component each. A component whose keys are all null is
    null; null keys are otherwise passed over. Texts without words share
    fingerprint 0 and are linked like any other. An empty table gives no rows;
    further columns are not looked at.
    """
    prints = stage(fingerprints(docs, words, text, key), "fingerprints")
    distinct = stage(prints.groupBy("fp").agg(F.min("key").alias("least")), "distinct")
    roots = connected_components(links(distinct.select("fp"), max_bits))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    components = rooted.join(least, "root").select("fp", "component", "root")
    return prints.join(components, "fp").select(F.col("key").alias(key), "fp", "r1", "r2", "component", "root")


def keep_one(docs: DataFrame, max_bits: int = 2, words: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each near-duplicate group of ``docs``, with all its columns.

    The row with the least key stays, a null key only if the group has no other;
    among rows of one key the identity of key and text decides, and of rows that
    agree in both one stays.
    """
    return _leaders(docs, near_duplicates(docs, max_bits, words, text, key), text, key)


def _leaders(docs: DataFrame, found: DataFrame, text: str, key: str) -> DataFrame:
    first = F.min(F.struct(F.col(key).isNull(), F.col(key), "r1", "r2")).alias("first")
    lead = found.groupBy("root").agg(first).select(F.col("first.r1").alias("__r1"), F.col("first.r2").alias("__r2"))
    r1, r2 = identity(key, text)
    # the row travels whole, so that no name of its own can clash with these
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), r1.alias("__r1"), r2.alias("__r2"))
    same = Window.partitionBy("__r1", "__r2").orderBy("__r1")
    kept = rows.join(lead, ["__r1", "__r2"], "left_semi").withColumn("n", F.row_number().over(same)).filter("n = 1")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def _shingles(text: bytes, words: int = 5) -> np.ndarray:
    """The hashes of a text's distinct word shingles, ascending, ASCII letters lower-cased; none without words."""
    found = text.lower().split()
    if not found:
        return np.empty(0, np.uint64)
    flat = b" ".join(found)
    size = min(words, len(found))
    lengths = np.fromiter(map(len, found), np.int64, len(found)) + 1
    ends = np.cumsum(lengths)
    starts = (ends - lengths)[: len(found) - size + 1].tolist()
    stops = (ends - 1)[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(flat[i:j], SEED) for i, j in zip(starts, stops, strict=True)], np.uint64))


def _wide(hashes: np.ndarray) -> bytes:
    """SimHash of ``WIDE`` bytes of distinct shingles; of a tied bit the least hash decides."""
    if not len(hashes):
        return bytes(WIDE)
    counts = np.zeros(8 * WIDE, np.int64)
    salts = (np.arange(1, WIDE // 8 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[None, :]
    for at in range(0, len(hashes), 255):  # a block's counts fit a byte
        mixed = hashes[at : at + 255, None] + salts
        mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        mixed ^= mixed >> np.uint64(31)
        bits = np.unpackbits(mixed.view(np.uint8), axis=1)
        least = bits[0] if not at else least
        counts += bits.sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * counts + least > len(hashes)).tobytes()


def _node(hashes: np.ndarray) -> int:
    """64 bits that stand for a set of shingles."""
    return xxhash.xxh64_intdigest(hashes.tobytes(), SEED)


def _choices(width: int) -> np.ndarray:
    """``CHOICES`` sets of ``width`` byte positions, each position in as many as any other, or a few more."""
    dice, sets = np.random.default_rng(SEED), []
    while len(sets) < CHOICES[width]:
        dealt = dice.permutation(WIDE)[: WIDE // width * width].reshape(-1, width)
        drawn = [tuple(sorted(p)) for p in dealt.tolist()]
        sets += [p for p in drawn if p not in sets]
    return np.array(sets[: CHOICES[width]])


def wide_prints(docs: DataFrame, words: int = 5, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, node, fp, r1, r2): ``node``, 64 bits, stands for the set of a text's shingles, ``fp`` is its wide fingerprint."""

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [_shingles(t, words) for t in text_bytes(batch.column("text"))]
        nodes = np.array([_node(h) for h in found], np.uint64)
        prints = pa.array([_wide(h) for h in found], pa.binary())
        columns = [batch.column("key"), pa.array(nodes.view(np.int64)), prints, batch.column("r1"), batch.column("r2")]
        return pa.RecordBatch.from_arrays(columns, ["key", "node", "fp", "r1", "r2"])

    kind = docs.schema[key].dataType.simpleString()
    r1, r2 = identity(key, text)
    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), r1.alias("r1"), r2.alias("r2"))
    return map_batches(narrow, of, f"key {kind}, node long, fp binary, r1 long, r2 long")


def _forest(count: int, a: np.ndarray, b: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Which of the edges (a, b) are in the minimum spanning forest of nodes 0 to ``count`` - 1."""
    order = np.argsort(far, kind="stable")
    a, b, taken = a[order], b[order], np.zeros(len(far), bool)
    tree = np.arange(count)
    rank = np.arange(len(far))
    while len(rank):
        ta, tb = tree[a[rank]], tree[b[rank]]
        apart = ta != tb
        rank, ta, tb = rank[apart], ta[apart], tb[apart]
        best = np.full(count, len(far))
        np.minimum.at(best, ta, rank)
        np.minimum.at(best, tb, rank)
        joined = np.flatnonzero(best < len(far))
        taken[best[joined]] = True
        parent = np.arange(count)
        parent[joined] = tree[a[best[joined]]] + tree[b[best[joined]]] - joined
        mutual = joined[(parent[parent[joined]] == joined) & (joined < parent[joined])]
        parent[mutual] = mutual
        while (parent != parent[parent]).any():
            parent = parent[parent]
        tree = parent[tree]
    made = np.zeros(len(far), bool)
    made[order] = taken
    return made


def _pairs(lists: np.ndarray, nodes: np.ndarray, prints: np.ndarray, together: int, partners: int) -> tuple[np.ndarray, ...]:
    """(a, b, far) of linked nodes in one list, rows being ordered by list, and the lists that were thinned.

    They share ``SHARED`` bytes and differ in at most ``BITS`` bits.

    Nodes with more partners than ``partners`` keep those that the list's minimum
    spanning forest needs, so a list of n gives O(n) pairs. Parts of more than
    ``together`` rows, whose bytes agree so often, look at the next ``partners`` rows.
    """
    made, at = [], np.arange(len(lists))
    large = np.bincount(lists)[lists] > together
    for step in range(1, len(lists)):
        if step == partners + 1:
            at = at[~large[at]]
        at = at[at < len(lists) - step]
        at = at[lists[at] == lists[at + step]]
        if not len(at):
            break
        differ = prints[at] ^ prints[at + step]
        tally = (differ.view(np.uint8) == 0).sum(axis=1)
        near = np.flatnonzero(tally >= SHARED)
        far = np.bitwise_count(differ[near]).sum(axis=1, dtype=np.int64)
        near, far = near[far <= BITS], far[far <= BITS]
        made.append((at[near], at[near] + step, far))
    if not made:
        return (np.empty(0, np.int64),) * 4
    a, b, far = (np.concatenate([m[k] for m in made]) for k in range(3))
    found = np.bincount(np.concatenate([a, b]), minlength=len(lists))
    kept = (found[a] <= partners) & (found[b] <= partners)
    if not kept.all():
        kept |= _forest(len(lists), a, b, far)
    thinned = np.unique(lists[a[~kept]])
    a, b = nodes[a[kept]], nodes[b[kept]]
    return np.minimum(a, b), np.maximum(a, b), far[kept], thinned


def _dealt(prints: DataFrame, width: int, others: tuple[str, ...]) -> DataFrame:
    """(list, *others) of ``prints``: a row for each choice of positions; the list stands for them and their bytes."""
    chosen = _choices(width)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, TOGETHER) for b in batches for at in range(0, b.num_rows, TOGETHER)):
            prints = np.frombuffer(b"".join(batch.column("fp").to_pylist()), np.uint8).reshape(-1, WIDE)
            lists = np.arange(len(chosen), dtype=np.int64)[None, :]
            for k in range(width):
                lists = lists * 256 + prints[:, chosen[:, k]]
            of = pa.array(np.repeat(np.arange(len(prints)), len(chosen)))
            yield pa.RecordBatch.from_arrays([pa.array(lists.ravel()), *[batch.column(c).take(of) for c in others]], ["list", *others])

    schema = ", ".join(["list long", *[f"{c} {prints.schema[c].dataType.simpleString()}" for c in others]])
    return prints.select("fp", *[c for c in others if c != "fp"]).mapInArrow(deal, schema)


def candidates(prints: DataFrame, width: int = 2, together: int = TOGETHER, partners: int = PARTNERS) -> DataFrame:
    """(a, b, far): nodes whose wide fingerprints share enough bytes and differ in few bits, and how many these are.

    ``prints`` holds distinct nodes. A posting list stands for ``width`` positions
    and their bytes. Lists of more than ``together`` rows are dealt in parts by a
    hash of further bytes. Rows without ``b`` name the lists, as ``a``, from which
    pairs were left out, in this way or by the thinning of ``_pairs``:
    ``between_groups`` goes through all of those.
    """
    sizes = _dealt(prints, width, ("node",)).groupBy("list").count()
    long = stage(sizes.filter(F.col("count") > together), "long-lists")
    postings = _dealt(prints, width, ("node", "fp"))
    some = long.limit(1).count()
    if some:
        parts = F.ceil(F.col("count") / together).cast("int")
        further = F.xxhash64(F.expr(f"substring(fp, 1 + cast(list % {WIDE - 3} as int), 3)"))
        postings = postings.join(long, "list", "left").withColumn("part", F.coalesce(F.pmod(further, parts), F.lit(0)).cast("int"))
    else:
        postings = postings.withColumn("part", F.lit(0))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def outs(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            """Whole lists, some ``together`` rows of them at once."""
            lists, parts = rows.column("list").to_numpy(), rows.column("part").to_numpy()
            starts = np.flatnonzero(np.append(True, (lists[1:] != lists[:-1]) | (parts[1:] != parts[:-1])))
            first = 0
            for stop in [*starts[1:].tolist(), len(lists)]:
                if stop - first >= together or stop == len(lists):
                    yield out(rows.slice(first, stop - first))
                    first = stop

        def out(rows: pa.RecordBatch) -> pa.RecordBatch:
            lists, parts = rows.column("list").to_numpy(), rows.column("part").to_numpy()
            new = np.append(True, (lists[1:] != lists[:-1]) | (parts[1:] != parts[:-1]))
            prints = np.frombuffer(b"".join(rows.column("fp").to_pylist()), np.uint64).reshape(-1, WIDE // 8)
            *made, thinned = _pairs(np.cumsum(new), rows.column("node").to_numpy(), prints, together, partners)
            thinned = lists[new][thinned - 1]
            nothing = pa.nulls(len(thinned), pa.int64())
            columns = [pa.concat_arrays([pa.array(m), t]) for m, t in zip(made, (pa.array(thinned), nothing, nothing), strict=True)]
            return pa.RecordBatch.from_arrays(columns, ["a", "b", "far"])

        for batch in batches:
            if not batch.num_rows:
                continue
            lists, parts = batch.column("list").to_numpy(), batch.column("part").to_numpy()
            upto = int(np.flatnonzero((lists != lists[-1]) | (parts != parts[-1]))[-1]) + 1 if (lists[0], parts[0]) != (lists[-1], parts[-1]) else 0
            if held and not upto and (held[-1].column("list")[0].as_py(), held[-1].column("part")[0].as_py()) != (lists[0], parts[0]):
                yield from outs(pa.concat_batches(held))
                held = []
            if upto:
                yield from outs(pa.concat_batches([*held, batch.slice(0, upto)]))
                held = []
            held.append(batch.slice(upto))
        if held:
            yield from outs(pa.concat_batches(held))

    dealt = postings.select("list", "part", "node", "fp").repartition("list", "part").sortWithinPartitions("list", "part")
    found = dealt.mapInArrow(meet, "a long, b long, far long")
    cut = long.select(F.col("list").alias("a"), F.lit(None).cast("long").alias("b"), F.lit(None).cast("long").alias("far"))
    return found.union(cut).distinct()


def between_groups(
    prints: DataFrame,
    lists: DataFrame,
    width: int = 2,
    together: int = TOGETHER,
    least: float = 0.0,
    shingles_of: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(a, b, sure): all nodes of different ``root`` that share a list of ``lists`` and enough bytes, and differ in few bits.

    ``shingles_of`` gives (node, shingles) for a table of nodes. Pairs of texts of ``SHORT``
    bytes of shingles or less are verified where they meet, by a Jaccard similarity of
    ``least``, and are ``sure``: so a group of many unlike pairs emits none of them. The
    others are emitted unverified, as their shingles would not fit a block.

    ``prints`` is (node, fp, root). The rows of a list are numbered by root and cut
    into blocks of ``together``; each pair of blocks that holds two roots meets in
    one place. So a list may be of any length, and the blocks of one large group
    meet only the others.
    """
    dense = stage(_dealt(prints, width, ("node", "root")).join(lists, "list", "left_semi"), "dense")
    mixed = dense.groupBy("list").agg((F.min("root") != F.max("root")).alias("mixed")).filter("mixed")
    rows = stage(dense.join(mixed, "list", "left_semi"), "mixed")
    rows = stage(number_rows(rows, ["root asc", "node asc"], "n", ["list"]), "numbered")
    spans = rows.groupBy("list", "root").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    sizes = rows.groupBy("list").agg(F.max("n").alias("size"))
    placed = rows.join(spans, ["list", "root"]).join(sizes, "list").join(prints.select("node", "fp"), "node")
    if shingles_of:
        short = shingles_of(rows.select("node").distinct()).filter(F.octet_length("shingles") <= SHORT)
        placed = placed.join(short, "node", "left")
    else:
        placed = placed.withColumn("shingles", F.lit(None).cast("binary"))

    def block(n) -> Column:
        return F.floor((n - 1) / together).cast("int")

    own, last = block(F.col("n")), block(F.col("size"))
    alone = (own * together + 1 >= F.col("least")) & (F.least((own + 1) * together, F.col("size")) <= F.col("most"))
    after = F.when(alone, block(F.col("most") + 1)).otherwise(own)
    before = F.when(alone, block(F.col("least") - 1)).otherwise(own - 1)
    none = F.array().cast("array<int>")
    right = F.when((F.col("most") == F.col("size")) & alone, none).otherwise(F.sequence(after, last))
    left = F.when(before < 0, none).otherwise(F.sequence(F.lit(0), F.greatest(before, F.lit(0))))
    places = F.concat(
        F.transform(right, lambda b: F.struct(own.alias("i"), b.alias("j"), F.lit(0).alias("side"))),
        F.transform(left, lambda b: F.struct(b.alias("i"), own.alias("j"), F.lit(1).alias("side"))),
    )
    dealt = placed.select("list", "node", "root", "fp", "shingles", F.explode(places).alias("p"))
    dealt = dealt.select("list", "p.*", "node", "root", "fp", "shingles")
    dealt = dealt.repartition("list", "i", "j").sortWithinPartitions("list", "i", "j", "side")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def out() -> pa.RecordBatch:
            rows = pa.concat_batches(held)
            nodes, roots, side = (rows.column(c).to_numpy() for c in ("node", "root", "side"))
            prints = np.frombuffer(b"".join(rows.column("fp").to_pylist()), np.uint8).reshape(-1, WIDE)
            sets = [s if s is None else np.frombuffer(s, np.uint64) for s in rows.column("shingles").to_pylist()]
            alone = at[1] == at[2]
            rights = np.arange(len(nodes)) if alone else np.flatnonzero(side == 1)
            made = []
            for i in range(len(nodes) if alone else int((side == 0).sum())):
                others = rights[(rights > i) & (roots[rights] != roots[i])]
                shared = (prints[others] == prints[i]).sum(axis=1)
                others = others[shared >= SHARED]
                far = np.bitwise_count(prints[others] ^ prints[i]).sum(axis=1, dtype=np.int64)
                for other in others[far <= BITS]:
                    sure = sets[i] is not None and sets[other] is not None
                    if not sure or _alike(sets[i], sets[other], least):
                        made.append((min(nodes[i], nodes[other]), max(nodes[i], nodes[other]), sure))
            columns = zip(*made, strict=True) if made else ([], [], [])
            kinds = pa.int64(), pa.int64(), pa.bool_()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["a", "b", "sure"])

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("list", "i", "j")])
            new = np.flatnonzero((np.diff(keys, axis=1) != 0).any(axis=0)) + 1
            edges = [0, *new.tolist(), batch.num_rows] if batch.num_rows else []
            for start, stop in zip(edges, edges[1:], strict=False):
                own_key = tuple(keys[:, start].tolist())
                if own_key != at:
                    if held:
                        yield out()
                    at, held = own_key, []
                held.append(batch.slice(start, stop - start))
        if held:
            yield out()

    return dealt.mapInArrow(meet, "a long, b long, sure boolean").distinct()


def _shingled(texts: DataFrame, words: int) -> DataFrame:
    """(node, shingles): the hashes of the distinct shingles of (node, text), ascending, 8 bytes each."""

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [_shingles(t, words).tobytes() for t in text_bytes(batch.column("text"))]
        return pa.RecordBatch.from_arrays([batch.column("node"), pa.array(found, pa.binary())], ["node", "shingles"])

    return map_batches(texts.select("node", "text"), of, "node long, shingles binary")


def _shared(one: np.ndarray, two: np.ndarray) -> int:
    """How many hashes two ascending arrays have in common."""
    if len(one) > len(two):
        one, two = two, one
    if not len(one):
        return 0
    at = np.searchsorted(two, one)
    return int((two[np.minimum(at, len(two) - 1)] == one).sum())


def _alike(one: np.ndarray, two: np.ndarray, least: float) -> bool:
    """Whether two sets, ascending hashes, have a Jaccard similarity of ``least``."""
    # as many shared as the smaller set has would have to do
    if min(len(one), len(two)) < least * max(len(one), len(two)):
        return False
    shared = _shared(one, two)
    return shared >= least * (len(one) + len(two) - shared)


def _similar(pairs: DataFrame, shingled: DataFrame, least: float) -> DataFrame:
    """The (a, b) of ``pairs`` whose texts have a Jaccard similarity of ``least`` in distinct shingles, (node, shingles)."""

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept = []
        for row, (left, right) in enumerate(zip(batch.column("one").to_pylist(), batch.column("other").to_pylist(), strict=True)):
            if _alike(np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64), least):
                kept.append(row)
        return batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    left = shingled.select(F.col("node").alias("a"), F.col("shingles").alias("one"))
    right = shingled.select(F.col("node").alias("b"), F.col("shingles").alias("other"))
    return map_batches(pairs.select("a", "b").join(right, "b").join(left, "a"), of, "a long, b long", "other")


def _commonest(hashes: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts by hash, ascending; beyond ``most`` hashes each loses the count of the first that is left out."""
    hashes, of = np.unique(hashes, return_inverse=True)
    counts = np.bincount(of, counts, len(hashes)).astype(np.int64)
    if len(hashes) > most:
        counts -= np.partition(counts, -most - 1)[-most - 1]
        hashes, counts = hashes[counts > 0], counts[counts > 0]
    return hashes, counts


def _repeated(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes that are held more than once, ascending, and how often."""
    hashes = np.concatenate([np.empty(0, np.uint64), *held])
    hashes.sort()
    starts = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)])
    counts = np.diff(starts, append=len(hashes))
    return hashes[starts[counts > 1]], counts[counts > 1]


def common_shingles(docs: DataFrame, words: int = 5, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts), ascending by hash: at most ``KNOWN`` shingles of all texts, the commonest that were found.

    Counters in the way of Misra and Gries over whole texts, kept by each task;
    of ``COUNTED`` shingles those enter that are there more than once. The counts
    say in which order shingles are looked at, which no result depends on.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401  makes pa.compute there in a worker

        kept, held, size = (np.empty(0, np.uint64), np.empty(0, np.int64)), [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            return _commonest(*[np.concatenate(two) for two in zip(kept, _repeated(held), strict=True)], KNOWN)

        for batch in batches:
            for piece in slices(batch, "text"):
                for one in text_bytes(piece.column("text")):
                    held.append(_shingles(one, words))
                    size += len(held[-1])
                    if size >= COUNTED:
                        kept = merged()
                        held, size = [], 0
        hashes, counts = merged()
        yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts)], ["hash", "n"])

    found = docs.select(F.col(text).alias("text")).mapInArrow(count, "hash long, n long")
    rows = found.groupBy("hash").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "hash").limit(KNOWN).collect()
    hashes = np.array([r.hash for r in rows], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], np.array([r.n for r in rows], np.int64)[order]


def _rarest(hashes: np.ndarray, known: np.ndarray, counts: np.ndarray, least: float) -> np.ndarray:
    """The first shingles of a set, unknown ones before common ones, one of which any set of a Jaccard similarity of ``least`` has among its own first ones."""
    if not len(hashes):
        return hashes
    seen = np.zeros(len(hashes), np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        seen = np.where(known[at] == hashes, counts[at], 0)
    # a similar set shares all but these, less one
    return hashes[np.argsort(seen, kind="stable")[: len(hashes) - int(np.ceil(least * len(hashes) - 1e-6)) + 1]]


def rarest(docs: DataFrame, least: float = 0.8, words: int = 5, text: str = "text") -> DataFrame:
    """(list, node, size, rest): the first shingles of each text's set, its size, and how many of it are left from that shingle on."""
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, words, text))

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [_shingles(t, words) for t in text_bytes(batch.column("text"))]
        first = [_rarest(s, *common.value, least) for s in sets]
        counts = np.array([len(f) for f in first], np.int64)
        sizes = np.repeat([len(s) for s in sets], counts).astype(np.int64)
        nodes = np.repeat(np.array([_node(s) for s in sets], np.uint64), counts).view(np.int64)
        at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        lists = np.concatenate(first).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (lists, nodes, sizes, sizes - at)], ["list", "node", "size", "rest"])

    return map_batches(docs.select(F.col(text).alias("text")), of, "list long, node long, size long, rest long")


def sharing(postings: DataFrame, roots: DataFrame, least: float = 0.8, together: int = TOGETHER) -> DataFrame:
    """(a, b): nodes of different ``root`` in ``roots`` (node, root) that may have a Jaccard similarity of ``least``.

    ``postings`` is that of ``rarest``, stored. Similar sets meet at their first common
    shingle, and from there on each has as many left as they must share; pairs
    that do so nowhere are not emitted. So none that is similar is missed.

    Lists of more than ``together`` rows are dealt in blocks, each pair of which
    meets in one place; the blocks of one large group meet only the others.
    """
    shared = postings.groupBy("list").agg((F.min("node") != F.max("node")).alias("several")).filter("several").select("list")
    rows = postings.join(stage(shared, "shared"), "list", "left_semi")
    rows = rows.groupBy("list", "node").agg(F.first("size").alias("size"), F.first("rest").alias("rest"))
    rows = stage(rows.join(roots.select("node", "root"), "node"), "shared-rows")
    of_root = rows.groupBy("list", "root").agg(F.count(F.lit(1)).alias("of_root"))
    of_list = of_root.groupBy("list").agg(
        F.count(F.lit(1)).alias("roots"), F.sum(F.when(F.col("of_root") <= together, F.col("of_root")).otherwise(0)).alias("loose")
    )
    large = F.col("of_root") > together
    parts = F.greatest(F.ceil(F.when(large, F.col("of_root")).otherwise(F.col("loose")) / together), F.lit(1))
    block = F.struct(F.when(large, F.col("root")).alias("owner"), F.pmod(F.xxhash64("node"), parts).alias("part"))
    placed = rows.join(of_root, ["list", "root"]).join(of_list.filter("roots > 1"), "list")
    placed = stage(placed.select("list", "node", "root", "size", "rest", block.alias("block")), "shared-blocks")
    blocks = placed.groupBy("list").agg(F.collect_set("block").alias("blocks"))
    alone = F.col("block.owner")
    meets = F.filter("blocks", lambda b: alone.isNull() | b["owner"].isNull() | (b["owner"] != alone))
    dealt = placed.join(blocks, "list").select("list", "node", "root", "size", "rest", "block", F.explode(meets).alias("other"))

    def side(name: str, i: str, j: str) -> DataFrame:
        named = {"node": name, "root": f"root_{name}", "size": f"size_{name}", "rest": f"rest_{name}"}
        return dealt.select("list", F.col(i).alias("i"), F.col(j).alias("j"), *[F.col(c).alias(to) for c, to in named.items()])

    met = side("a", "block", "other").join(side("b", "other", "block"), ["list", "i", "j"])
    must = least / (1 + least) * (F.col("size_a") + F.col("size_b")) - 1e-6
    apart = (F.col("a") < F.col("b")) & (F.col("root_a") != F.col("root_b"))
    return met.filter(apart & (F.least("rest_a", "rest_b") >= must)).select("a", "b").distinct()


def _near(pairs: DataFrame, prints: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` whose fingerprints, (node, fp), differ in at most ``BITS`` bits."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, other = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(-1, WIDE // 8) for c in ("one", "other"))
            far = np.bitwise_count(one ^ other).sum(axis=1, dtype=np.int64)
            yield batch.select(["a", "b"]).filter(pa.array(far <= BITS))

    left = prints.select(F.col("node").alias("a"), F.col("fp").alias("one"))
    right = prints.select(F.col("node").alias("b"), F.col("fp").alias("other"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "one", "other").mapInArrow(of, "a long, b long")


def similar_groups(
    docs: DataFrame,
    least: float = 0.8,
    words: int = 5,
    text: str = "text",
    key: str = "doc_id",
    together: int = TOGETHER,
    partners: int = PARTNERS,
) -> DataFrame:
    """(key, r1, r2, root): rows whose shingle sets are linked by a Jaccard similarity of ``least`` share ``root``.

    Texts of equal sets are folded first, those without words among them. Links of
    fingerprints, at most ``BITS`` bits apart, are verified on the texts. Candidates
    are verified in four steps, each of which leaves out pairs that lie in one group
    already: the nearest one of each node, the others, all pairs between groups in the
    lists of dense groups, which the first two steps have thinned, and the pairs whose
    fingerprints share no choice of positions, or fewer than ``SHARED`` bytes, found
    by a shingle that they must have in common.
    """
    prints = stage(wide_prints(docs, words, text, key), "wide")
    one = prints.groupBy("node").agg(F.first("fp").alias("fp"), F.count(F.lit(1)).alias("n"), F.min(F.struct("r1", "r2")).alias("one"))
    distinct = stage(one, "distinct")
    width = 2 if distinct.count() < MANY else 3
    found = stage(candidates(distinct, width, together, partners), "candidates")
    pairs = found.filter("b is not null")
    lists = found.filter("b is null").select(F.col("a").alias("list")).distinct()
    r1, r2 = identity(key, text)
    bodies = docs.select(r1.alias("r1"), r2.alias("r2"), F.col(text).alias("text"))

    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()

    def shingles_of(nodes: DataFrame) -> DataFrame:
        lead = distinct.join(nodes, "node", "left_semi").select("node", "one.r1", "one.r2")
        own = bodies.join(lead, ["r1", "r2"]).select("node", "text")
        return stage(_shingled(own, words).dropDuplicates(["node"]), "shingles")

    def apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
        to_a = roots.select(F.col("node").alias("a"), F.col("root").alias("of_a"))
        to_b = roots.select(F.col("node").alias("b"), F.col("root").alias("of_b"))
        different = F.coalesce("of_a", "a") != F.coalesce("of_b", "b")
        return pairs.join(to_a, "a", "left").join(to_b, "b", "left").filter(different).select("a", "b")

    def united(roots: DataFrame, links: DataFrame) -> DataFrame:
        """The roots after further links; for the links before, each node is tied to its root."""
        return connected_components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links))

    shingled = shingles_of(ends(pairs))
    sides = pairs.select(F.col("a").alias("node"), "a", "b", "far").union(pairs.select(F.col("b").alias("node"), "a", "b", "far"))
    nearest = sides.groupBy("node").agg(F.min(F.struct("far", "a", "b")).alias("one")).select("one.a", "one.b").distinct()
    roots = connected_components(_similar(nearest, shingled, least))
    rest = stage(apart(pairs, roots).join(nearest, ["a", "b"], "left_anti"), "rest")
    roots = united(roots, _similar(rest, shingled, least))
    if lists.limit(1).count():
        rooted = distinct.select("node", "fp").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        met = between_groups(stage(rooted, "rooted"), lists, width, together, least, shingles_of)
        more = stage(met, "between")
        links = more.filter("sure").select("a", "b")
        unsure = more.filter("not sure").join(pairs.select("a", "b"), ["a", "b"], "left_anti")
        if more.filter("not sure").limit(1).count():
            links = links.union(_similar(unsure, shingles_of(ends(unsure)), least))
        if more.limit(1).count():
            roots = united(roots, links)
    rooted = distinct.select("node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    postings = stage(rarest(docs, least, words, text), "rarest")
    unmet = stage(_near(sharing(postings, stage(rooted, "rooted"), least, together), distinct), "unmet")
    if unmet.limit(1).count():
        links = stage(_similar(unmet, shingles_of(ends(unmet)), least), "unmet-links")
        if links.limit(1).count():
            roots = united(roots, links)
    rooted = distinct.select("node", "n").join(roots, "node", "left").select("node", "n", F.coalesce("root", "node").alias("root"))
    linked = join_counted(prints, stage(rooted, "roots"), ["node"], "n")
    return linked.select(F.col("key").alias(key), "r1", "r2", "root")


def keep_dissimilar(docs: DataFrame, least: float = 0.8, words: int = 5, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each group of ``similar_groups``, with all its columns, chosen as in ``keep_one``."""
    return _leaders(docs, similar_groups(docs, least, words, text, key), text, key)
