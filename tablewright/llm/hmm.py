"""A hidden Markov language model, trained by Baum-Welch over all partitions.

Words are counted over the whole training text. The ``WORDS`` most frequent ones
(of those that occur ``LEAST`` times) are emission symbols of their own; the
others share ``CLASSES`` symbols by their last two bytes and are told apart inside
a class by their counts, so that every word and every count plays a part while
the model keeps its size. States start from the whole text's shares of the
symbols, bent at random; then each round gathers the expected counts of states,
transitions and symbols from the whole training text. Texts are scored by the
scaled forward recursion, over the whole sequence.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  slices need it
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, stage, text_bytes

STATES = 16
WORDS, LEAST, LONGEST = 32_000, 8, 64  # most frequent words, of so many occurrences and up to so many bytes
CLASSES = 64
SYMBOLS = WORDS + CLASSES  # fits 16 bits
END = b"\n"  # no word holds a line break
DICTIONARY_BYTES = 16 << 20  # text that shares a dictionary
ROUNDS = 5  # over the whole training text
STAY = 0.98  # share of a state's moves to itself at first
PIECE = 128  # tokens that training looks at as one sequence
PIECES, AT_ONCE = 1024, 4096  # pieces, or texts, in one array
NOVEL = 0.5  # added to each count inside a class, and for words that are new there
PRIOR = 50.0  # tokens that each state sees of the whole text's symbols beforehand


def _planes(codes: np.ndarray) -> bytes:
    """Codes with their first bytes together, then their second ones, and so on, compressed."""
    return pa.Codec("zstd").compress(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), asbytes=True)


def _codes(planes: bytes, count: int) -> np.ndarray:
    flat = pa.Codec("zstd").decompress(planes, 4 * count, asbytes=True)
    return np.frombuffer(flat, np.uint8).reshape(4, count).T.copy().view("<u4").ravel()


def _encoded(docs: DataFrame, held: Column, text: str, key: str) -> DataFrame:
    """Words and texts by slice, stored: rows of ``word`` hold a slice's dictionary and training counts, the others a text's codes."""
    names = ["slice", "word", "pos", "n", "key", "held", "size", "codes"]
    kind = docs.schema[key].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0

        def out(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
            nonlocal number
            at = (task << 32) + number
            number += 1
            keys, held = (pa.concat_arrays([p[c] for p in parts]) for c in (0, 1))
            lengths = np.concatenate([p[2] for p in parts])
            coded = pa.chunked_array([p[3] for p in parts]).unify_dictionaries()
            codes = np.concatenate([c.indices.to_numpy() for c in coded.chunks])
            words = coded.chunk(0).dictionary
            order = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            codes, size = rank[codes], len(order)
            learned = np.repeat(~held.to_numpy(zero_copy_only=False), lengths)
            counts = np.bincount(codes[learned], minlength=size)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(size, at)), words.take(pa.array(order)), pa.array(np.arange(size, dtype=np.int32)), pa.array(counts),
                    pa.nulls(size, keys.type), pa.nulls(size, pa.bool_()), pa.nulls(size, pa.int32()), pa.nulls(size, pa.binary()),
                ], names,
            )
            ends = np.cumsum(lengths)
            n = len(lengths)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, at)), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), keys, held,
                    pa.array(lengths, pa.int32()),
                    pa.array([_planes(codes[i:j]) for i, j in zip(ends - lengths, ends, strict=True)], pa.binary()),
                ], names,
            )

        parts, size = [], 0
        for batch in batches:
            for piece in slices(batch, "text"):
                bodies = text_bytes(piece.column("text"))
                found = [[*body.lower().split(), END] for body in bodies]
                coded = pa.array([w for f in found for w in f], pa.binary()).dictionary_encode()
                parts.append((piece.column("key"), piece.column("held"), np.array([len(f) for f in found]), coded))
                size += sum(map(len, bodies))
                if size > DICTIONARY_BYTES:
                    yield from out(parts)
                    parts, size = [], 0
        if parts:
            yield from out(parts)

    narrow = docs.select(F.col(key).alias("key"), F.coalesce(held, F.lit(False)).alias("held"), F.col(text).alias("text"))
    schema = f"slice long, word binary, pos int, n long, key {kind}, held boolean, size int, codes binary"
    return stage(narrow.mapInArrow(cut, schema), "tokens")


def _class(word: str = "word") -> Column:
    return (F.lit(WORDS) + F.pmod(F.xxhash64(F.substring(word, -2, 2)), F.lit(CLASSES))).cast("int")


@dataclass
class Text:
    """A corpus in symbols: ``coded`` has a row for each text, ``tokens`` and ``types`` are the training text's N and V."""

    coded: DataFrame
    shares: np.ndarray  # of each symbol in the training text
    tokens: int
    types: int


def read(docs: DataFrame, held: Column, text: str = "text", key: str = "doc_id") -> Text:
    """``docs`` as symbols, with the training counts of all words of the rows that are not ``held``.

    ``coded`` is (key, held, n_tokens, n_known, base, inside, symbols): ``base`` is
    the text's log10 probability under add-one counts, ``inside`` that of its words
    within their classes. A word comes once from each slice of texts, so the words
    are dealt once, counted where they meet, and their counts go back to the slices.
    """
    kind = docs.schema[key].dataType.simpleString()
    both = _encoded(docs, held, text, key)
    words = both.filter("word is not null").select("slice", "word", "pos", "n")
    same = Window.partitionBy("word")
    counted = words.withColumns({"whole": F.sum("n").over(same), "leads": F.col("slice") == F.min("slice").over(same)})
    often = (F.col("whole") >= LEAST) & (F.octet_length("word") <= LONGEST)
    counted = counted.select("slice", "pos", F.col("whole").alias("n"), "leads", _class().alias("symbol"), F.when(often, F.col("word")).alias("word"))
    counted = stage(counted, "counts")
    once = counted.filter("leads and n > 0")
    tokens, types = once.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    top = once.filter("word is not null").orderBy(F.desc("n"), "word").select("word", "n").limit(WORDS).toArrow()  # bounded in rows and bytes
    own_symbol = F.broadcast(
        docs.sparkSession.createDataFrame(pa.table({"word": top.column("word"), "own": pa.array(np.arange(len(top), dtype=np.int32))}))
    )
    answers = counted.join(own_symbol, "word", "left").select("slice", "pos", "n", "leads", F.coalesce("own", "symbol").alias("symbol"))
    rare = answers.filter(f"leads and n > 0 and symbol >= {WORDS}")
    classes = rare.groupBy("symbol").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("types")).toArrow()
    mass, own = np.zeros(SYMBOLS), np.full(CLASSES, NOVEL)
    mass[: len(top)] = top.column("n").to_numpy()
    at = classes.column("symbol").to_numpy()
    mass[at] = classes.column("n").to_numpy()
    own[at - WORDS] = mass[at] + NOVEL * (classes.column("types").to_numpy() + 1)

    nothing = F.lit(None)
    parts = answers.select(
        "slice", F.lit(0).alias("row"), "pos", "n", "symbol", nothing.cast(kind).alias("key"),
        nothing.cast("boolean").alias("held"), nothing.cast("int").alias("size"), nothing.cast("binary").alias("codes"),
    ).union(
        both.filter("word is null").select(
            "slice", F.lit(1), nothing.cast("int"), nothing.cast("long"), nothing.cast("int"), "key", "held", "size", "codes"
        )
    )
    # a slice's dictionary comes before its texts
    dealt = parts.repartition("slice").sortWithinPartitions("slice", "row")

    def recode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, gathered, tables = None, [], None

        def table() -> tuple[np.ndarray, ...]:
            pos, n, symbol = (np.concatenate(c) for c in zip(*gathered, strict=True))
            n, symbol = n[np.argsort(pos)], symbol[np.argsort(pos)]
            inside = np.zeros(len(n))
            shared = symbol >= WORDS
            inside[shared] = np.log10((n[shared] + NOVEL) / own[symbol[shared] - WORDS])
            return np.log10((n + 1) / (tokens + types + 1)), inside, n > 0, symbol.astype(np.uint16)

        for batch in batches:
            slices, rows = batch.column("slice").to_numpy(), batch.column("row").to_numpy()
            new = np.flatnonzero((np.diff(slices) != 0) | (np.diff(rows) != 0)) + 1
            edges = [0, *new.tolist(), len(rows)] if len(rows) else []
            for i, j in zip(edges, edges[1:], strict=False):
                if slices[i] != at:
                    at, gathered, tables = slices[i], [], None
                own_rows = batch.slice(i, j - i)
                if rows[i] == 0:
                    gathered.append([own_rows.column(c).to_numpy() for c in ("pos", "n", "symbol")])
                    continue
                tables = table() if tables is None else tables
                base, inside, known, symbol = tables
                lengths = own_rows.column("size").to_numpy().astype(np.int64)
                codes = np.concatenate([_codes(p, n) for p, n in zip(own_rows.column("codes").to_pylist(), lengths.tolist(), strict=True)])
                ends = np.cumsum(lengths)
                starts = ends - lengths
                coded = symbol[codes]
                made = [
                    own_rows.column("key"), own_rows.column("held"), pa.array(lengths),
                    pa.array(np.add.reduceat(known[codes].astype(np.int64), starts)),
                    pa.array(np.add.reduceat(base[codes], starts)),
                    pa.array(np.add.reduceat(inside[codes], starts)),
                    pa.array([coded[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(made, ["key", "held", "n_tokens", "n_known", "base", "inside", "symbols"])

    schema = f"key {kind}, held boolean, n_tokens long, n_known long, base double, inside double, symbols binary"
    coded = stage(dealt.mapInArrow(recode, schema), "symbols")
    return Text(coded, (mass + NOVEL) / (mass + NOVEL).sum(), int(tokens), int(types))


@dataclass
class Model:
    """``start`` and ``middle``: states at the start of a text and anywhere; ``moves`` from row to column; ``emits`` by symbol."""

    start: np.ndarray
    middle: np.ndarray
    moves: np.ndarray
    emits: np.ndarray

    @classmethod
    def drawn(cls, shares: np.ndarray, states: int = STATES) -> Model:
        """States that mostly stay as they are and emit randomly bent shares of the symbols."""
        bent = shares[:, None] * np.random.default_rng(2).gamma(1.0, size=(len(shares), states))
        even = np.full(states, 1 / states)
        return cls(even, even, STAY * np.eye(states) + (1 - STAY) / states, bent / bent.sum(axis=0))

    @classmethod
    def of_counts(cls, shares: np.ndarray, start: np.ndarray, moves: np.ndarray, emits: np.ndarray) -> Model:
        middle = emits.sum(axis=0)
        seen = emits + PRIOR * shares[:, None]
        return cls(
            (start + 1) / (start + 1).sum(),
            (middle + 1) / (middle + 1).sum(),
            (moves + 1) / (moves + 1).sum(axis=1, keepdims=True),
            seen / seen.sum(axis=0),
        )

    def packed(self) -> tuple[np.ndarray, ...]:
        return tuple(a.astype(np.float32) for a in (self.start, self.middle, self.moves, self.emits))


class Counts:
    """Expected counts of the E step: states of first tokens, transitions, and states by symbol."""

    def __init__(self, states: int, symbols: int = SYMBOLS):
        self.start, self.moves, self.emits = np.zeros(states), np.zeros((states, states)), np.zeros((symbols, states))

    def add(self, packed: tuple[np.ndarray, ...], pieces: list[np.ndarray], first: np.ndarray) -> None:
        """Forward and backward over ``pieces``; ``first`` says which of them start a text."""
        start, middle, moves, emits = packed
        lengths = np.array([len(p) for p in pieces])
        by = np.argsort(-lengths, kind="stable")
        lengths, first = lengths[by], first[by]
        n, steps = len(by), int(lengths[0])
        symbols = np.zeros((steps, n), np.uint16)
        for column, i in enumerate(by):
            symbols[: lengths[column], column] = pieces[i]
        active = np.searchsorted(-lengths, -np.arange(steps), side="left")  # pieces longer than t
        alpha, scale = np.empty((steps, n, len(start)), np.float32), np.empty((steps, n, 1), np.float32)
        seen, moved, ones = np.empty_like(alpha), np.zeros_like(self.moves), np.ones((len(start), 1), np.float32)
        for t in range(steps):
            k = active[t]
            np.take(emits, symbols[t, :k], axis=0, out=seen[t, :k], mode="clip")  # the mode that needs no copy
            now = np.where(first[:, None], start, middle) if t == 0 else alpha[t - 1, :k] @ moves
            now *= seen[t, :k]
            np.matmul(now, ones, out=scale[t, :k])
            np.divide(now, scale[t, :k], out=alpha[t, :k])
        beta = np.ones((n, len(start)), np.float32)
        for t in range(steps - 1, -1, -1):
            if t < steps - 1:
                k = active[t + 1]
                ahead = seen[t + 1, :k]
                ahead *= beta[:k]
                ahead /= scale[t + 1, :k]
                moved += alpha[t, :k].T @ ahead
                alpha[t + 1, :k] *= beta[:k]
                np.matmul(ahead, moves.T, out=beta[:k])
        self.moves += moves * moved
        alpha[0] *= beta
        self.start += alpha[0][first].sum(axis=0)
        there = np.arange(steps)[:, None] < lengths
        flat, weights = symbols[there], alpha[there]
        order = np.argsort(flat, kind="stable")
        flat, weights = flat[order], weights[order]
        new = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
        self.emits[flat[new]] += np.add.reduceat(weights, new, axis=0, dtype=np.float64)


def _pieces(parts: list[bytes]) -> Iterator[tuple[np.ndarray, bool]]:
    for part in parts:
        symbols = np.frombuffer(part, np.uint16)
        for at in range(0, len(symbols), PIECE):
            yield symbols[at : at + PIECE], at == 0


def _grouped(parts: list[bytes]) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    held: list[tuple[np.ndarray, bool]] = []
    for piece in _pieces(parts):
        held.append(piece)
        if len(held) == PIECES:
            yield [p for p, _ in held], np.array([f for _, f in held])
            held = []
    if held:
        yield [p for p, _ in held], np.array([f for _, f in held])


def train(text: Text, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """A model of the rows of ``text`` that are not held out.

    States start from the shares of the whole training text. Each round adds up, over all partitions, the expected counts of every piece of
    ``PIECE`` tokens; a piece that starts no text begins in the states' shares. The
    driver gets one row for each symbol and state.
    """
    model = Model.drawn(text.shares, states)
    spark = text.coded.sparkSession
    names = [f"e{s}" for s in range(states)]

    def rows(at: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(at), *[pa.array(values[:, s]) for s in range(states)]], ["at", *names])

    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(model.packed())

        def expect(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            counts = Counts(states)
            for batch in batches:
                for pieces, first in _grouped(batch.column("symbols").to_pylist()):
                    counts.add(sent.value, pieces, first)
            used = np.flatnonzero(counts.emits.any(axis=1))
            if len(used):
                yield rows(used, counts.emits[used])
                yield rows(-1 - np.arange(states), counts.moves)
                yield rows(np.array([SYMBOLS]), counts.start[None, :])

        schema = ", ".join(["at long", *[f"{n} double" for n in names]])
        found = text.coded.filter("not held").select("symbols").mapInArrow(expect, schema)
        summed = found.groupBy("at").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
        at = summed.column("at").to_numpy()
        values = np.stack([summed.column(n).to_numpy() for n in names], axis=1)
        counts = Counts(states)
        inside = (at >= 0) & (at < SYMBOLS)
        counts.emits[at[inside]] = values[inside]
        counts.moves[-1 - at[at < 0]] = values[at < 0]
        counts.start += values[at == SYMBOLS].sum(axis=0)
        model = Model.of_counts(text.shares, counts.start, counts.moves, counts.emits)
    return model


def forward(model: tuple[np.ndarray, ...], parts: list[bytes]) -> np.ndarray:
    """log10 probability of each sequence of symbols, by the scaled forward recursion over all of it."""
    start, _, moves, emits = model
    made = np.zeros(len(parts))
    flat = np.frombuffer(b"".join(parts), np.uint16)
    lengths = np.array([len(p) for p in parts]) // 2
    starts = np.cumsum(lengths) - lengths
    longest = np.argsort(-lengths, kind="stable")
    for at in range(0, len(parts), AT_ONCE):
        by = longest[at : at + AT_ONCE]
        own, size = starts[by], lengths[by]
        logs, steps = np.zeros(len(by)), int(size[0])
        active = np.searchsorted(-size, -np.arange(steps), side="left")
        now = None
        for t in range(steps):
            k = active[t]
            now = (np.broadcast_to(start, (k, len(start))) if t == 0 else now[:k] @ moves) * emits[flat[own[:k] + t]]
            scale = now.sum(axis=1)
            logs[:k] += np.log10(scale)
            now = now / scale[:, None]
        made[by] = logs
    return made


def score(text: Text, model: Model) -> DataFrame:
    """(key, held, n_tokens, n_known, base, score): log10 probabilities of each whole text, with its end."""
    sent = text.coded.sparkSession.sparkContext.broadcast((model.start, model.middle, model.moves, model.emits))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = forward(sent.value, batch.column("symbols").to_pylist()) + batch.column("inside").to_numpy()
                names = ["key", "held", "n_tokens", "n_known", "base"]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(found)], [*names, "score"])

    kind = text.coded.schema["key"].dataType.simpleString()
    return text.coded.mapInArrow(of, f"key {kind}, held boolean, n_tokens long, n_known long, base double, score double")


def score_texts(
    docs: DataFrame, held: Column, states: int = STATES, rounds: int = ROUNDS, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """(key, held, n_tokens, n_known, tokens, base, score) of every whole text, by a model of the rows that are not ``held``.

    Null texts are empty: a text without words is its end alone. A null ``held``
    is false. Repeated rows are texts of their own; equal texts of one model have
    equal scores. Without training rows every word is new; an empty table gives
    no rows; other columns are not looked at.
    """
    read_text = read(docs, held, text, key)
    scored = score(read_text, train(read_text, states, rounds))
    return scored.select(F.col("key").alias(key), "held", "n_tokens", "n_known", F.lit(read_text.tokens).cast("long").alias("tokens"), "base", "score")
