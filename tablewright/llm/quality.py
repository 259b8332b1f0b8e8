"""A quality classifier: logistic regression on hashed word n-grams, fitted by FTRL.

Words are used in two forms, lower-cased and as their shape (kinds of
characters at both ends), so that noise in words never seen before is noticed.
Unigrams and bigrams of the former and uni-, bi- and trigrams of the latter are
hashed into ``2 ** BITS`` columns. A text's vector holds the share of each
column among its n-grams, and its score is the logistic function of a sparse dot
product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, text_bytes

BITS = 20
SAMPLE = 4096  # labelled rows that a model is fitted on at most
SCALE = 10.0  # of the shares, so that one step of learning counts
CACHED_WORDS = 300_000  # words whose hashes a Python worker remembers

_MASK = np.uint64((1 << BITS) - 1)
_FIRST, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_KINDS = bytes(
    ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 or b > 127 else ord("0") if 48 <= b <= 57 else b
    for b in range(256)
)
_words: dict[bytes, bytes] = {}


def _hashes(words: list[bytes]) -> np.ndarray:
    """Two rows: hashes of the words in lower case and of their shapes."""

    def new(word: bytes) -> bytes:
        if len(_words) >= CACHED_WORDS:
            _words.clear()
        kinds = word.translate(_KINDS)
        digest = xxhash.xxh3_64_digest
        _words[word] = made = digest(word.lower()) + digest(b"\0" + kinds[:2] + kinds[-3:])
        return made

    found = b"".join([_words.get(w) or new(w) for w in words])
    return np.frombuffer(found, np.uint64).reshape(-1, 2).T


def columns(text: bytes) -> tuple[np.ndarray, int]:
    """The hashed column of every n-gram of a text, from 1 on, and its number of words."""
    words = text.split()
    if not words:
        return np.empty(0, np.int64), 0
    word, shape = _hashes(words)
    shape = shape.copy()
    shape[1:][word[1:] == word[:-1]] ^= _SECOND  # a word that repeats the one before
    grams = [word, word[1:] * _FIRST + word[:-1], shape, shape[1:] * _FIRST + shape[:-1]]
    grams.append((shape[2:] * _FIRST + shape[1:-1]) * _FIRST + shape[:-2])
    mixed = np.concatenate(grams)
    mixed ^= mixed >> np.uint64(29)
    mixed *= _SECOND
    mixed ^= mixed >> np.uint64(32)
    return (mixed & _MASK).astype(np.int64) + 1, len(words)


class Ftrl:
    """Follow-the-regularised-leader, proximal form, for logistic loss. Column 0 is the bias."""

    def __init__(self, size: int, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.01, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, at) -> np.ndarray:
        z = self.z[at]
        slack = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -slack / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        held = self.weights(at)
        gradient = (_logistic(held @ values) - label) * values
        more = self.n[at] + gradient * gradient
        self.z[at] += gradient - (np.sqrt(more) - np.sqrt(self.n[at])) / self.alpha * held
        self.n[at] = more


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class QualityModel:
    """Weights that are not 0, and their columns: at most ``2 ** BITS + 1`` of each."""

    at: np.ndarray
    weights: np.ndarray

    def dense(self) -> np.ndarray:
        full = np.zeros((1 << BITS) + 1)
        full[self.at] = self.weights
        return full


def fit(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    epochs: int = 4,
    text: str = "text",
    key: str = "doc_id",
    label: str = "quality",
) -> QualityModel:
    """A model of ``label`` (0 or 1) by the texts of ``docs``.

    It learns from at most ``sample`` documents of at most ``sample`` rows of
    ``labels``, those of the lowest hash of the key and, where many documents have
    one key, of key and text; only the keys are broadcast, and one task holds the
    vectors. Null keys and labels teach nothing, a null text is empty, keys that
    repeat teach each time. Without labelled rows every weight is 0.
    """
    chosen = (
        labels.select(F.col(key).alias("__key"), F.col(label).cast("int").alias("__label"))
        .filter("__key is not null and __label is not null")
        .orderBy(F.xxhash64("__key"), "__key", "__label")
        .limit(sample)
    )
    rows = docs.join(F.broadcast(chosen), docs[key] == F.col("__key")).select(
        F.xxhash64("__key").alias("order"), F.xxhash64("__key", text).alias("again"), F.col("__label").alias("label"), F.col(text).alias("text")
    )

    def vectors(batch: pa.RecordBatch) -> pa.RecordBatch:
        at, shares = [], []
        for body in text_bytes(batch.column("text")):
            found, _ = columns(body)
            own, counts = np.unique(found, return_counts=True)
            at.append(own.astype(np.int32))
            shares.append((counts * (SCALE / max(len(found), 1))).astype(np.float32))
        made = [pa.array(at, pa.list_(pa.int32())), pa.array(shares, pa.list_(pa.float32()))]
        own = ["order", "again", "label"]
        return pa.RecordBatch.from_arrays([*[batch.column(c) for c in own], *made], [*own, "at", "shares"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for order, y, at, shares in zip(*(batch.column(c) for c in ("order", "label", "at", "shares")), strict=True):
                own = np.append(0, at.values.to_numpy()), np.append(1.0, shares.values.to_numpy())
                held.append((order.as_py(), y.as_py(), own[0].astype(np.int32), own[1].astype(np.float32)))
        held.sort(key=lambda row: (row[0], row[1], len(row[2]), row[2].tobytes()))
        model = Ftrl((1 << BITS) + 1)
        for epoch in range(epochs):
            for i in np.random.default_rng(epoch).permutation(len(held)):
                _, y, at, shares = held[i]
                model.learn(at, shares.astype(np.float64), y)
        weights = model.weights(slice(None))
        used = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(weights[used])], ["at", "weight"])

    sparse = map_batches(rows, vectors, "order long, again long, label int, at array<int>, shares array<float>")
    found = sparse.orderBy("order", "again", "label").limit(sample).repartition(1).mapInArrow(train, "at long, weight double").toArrow()
    return QualityModel(found.column("at").to_numpy(), found.column("weight").to_numpy())


def score(docs: DataFrame, model: QualityModel, target: str = "score", text: str = "text") -> DataFrame:
    """``docs`` with the score of each whole text, 0 to 1; null and empty texts get that of the bias.

    A column of the name of ``target`` is replaced.
    """
    docs = docs.drop(target)
    sent = docs.sparkSession.sparkContext.broadcast((model.at, model.weights))
    names = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    held: list[np.ndarray] = []

    def scored(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not held:
            held.append(QualityModel(*sent.value).dense())
        weights = held[0]
        made = []
        for body in text_bytes(batch.column(text)):
            at, _ = columns(body)
            made.append(weights[0] + (weights[at].sum() * SCALE / len(at) if len(at) else 0.0))
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(_logistic(np.array(made)))], [*names, target])

    return map_batches(docs, scored, f"{schema}, `{target}` double", text)
