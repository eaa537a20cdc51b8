"""Quality scores from random-indexing word vectors and a small calibrated network.

A word's index vector is a sparse random +-1 vector of its hash and its shape. Its context vector
is the sum of the index vectors beside it in all documents; words share context vectors by hash
bucket, so their table has a fixed size. A document pools both kinds of vectors of its words, and a
two-layer network reads the pool. A temperature fitted on rows apart calibrates its probabilities.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.llm import tokens
from pitchlake.llm.common import added_tables, sampled_labels

#: Labelled rows that the network is fitted on, at most.
TRAIN_ROWS = 16_000
DIMENSIONS, BUCKETS = 32, 1 << 14
FEATURES = 2 * DIMENSIONS + 3
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 24, 60, 256, 0.01, 1e-4
#: One in so many training rows fits the temperature instead of the network.
CALIBRATION_SHARE = 5
#: Words whose vectors are pooled at a time.
POOL_WORDS = 1 << 17

_U = np.uint64

#: Classes of bytes for word shapes: each ASCII mark its own, letters and digits by kind.
_KIND = np.arange(256, dtype=np.uint64)
_KIND[48:58], _KIND[65:91], _KIND[97:123], _KIND[128:] = 1, 2, 3, 4


class _Indexed:
    """Words of a column: hashes, buckets, and (dimension, sign) of each index vector's entries."""

    def __init__(self, texts: pa.Array):
        words = tokens.split(texts)
        self.first, self.hash = words.first, tokens.hashes(words)
        data = _KIND[words.bytes]
        size = words.end - words.start
        second = np.minimum(words.start + 1, words.end - 1)
        shape = tokens.mix(
            data[words.start] + _U(256) * data[second] + _U(65536) * data[words.end - 1]
            + _U(1 << 24) * np.minimum(size, 3).astype(np.uint64))
        self.bucket = (self.hash >> _U(40)).astype(np.int64) % BUCKETS
        self.entries = [
            ((h >> _U(a)).astype(np.int64) % DIMENSIONS,
             1 - 2 * ((h >> _U(a + 5)) & _U(1)).astype(np.int64))
            for h, a in ((self.hash, 0), (self.hash, 12), (shape, 0), (shape, 12))
        ]

    def beside(self) -> np.ndarray:
        """Words that are followed by a word of the same row."""
        followed = np.ones(len(self.hash), bool)
        ends = self.first[1:] - 1
        followed[ends[self.first[1:] > self.first[:-1]]] = False
        return np.flatnonzero(followed)


def context_vectors(docs: DataFrame) -> np.ndarray:
    """The context vector of each bucket, of length 1 unless no word fell there, from all rows."""

    def count(texts):
        words = _Indexed(texts)
        out = np.zeros(BUCKETS * DIMENSIONS)
        left = words.beside()
        for at, near in ((left, left + 1), (left + 1, left)):
            base = words.bucket[at] * DIMENSIONS
            for dimension, sign in words.entries:
                out += np.bincount(base + dimension[near], sign[near], len(out))
        return out

    table = added_tables(
        docs.select(F.coalesce("text", F.lit("")).alias("text")), BUCKETS * DIMENSIONS, count)
    table = table.reshape(BUCKETS, DIMENSIONS).astype(float)
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    return (table / np.maximum(norm, 1)).astype(np.float32)


def pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """A row of features for each text: means over its words of context and index vectors, the
    shares of words that repeat or point the way of the word before, and the log of their number."""
    words, rows = _Indexed(texts), len(texts)
    counts = np.diff(words.first)
    out = np.zeros((rows, FEATURES))
    owner = np.repeat(np.arange(rows), counts)
    share = 1 / np.maximum(counts, 1)
    for at in range(0, len(owner), POOL_WORDS):
        part = slice(at, at + POOL_WORDS)
        found, first = np.unique(owner[part], return_index=True)
        out[found, :DIMENSIONS] += np.add.reduceat(vectors[words.bucket[part]], first, axis=0)
    own = np.zeros(rows * DIMENSIONS)
    for dimension, sign in words.entries:
        own += np.bincount(owner * DIMENSIONS + dimension, sign, len(own))
    out[:, DIMENSIONS : 2 * DIMENSIONS] = own.reshape(rows, DIMENSIONS)
    left = words.beside()
    same = words.hash[left] == words.hash[left + 1]
    near = words.bucket[left] % 64 == words.bucket[left + 1] % 64
    out[:, -3] = np.bincount(owner[left], same, rows)
    out[:, -2] = np.bincount(owner[left], near, rows)
    out[:, :-1] *= share[:, None]
    out[:, -1] = np.log1p(counts)
    return out


@dataclass
class Model:
    vectors: np.ndarray
    middle: np.ndarray
    scale: np.ndarray
    net: list[np.ndarray]
    temperature: float

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        logit = _logits(self.net, (x - self.middle) / self.scale)
        return 1 / (1 + np.exp(-np.clip(logit / self.temperature, -60, 60)))


def _logits(net: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    return np.tanh(x @ net[0] + net[1]) @ net[2] + net[3]


def train(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Weights of the two layers by Adam on the logistic loss."""
    rng = np.random.default_rng(5)
    net = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
           rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in net]
    step = 0
    for epoch in range(EPOCHS):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // BATCH)):
            a, b = x[rows], y[rows]
            middle = np.tanh(a @ net[0] + net[1])
            off = (1 / (1 + np.exp(-np.clip(middle @ net[2] + net[3], -60, 60))) - b) / len(rows)
            back = off[:, None] * net[2] * (1 - middle**2)
            step += 1
            grads = (a.T @ back, back.sum(axis=0), middle.T @ off, off.sum(keepdims=True))
            for k, (g, (m, s)) in enumerate(zip(grads, moments, strict=True)):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                rate = RATE * 0.5 ** (3 * epoch / EPOCHS)
                net[k] = net[k] * (1 - rate * DECAY) - rate * (m / (1 - 0.9**step)) / (
                    np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return net


def calibrated(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least logistic loss, on a grid from 1/4 to 16."""
    grid = 2.0 ** np.arange(-2, 4.01, 0.05)
    z = logits[:, None] / grid
    return float(grid[np.argmin((np.logaddexp(0, z) - y[:, None] * z).sum(axis=0))])


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, bound: int = TRAIN_ROWS) -> Model:
    """A model of ``labels.quality`` from at most ``bound`` labelled rows that ``allowed`` admits.

    Word vectors come from all documents. Without labelled rows all scores are 1/2.
    """
    vectors = context_vectors(docs)
    sent = docs.sparkSession.sparkContext.broadcast(vectors)

    def features(batches):
        for batch in tokens.pieces(batches, 8_000_000):
            x = pooled(batch.column(1), sent.value)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(2),
                pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "label", "x"])

    rows = (
        sampled_labels(docs, labels, "quality", allowed, bound)
        .select("doc_id", "text", F.col("label").cast("int").alias("label"))
        .mapInArrow(features, "doc_id long, label int, x array<double>").collect()
    )  # bounded by the sample
    rows.sort(key=lambda r: (r.doc_id, r.x))
    if not rows:
        return Model(vectors, np.zeros(FEATURES), np.ones(FEATURES),
                     [np.zeros((FEATURES, 1)), np.zeros(1), np.zeros(1), np.zeros(1)], 1.0)
    x, y = np.array([r.x for r in rows]), np.array([float(r.label > 0) for r in rows])
    middle, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    apart = np.arange(len(rows)) % CALIBRATION_SHARE == 0
    z = (x - middle) / scale
    net = train(z[~apart], y[~apart]) if (~apart).any() else train(z, y)
    return Model(vectors, middle, scale, net, calibrated(_logits(net, z[apart]), y[apart]))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``__quality`` between 0 and 1 for every row, from its whole text alone.

    NULL and empty texts are scored like a text without words. Rows, repeated or not, and all other
    columns stay as they are.
    """
    sent, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text)

    def scored(batches):
        for batch in tokens.pieces(batches, 8_000_000):
            x = pooled(batch.column(at), sent.value.vectors)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sent.value.probabilities(x))],
                [*batch.schema.names, "__quality"])

    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    return docs.mapInArrow(scored, f"{schema}, __quality double")
