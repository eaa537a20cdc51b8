"""Toxicity scores from a bidirectional gated recurrent network with attention pooling.

A word enters the network with evidence of two kinds, both learned from labelled documents: of the
word itself, and of its character 3- and 4-grams. One network reads every window of a text, windows
overlap, and the strongest window decides. Evidence and network are fitted on different documents,
so that the network learns how far evidence can be trusted.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.llm import tokens
from pitchlake.llm.common import added_tables, materialise, sampled_labels

#: Labelled rows that the model is fitted on, at most; a quarter of them trains the network.
TRAIN_ROWS = 12_000
NETWORK_SHARE = 4
WINDOW, STRIDE = 64, 48
WORD_BUCKETS, GRAM_BUCKETS = 1 << 16, 1 << 16
HIDDEN, ATTENTION, INPUTS = 8, 8, 6
ROUNDS, EPOCHS, BATCH, RATE = 2, 5, 192, 0.015

_U = np.uint64


@dataclass
class Lexicon:
    """Log odds of toxic documents by hash bucket of words and of character n-grams."""

    words: np.ndarray
    grams: np.ndarray


# --- words and their inputs -----------------------------------------------------------------------


class _Text:
    """Different words of a column, and the code of each word of each row."""

    def __init__(self, texts: pa.Array):
        words = tokens.split(texts, tokens.SPACES, tokens.LOWER)
        h = tokens.hashes(words)
        self.first = words.first
        self.kinds, at, self.code = np.unique(h, return_index=True, return_inverse=True)
        start, end = words.start[at], words.end[at]
        # The bytes of each different word between two marks, one word after the other.
        size = end - start + 2
        self.ends = np.cumsum(size)
        self.begins = self.ends - size
        n = int(self.ends[-1]) if len(size) else 0
        source = np.repeat(start - self.begins - 1, size) + np.arange(n)
        self.bytes = words.bytes[np.clip(source, 0, max(len(words.bytes) - 1, 0))].astype(np.uint64)
        self.bytes[self.begins] = 1
        self.bytes[self.ends - 1] = 2

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """(bucket of each 3- and 4-gram, word it belongs to); every word has one of 3 at least."""
        out, owner = [], []
        word = np.repeat(np.arange(len(self.begins)), self.ends - self.begins)
        for n in (3, 4):
            if len(self.bytes) < n:
                continue
            key = np.full(len(self.bytes) - n + 1, _U(n))
            for i in range(n):
                key = key * _U(257) + self.bytes[i : len(self.bytes) - n + 1 + i]
            inner = word[: len(key)] == word[n - 1 :]
            out.append((tokens.mix(key[inner]) % _U(GRAM_BUCKETS)).astype(np.int64))
            owner.append(word[: len(key)][inner])
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        bucket, owner = np.concatenate(out), np.concatenate(owner)
        order = np.argsort(owner, kind="stable")
        return bucket[order], owner[order]

    def word_buckets(self) -> np.ndarray:
        return (self.kinds % _U(WORD_BUCKETS)).astype(np.int64)

    def inputs(self, lexicon: Lexicon) -> np.ndarray:
        """The network's inputs for each different word."""
        if not len(self.kinds):
            return np.zeros((0, INPUTS), np.float32)
        word = lexicon.words[self.word_buckets()]
        bucket, owner = self.grams()
        odds = lexicon.grams[bucket]
        cut = np.searchsorted(owner, np.arange(len(self.kinds)))
        count = np.diff(np.append(cut, len(odds)))
        high, low = np.maximum.reduceat(odds, cut), np.minimum.reduceat(odds, cut)
        mean = np.add.reduceat(odds, cut) / count
        return np.stack(
            (word, np.maximum(word, 0) ** 2 / 4, high, low, mean, np.log(count) / 2), axis=1
        ).astype(np.float32)


def _evidence(docs: DataFrame) -> Lexicon:
    """Log odds from the documents of ``docs`` (text, label) that hold a word or n-gram."""
    width = WORD_BUCKETS + GRAM_BUCKETS

    def count(texts, labels):
        text = _Text(texts)
        out = np.zeros(2 * (width + 1), np.int64)
        label = labels.to_numpy(zero_copy_only=False).astype(np.int64) > 0
        out[2 * width : ] = np.bincount(label, minlength=2)
        bucket, owner = text.grams()
        by_word = np.searchsorted(owner, np.arange(len(text.kinds) + 1))
        words = text.word_buckets()
        for d in range(len(label)):
            kinds = np.unique(text.code[text.first[d] : text.first[d + 1]])
            out[2 * np.unique(words[kinds]) + label[d]] += 1
            held = [bucket[by_word[k] : by_word[k + 1]] for k in kinds]
            if held:
                out[2 * (WORD_BUCKETS + np.unique(np.concatenate(held))) + label[d]] += 1
        return out

    table = added_tables(docs.select("text", "label"), 2 * (width + 1), count).astype(float)
    clean, toxic = table[2 * width], table[2 * width + 1]
    pairs = table[: 2 * width].reshape(width, 2)
    # Two documents' worth of doubt on either side keeps rare words near zero.
    share = (toxic + 1) / (toxic + clean + 2)
    odds = np.log((pairs[:, 1] + 2 * share) / (toxic + 2)) - np.log(
        (pairs[:, 0] + 2 * (1 - share)) / (clean + 2))
    odds = np.clip(odds, -4, 6).astype(np.float32)
    return Lexicon(odds[:WORD_BUCKETS], odds[WORD_BUCKETS:])


def _windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first word, length) of every window of rows of ``counts`` words; the last ends at the
    row's end. An empty row has one window without words."""
    n = np.maximum(1, 1 + -(-(counts - WINDOW) // STRIDE))
    row = np.repeat(np.arange(len(counts)), n)
    number = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    start = number * STRIDE
    return row, start, np.minimum(counts[row] - start, WINDOW)


# --- the network ----------------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):  # exp of a large number is inf, and its inverse 0
        return 1 / (1 + np.exp(-x))


def new_network(seed: int = 7) -> dict[str, np.ndarray]:
    """Weights: per direction inputs, recurrence and biases of the three gates; attention; output."""
    rng = np.random.default_rng(seed)
    h = HIDDEN
    out = {}
    for way in "fb":
        out[f"w{way}"] = rng.normal(0, 0.4, (INPUTS, 3 * h))
        out[f"u{way}"] = rng.normal(0, 0.3, (h, 3 * h))
        out[f"c{way}"] = np.zeros(3 * h)
    out["a"] = rng.normal(0, 0.4, (2 * h, ATTENTION))
    out["v"] = rng.normal(0, 0.5, ATTENTION)
    out["o"] = rng.normal(0, 0.4, 2 * h)
    out["d"] = np.zeros(1)
    return {k: x.astype(np.float32) for k, x in out.items()}


def _direction(net: dict, way: str, projected, lengths: np.ndarray, keep: list | None):
    """Hidden states of one direction at each step, zero outside a window.

    ``projected(t)`` gives the gates' input part at step t. ``keep`` collects what training needs.
    """
    n, steps, h = len(lengths), int(lengths.max(initial=0)), HIDDEN
    u = net[f"u{way}"]
    state = np.zeros((n, h), np.float32)
    out = np.zeros((steps, n, h), np.float32)
    for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
        live = (lengths > t)[:, None]
        x, r_in = projected(t), state @ u[:, : 2 * h]
        z = _sigmoid(x[:, :h] + r_in[:, :h])
        r = _sigmoid(x[:, h : 2 * h] + r_in[:, h:])
        candidate = np.tanh(x[:, 2 * h :] + (r * state) @ u[:, 2 * h :])
        new = np.where(live, z * state + (1 - z) * candidate, state)
        if keep is not None:
            keep.append((t, state, z, r, candidate, live))
        state = new
        out[t] = np.where(live, new, 0)
    return out


def _forward(net: dict, projected: dict, lengths: np.ndarray, trace: dict | None = None):
    """The logit of each window."""
    keep = {w: [] if trace is not None else None for w in "fb"}
    hidden = np.concatenate(
        [_direction(net, w, projected[w], lengths, keep[w]) for w in "fb"], axis=2)
    inside = np.arange(hidden.shape[0])[:, None] < lengths[None, :]
    attention = np.tanh(hidden @ net["a"])
    energy = np.where(inside, attention @ net["v"], -1e9)
    if hidden.shape[0]:
        energy -= energy.max(axis=0)
    weight = np.exp(energy) * inside
    weight /= np.maximum(weight.sum(axis=0), 1e-9)
    pooled = (weight[:, :, None] * hidden).sum(axis=0)
    if trace is not None:
        trace.update(keep=keep, hidden=hidden, attention=attention, weight=weight, pooled=pooled)
    return pooled @ net["o"] + net["d"][0]


def _gradients(net: dict, x: np.ndarray, lengths: np.ndarray, labels: np.ndarray, pull: np.ndarray):
    """Gradients of the weighted logistic loss over windows ``x`` (window, step, input)."""
    h = HIDDEN
    projected = {w: (lambda t, w=w: x[:, t] @ net[f"w{w}"] + net[f"c{w}"]) for w in "fb"}
    trace: dict = {}
    logit = _forward(net, projected, lengths, trace)
    p = _sigmoid(logit)
    grad = {k: np.zeros_like(v) for k, v in net.items()}
    d_logit = pull * (p - labels)
    grad["o"] += trace["pooled"].T @ d_logit
    grad["d"] += d_logit.sum()
    d_pooled = d_logit[:, None] * net["o"][None, :]
    hidden, weight, attention = trace["hidden"], trace["weight"], trace["attention"]
    d_hidden = weight[:, :, None] * d_pooled[None]
    d_weight = (hidden * d_pooled[None]).sum(axis=2)
    d_energy = weight * (d_weight - (weight * d_weight).sum(axis=0))
    grad["v"] += np.einsum("tnk,tn->k", attention, d_energy)
    d_raw = d_energy[:, :, None] * net["v"] * (1 - attention**2)
    grad["a"] += np.einsum("tnk,tnj->kj", hidden, d_raw)
    d_hidden += d_raw @ net["a"].T
    for i, w in enumerate("fb"):
        u, d_state = net[f"u{w}"], 0.0
        for t, state, z, r, candidate, live in reversed(trace["keep"][w]):
            d_new = d_state + np.where(live, d_hidden[t][:, i * h : (i + 1) * h], 0)
            d_c = np.where(live, d_new * (1 - z) * (1 - candidate**2), 0)
            d_z = np.where(live, d_new * (state - candidate) * z * (1 - z), 0)
            through = d_c @ u[:, 2 * h :].T
            d_r = through * state * r * (1 - r)
            gates = np.concatenate((d_z, d_r, d_c), axis=1)
            grad[f"w{w}"] += x[:, t].T @ gates
            grad[f"c{w}"] += gates.sum(axis=0)
            grad[f"u{w}"][:, : 2 * h] += state.T @ gates[:, : 2 * h]
            grad[f"u{w}"][:, 2 * h :] += (r * state).T @ d_c
            d_state = (
                np.where(live, d_new * z, d_new) + through * r + gates[:, : 2 * h] @ u[:, : 2 * h].T)
    return grad


def _train(look, labels: np.ndarray) -> dict[str, np.ndarray]:
    """Fit the network on texts with ``labels``; ``look(turn, net)`` gives (x, lengths) of a round's
    windows: the most toxic one of each text so far, then one at random of each.

    In each round a text is represented by the former; clean texts also show the latter.
    """
    rng = np.random.default_rng(11)
    net = new_network()
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.items()}
    toxic = max(float(labels.sum()), 1.0)
    clean = max(float(len(labels) - labels.sum()), 1.0)
    used = np.concatenate((np.arange(len(labels)), len(labels) + np.flatnonzero(labels == 0)))
    target = np.concatenate((labels, labels))[used]
    pull = np.where(target > 0, 0.5 / toxic, 0.25 / clean).astype(np.float32)
    step = 0
    for turn in range(ROUNDS):
        x, lengths = (part[used] for part in look(turn, net))
        for epoch in range(EPOCHS):
            rate = RATE * 0.5 ** (turn + epoch / EPOCHS)
            for rows in np.array_split(rng.permutation(len(used)), max(1, len(used) // BATCH)):
                grad = _gradients(
                    net, x[rows].astype(np.float32), lengths[rows], target[rows],
                    pull[rows] * len(used) / len(rows))
                step += 1
                for k, g in grad.items():
                    g = g + 1e-4 * net[k]
                    m, s = moments[k]
                    m += 0.1 * (g - m)
                    s += 0.01 * (g * g - s)
                    net[k] = net[k] - (
                        rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-6)
                    ).astype(np.float32)
    return net


def _calibrated(values: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve of the labels over ``values``, by Newton's method."""
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(slope * values + offset)
        w = np.maximum(p * (1 - p), 1e-6)
        g = np.array([((labels - p) * values).sum() - 0.01 * slope, (labels - p).sum()])
        hess = np.array([[(w * values**2).sum() + 0.01, (w * values).sum()],
                         [(w * values).sum(), w.sum() + 1e-6]])
        move = np.clip(np.linalg.solve(hess, g), -1, 1)
        slope, offset = slope + move[0], offset + move[1]
        if np.abs(move).max() < 1e-6:
            break
    return float(max(slope, 1e-3)), float(offset)


# --- on Spark -------------------------------------------------------------------------------------


@dataclass
class Model:
    lexicon: Lexicon
    net: dict[str, np.ndarray]
    slope: float
    offset: float


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, bound: int = TRAIN_ROWS) -> Model:
    """A model of ``labels.toxic`` from at most ``bound`` labelled rows that ``allowed`` admits.

    Without both kinds of labels all scores are the share of toxic ones, 1/4 without any label.
    """
    sample = sampled_labels(docs, labels, "toxic", allowed, bound)
    turn = F.pmod(F.crc32(F.concat(F.lit("net"), F.col("doc_id").cast("string")).cast("binary")),
                  F.lit(NETWORK_SHARE))
    lexicon = _evidence(sample.where(turn != 0))

    # Read once a round, by tasks that see all windows of a text and hand over two.
    shown = materialise(
        sample.where(turn == 0).select("doc_id", "text", F.col("label").cast("int").alias("label")),
        "toxicity_sample")

    def rows_of(schema: str, view) -> list:
        rows = shown.mapInArrow(view, schema).collect()  # bounded by the sample
        return sorted(rows, key=lambda r: (r.doc_id, r.hash))

    def view(turn: int, net: dict | None):
        def windows(batches):
            for batch in tokens.pieces(batches, 4_000_000):
                ids, texts = batch.column(0).to_pylist(), batch.column(1)
                text = _Text(texts)
                inputs = text.inputs(lexicon)
                row, start, length = _windows(np.diff(text.first))
                value = (_evidence_of(text, inputs, row, start, length) if turn == 0
                         else _window_logits(net, text, inputs, row, start, length))
                first = np.searchsorted(row, np.arange(batch.num_rows))
                count = np.diff(np.append(first, len(row)))
                by_value = np.lexsort((-value, row))[first]
                data = [[], []]
                sizes = [[], []]
                marks = [zlib.crc32(t.encode("utf-8", "replace")) for t in texts.to_pylist()]
                for d, doc in enumerate(ids):
                    chance = zlib.crc32(f"{turn} {doc} {marks[d]}".encode()) / 2**32
                    for k, w in enumerate((by_value[d], first[d] + int(chance * count[d]))):
                        at = text.first[d] + start[w]
                        x = inputs[text.code[at : at + length[w]]]
                        data[k].append(x.astype(np.float16).tobytes())
                        sizes[k].append(int(length[w]))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), pa.array(marks, pa.int64()), batch.column(2),
                    *[pa.array(x, pa.binary()) for x in data],
                    *[pa.array(n, pa.int64()) for n in sizes],
                    pa.array(value[by_value].astype(float)),
                ], ["doc_id", "hash", "label", "best", "other", "n_best", "n_other", "value"])

        return rows_of(
            "doc_id long, hash long, label int, best binary, other binary, n_best long, "
            "n_other long, value double", windows)

    def look(turn: int, net: dict):
        rows = first if turn == 0 else view(turn, net)
        lengths = np.array([r.n_best for r in rows] + [r.n_other for r in rows])
        x = np.zeros((len(lengths), WINDOW, INPUTS), np.float16)
        x[np.arange(WINDOW)[None, :] < lengths[:, None]] = np.concatenate(
            [np.frombuffer(d, np.float16).reshape(-1, INPUTS)
             for d in [r.best for r in rows] + [r.other for r in rows]])
        return x, lengths

    first = view(0, None)
    target = np.array([r.label > 0 for r in first], np.float32)
    if not 0 < target.sum() < len(target):
        odds = (target.sum() + 0.5) / (len(target) - target.sum() + 1.5)
        return Model(lexicon, new_network(), 0.0, float(np.log(odds)))
    net = _train(look, target)
    # Calibrated on what ``text_scores`` takes: the largest logit of all windows.
    slope, offset = _calibrated(np.array([r.value for r in view(ROUNDS, net)]), target)
    return Model(lexicon, net, slope, offset)


def _gathered(text: _Text, row: np.ndarray, start: np.ndarray, length: np.ndarray):
    """(windows, codes by step and window, sizes) of some windows at a time, of like length; the
    code ``len(text.kinds)`` stands for a step outside the window."""
    order = np.argsort(-length, kind="stable")
    code = np.append(text.code, len(text.kinds))
    for at in range(0, len(order), 2048):
        own = order[at : at + 2048]
        base, size = text.first[row[own]] + start[own], length[own]
        steps = np.arange(int(size.max(initial=0)))[:, None]
        yield own, code[np.where(steps < size, base + steps, len(code) - 1)], size


def _window_logits(net: dict, text: _Text, inputs: np.ndarray, row, start, length) -> np.ndarray:
    by_word = {
        w: np.concatenate((inputs @ net[f"w{w}"] + net[f"c{w}"],
                           np.zeros((1, 3 * HIDDEN), np.float32))) for w in "fb"}
    logit = np.empty(len(row), np.float32)
    for own, codes, size in _gathered(text, row, start, length):
        logit[own] = _forward(
            net, {w: (lambda t, w=w, c=codes: by_word[w][c[t]]) for w in "fb"}, size)
    return logit


def _evidence_of(text: _Text, inputs: np.ndarray, row, start, length) -> np.ndarray:
    """The most evidence of any kind in each window."""
    value = np.zeros(len(row), np.float32)
    for k in (0, 2):
        by_word = np.append(inputs[:, k], np.float32(-9))
        for own, codes, _ in _gathered(text, row, start, length):
            value[own] += by_word[codes].max(axis=0, initial=-9)
    return value


def text_scores(model: Model, texts: pa.Array) -> np.ndarray:
    """The score of each row: its most toxic window's logit, calibrated."""
    text = _Text(texts)
    row, start, length = _windows(np.diff(text.first))
    logit = _window_logits(model.net, text, text.inputs(model.lexicon), row, start, length)
    best = np.maximum.reduceat(logit, np.searchsorted(row, np.arange(len(texts))))
    return _sigmoid(model.slope * best.astype(float) + model.offset)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``__toxicity`` between 0 and 1 for every row, from its whole text alone.

    NULL and empty texts are scored like a window without words. Rows, repeated or not, and all
    other columns stay as they are.
    """
    sent, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text)

    def scored(batches):
        for batch in tokens.pieces(batches, 8_000_000):
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(text_scores(sent.value, batch.column(at)))],
                    [*batch.schema.names, "__toxicity"])

    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    return docs.mapInArrow(scored, f"{schema}, __toxicity double")
