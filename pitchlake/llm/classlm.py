"""Class-based bigram language model after Brown, and scores of whole texts under it.

Every word has a class. A text's probability is the product, over its words and one end, of the
probability of the word's class after the class before, and of the word within its class. Exchange
clustering assigns the classes: a word moves to the class that raises the likelihood of the
training text's class bigrams most. Words move by hash bucket, so the tables of an exchange have a
fixed size; word counts within classes are exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm import tokens
from pitchlake.llm.common import CHUNK_CHARS, added_tables, materialise

CLASSES = 32
#: Hash buckets of words; all words of one bucket have the same class.
BUCKETS = 1 << 14
#: Passes over the corpus that move words between classes.
EXCHANGES = 2
#: Added to every class bigram.
ALPHA = 0.1

_U = np.uint64
#: The end of a text as a word; 0 is no hash of a word but by a chance of 2^-64.
END = _U(0)


def _text_words(texts: pa.Array):
    """(hashes of the words of all rows with an END behind each row, row bounds)."""
    words = tokens.split(texts, tokens.SPACES, tokens.LOWER)
    first = words.first + np.arange(len(words.first))
    out = np.full(int(first[-1]), END, np.uint64)
    rows = words.rows()
    out[np.arange(len(rows)) + rows] = tokens.hashes(words)
    return out, first


def _bucket(h: np.ndarray) -> np.ndarray:
    """The bucket of each word; the end has one of its own, the last."""
    return np.where(h == END, BUCKETS, (h >> _U(20)) % _U(BUCKETS)).astype(np.int64)


def _previous(classes: np.ndarray, first: np.ndarray, classes_n: int) -> np.ndarray:
    """The class before each word; a text starts behind the class of ends."""
    out = np.empty_like(classes)
    out[1:] = classes[:-1]
    out[first[:-1]] = classes_n
    return out


def bucket_counts(docs: DataFrame) -> np.ndarray:
    """Words of all rows by bucket."""
    return added_tables(
        docs.select("text"), BUCKETS + 1,
        lambda texts: np.bincount(_bucket(_text_words(texts)[0]), minlength=BUCKETS + 1))


def neighbour_counts(docs: DataFrame, assigned: np.ndarray, classes: int):
    """(after, before) over all rows: ``after[b, c]`` counts words of class c behind bucket b,
    ``before[b, c]`` those in front of it; the start of a text counts as the last class."""
    sent = docs.sparkSession.sparkContext.broadcast(assigned)
    width = classes + 1
    cells = (BUCKETS + 1) * 2 * width

    def count(texts):
        h, first = _text_words(texts)
        b = _bucket(h)
        c = sent.value[b]
        out = np.bincount((b * 2 + 1) * width + _previous(c, first, classes), minlength=cells)
        followed = np.ones(len(h), bool)
        followed[first[1:] - 1] = False  # nothing follows an end
        at = np.flatnonzero(followed)
        return out + np.bincount(b[at] * 2 * width + c[at + 1], minlength=cells)

    table = added_tables(docs.select("text"), cells, count).reshape(BUCKETS + 1, 2, width)
    return table[:, 0], table[:, 1]


def first_classes(counts: np.ndarray, classes: int) -> np.ndarray:
    """Buckets dealt to classes in turn by falling count; the end has the last class."""
    order = np.argsort(-counts[:BUCKETS], kind="stable")
    out = np.full(BUCKETS + 1, classes, np.int64)
    out[order] = np.minimum(np.arange(BUCKETS), np.arange(BUCKETS) % classes)
    return out


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(assigned: np.ndarray, after: np.ndarray, before: np.ndarray, classes: int):
    """One exchange over all buckets by falling count, each to the class that is best for it.

    The likelihood of the class bigrams is the sum of n log n over class pairs, minus that over
    classes as left and as right neighbours. Neighbours' classes stay those of the pass that
    counted them; class totals follow every move.
    """
    out = assigned.copy()
    pair = np.zeros((classes + 1, classes + 1))
    np.add.at(pair, assigned, after[: BUCKETS + 1].astype(float))
    # Start contexts: the first words of texts stand behind the end's class.
    starts = before[:, classes].astype(float)
    np.add.at(pair[classes], assigned, starts)
    count = before.sum(axis=1)
    inner = np.arange(classes)
    for b in np.argsort(-count[:BUCKETS], kind="stable"):
        if not count[b]:
            break
        right, left = after[b].astype(float), before[b].astype(float)
        own = out[b]
        pair[own] -= right
        pair[:, own] -= left
        # What class k gains by this bucket, in its row, its column and its totals.
        rows, columns = pair[:classes], pair[:, :classes]
        gain = (
            (_xlogx(np.maximum(rows + right, 0)) - _xlogx(np.maximum(rows, 0))).sum(axis=1)
            + (_xlogx(np.maximum(columns + left[:, None], 0))
               - _xlogx(np.maximum(columns, 0))).sum(axis=0)
        )
        row, column = np.maximum(rows.sum(axis=1), 0), np.maximum(columns.sum(axis=0), 0)
        gain -= _xlogx(row + right.sum()) - _xlogx(row)
        gain -= _xlogx(column + left.sum()) - _xlogx(column)
        best = int(inner[np.argmax(gain)])
        out[b] = best
        pair[best] += right
        pair[:, best] += left
    return out


def train_classes(train: DataFrame, classes: int = CLASSES, exchanges: int = EXCHANGES):
    """(class of each bucket, log10 of class transitions) over all training rows."""
    assigned = first_classes(bucket_counts(train), classes)
    for _ in range(exchanges):
        assigned = exchange(assigned, *neighbour_counts(train, assigned, classes), classes)
    _, before = neighbour_counts(train, assigned, classes)
    pair = np.zeros((classes + 1, classes + 1))  # by class of the word, then the class before it
    np.add.at(pair, assigned, before.astype(float))
    smooth = (pair + ALPHA) / (pair.sum(axis=0) + ALPHA * (classes + 1))
    return assigned, np.log10(smooth.T)


class _Chunk:
    """A chunk's rows in a fixed order, their words, and the different words among them."""

    def __init__(self, table: pa.Table):
        order = np.lexsort((
            table.column("digest").to_numpy(),
            table.column("doc_id").combine_chunks().fill_null(-1).to_numpy()))
        self.ids = table.column("doc_id").combine_chunks().take(pa.array(order))
        self.held = table.column("held").to_numpy()[order]
        self.words, self.first = _text_words(table.column("text").combine_chunks().cast(
            pa.large_string()).take(pa.array(order)))
        self.vocabulary, self.code = np.unique(self.words, return_inverse=True)

    def training_counts(self) -> np.ndarray:
        trains = np.repeat(~self.held, np.diff(self.first))
        return np.bincount(self.code[trains], minlength=len(self.vocabulary))


def score(
    docs: DataFrame, held_out: str, classes: int = CLASSES, exchanges: int = EXCHANGES,
    chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    Rows whose boolean column ``held_out`` is false or NULL train the model; all rows are scored.
    Tokens are words ``[^\\x20\\x09-\\x0D]+`` in lower-case A-Z, and an end behind each text; NULL and
    empty texts are an end alone. ``base_score`` is the log10 probability under counts of single
    tokens, ``score`` that under the class model. Without training rows all tokens are unknown.
    Repeated rows train and score once each; other columns are not read.

    Counts and classes cover all training rows. Words are told apart by 64-bit hashes.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col(held_out), F.lit(False)).alias("held"))
    assigned, moves = train_classes(rows.where("not held"), classes, exchanges)
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast((assigned, moves))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(size // chunk_chars) + 1
    chunks = rows.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int").alias("chunk"),
        "doc_id", "held", F.xxhash64("text").alias("digest"), "text")

    def ask(key, table):
        chunk = _Chunk(table)
        counts = chunk.training_counts()
        part = (chunk.vocabulary % _U(n)).astype(np.int64)
        parts, data = [], []
        for p in range(n):
            own = np.flatnonzero(part == p)
            if len(own):
                parts.append(p)
                data.append(
                    chunk.vocabulary[own].tobytes() + counts[own].astype(np.uint32).tobytes())
        return pa.table({
            "part": pa.array(parts, pa.int32()),
            "chunk": pa.array([key[0].as_py()] * len(parts), pa.int32()),
            "data": pa.array(data, pa.binary())})

    def answer(key, table):
        words, counts = [], []
        for x in table.column("data").to_pylist():
            m = len(x) // 12
            words.append(np.frombuffer(x, np.uint64, m))
            counts.append(np.frombuffer(x, np.uint32, m, 8 * m))
        known, code = np.unique(np.concatenate(words), return_inverse=True)
        total = np.zeros(len(known), np.int64)
        np.add.at(total, code, np.concatenate(counts).astype(np.int64))
        # What the probabilities need of all words: tokens and different tokens by class.
        of = model.value[0][_bucket(known)]
        by = [np.bincount(of, x, classes + 1).astype(np.int64) for x in (total, total > 0)]
        cuts = np.cumsum([0] + [len(w) for w in words])
        return pa.table({
            "part": pa.array([key[0].as_py()] * len(words), pa.int32()),
            "chunk": table.column("chunk"),
            "counts": pa.array(
                [total[code[a:b]].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)],
                pa.binary()),
            "tokens_by": pa.array([by[0].tolist()] * len(words), pa.list_(pa.int64())),
            "kinds_by": pa.array([by[1].tolist()] * len(words), pa.list_(pa.int64()))})

    answers = materialise(
        chunks.groupBy("chunk").applyInArrow(ask, "part int, chunk int, data binary")
        .groupBy("part").applyInArrow(
            answer, "part int, chunk int, counts binary, tokens_by array<long>, "
                    "kinds_by array<long>"), "counts")
    tokens_by, kinds_by = np.zeros(classes + 1), np.zeros(classes + 1)
    sums = answers.groupBy("part").agg(
        F.first("tokens_by").alias("t"), F.first("kinds_by").alias("k")).agg(*[
            F.sum(F.get(c, F.lit(i))).alias(f"{c}{i}") for c in "tk" for i in range(classes + 1)])
    for name, value in sums.first().asDict().items():
        (tokens_by if name[0] == "t" else kinds_by)[int(name[1:])] = value or 0
    train_tokens, kinds = int(tokens_by.sum()), int(kinds_by.sum())
    below = np.log10(tokens_by + 0.5 * (kinds_by + 1))
    below_all = np.log10(train_tokens + 0.5 * (kinds + 1))

    def finish(left, right):
        chunk = _Chunk(left)
        counts = np.zeros(len(chunk.vocabulary), np.int64)
        part = (chunk.vocabulary % _U(n)).astype(np.int64)
        for p, data in zip(right.column("part").to_pylist(), right.column("counts"), strict=True):
            counts[part == p] = np.frombuffer(data.as_buffer(), np.int64)
        assigned, moves = model.value
        classes_of = assigned[_bucket(chunk.vocabulary)]
        word = np.log10(counts + 0.5)
        cls = classes_of[chunk.code]
        step = moves[_previous(cls, chunk.first, classes), cls] - below[cls] + word[chunk.code]
        first = chunk.first[:-1]  # no row is without its end

        def by_row(x):
            return np.add.reduceat(x, first) if len(first) else np.zeros(0)

        sizes = np.diff(chunk.first)
        return pa.table({
            "doc_id": chunk.ids, "held_out": pa.array(chunk.held),
            "n_tokens": pa.array(sizes, pa.int64()),
            "n_known": pa.array(by_row((counts > 0)[chunk.code].astype(np.int64)), pa.int64()),
            "train_tokens": pa.array(np.full(len(sizes), train_tokens), pa.int64()),
            "base_score": pa.array(by_row(word[chunk.code]) - sizes * below_all, pa.float64()),
            "score": pa.array(by_row(step), pa.float64())})

    return chunks.groupBy("chunk").cogroup(
        answers.select("chunk", "part", "counts").groupBy("chunk")
    ).applyInArrow(
        finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                "base_score double, score double")


def perplexity(scored: DataFrame) -> DataFrame:
    """``scored`` with the class model's perplexity of each text."""
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
