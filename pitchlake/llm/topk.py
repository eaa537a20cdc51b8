"""Exact top-k by inner product: score everything, refine score histograms, filter, break ties.

A block of queries goes to every task. Each round counts, per query, the scores in the bins of a
range that shrinks around the k-th largest score; when the bins are one wide, that value is known
and one last pass keeps what reaches it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BINS = 256
#: Queries that are sent to all tasks at a time.
QUERY_BLOCK = 4096
#: Candidates that are scored at a time; with the query block this bounds the score matrix.
CANDIDATES = 512


def _integer_rows(ids: pa.Array, vectors: pa.Array, scale: int):
    """(ids, matrix of floored components) for each vector length among usable rows."""
    if pa.types.is_large_list(vectors.type) or pa.types.is_list(vectors.type):
        vectors = vectors.cast(pa.large_list(pa.float64()))
    offsets = np.frombuffer(vectors.buffers()[1], np.int64)[
        vectors.offset : vectors.offset + len(vectors) + 1
    ]
    values = vectors.values.to_numpy(zero_copy_only=False)  # a NULL component becomes NaN
    lengths = np.diff(offsets)
    usable = ~(
        vectors.is_null().to_numpy(zero_copy_only=False)
        | ids.is_null().to_numpy(zero_copy_only=False)
    )
    ids = ids.fill_null(0).cast(pa.int64()).to_numpy(zero_copy_only=False)
    for length in np.unique(lengths[usable]):
        rows = np.flatnonzero(usable & (lengths == length))
        matrix = values[offsets[rows][:, None] + np.arange(length)[None, :]]
        fine = np.isfinite(matrix).all(axis=1)
        yield int(length), ids[rows[fine]], np.floor(matrix[fine] * scale)


def _scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Integer inner products; doubles are exact while no sum can pass 2^53."""
    bound = np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * max(left.shape[1], 1)
    if bound < 2**53:
        return (left @ right.T).astype(np.int64)
    return left.astype(np.int64) @ right.astype(np.int64).T


class _Block:
    """Queries of one block by vector length."""

    def __init__(self, rows: list, scale: int):
        ids = pa.array([r[0] for r in rows], pa.int64())
        vectors = pa.array([r[1] for r in rows], pa.list_(pa.float64()))
        self.ids, self.parts, at = [], {}, 0
        for length, own, matrix in _integer_rows(ids, vectors, scale):
            self.parts[length] = (np.arange(at, at + len(own)), own, matrix)
            self.ids.extend(own.tolist())
            at += len(own)

    def scored(self, batch: pa.RecordBatch, scale: int) -> Iterator[tuple]:
        """(query numbers, candidate ids, scores by query and candidate, the query's own row)."""
        for length, ids, matrix in _integer_rows(batch.column(0), batch.column(1), scale):
            if length not in self.parts:
                continue
            numbers, own, queries = self.parts[length]
            for at in range(0, len(ids), CANDIDATES):
                part = ids[at : at + CANDIDATES]
                yield numbers, part, _scores(queries, matrix[at : at + CANDIDATES]), (
                    own[:, None] == part[None, :]
                )


def _merge_top(kept: list, k: int) -> list[np.ndarray]:
    """The k best (query, vec_id, score) of each query among ``kept``."""
    q, v, s = (np.concatenate(x) for x in zip(*kept, strict=True))
    order = np.lexsort((v, -s, q))
    q, v, s = q[order], v[order], s[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    return [x[rank < k] for x in (q, v, s)]


def exact_top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 10, scale: int = 1024,
    block: int = QUERY_BLOCK,
) -> DataFrame:
    """For each row of ``queries`` the ``k`` rows of ``vectors`` with the largest inner product.

    Both frames hold (vec_id, embedding). A component x counts as floor(scale * x). Ties go to the
    smaller vec_id; a row with the query's own id is no candidate. A vector that is NULL or holds a
    NULL or non-finite component, and a row without an id, takes no part. Vectors of different
    lengths have no score; fewer candidates than ``k`` are all returned; repeated candidate rows
    each count; a repeated query id is answered once, for its first row by content. No rows give
    no rows. Only ``block`` queries pass the driver at a time.
    """
    spark = vectors.sparkSession
    pairs = vectors.select(F.col("vec_id").cast("long"), F.col("embedding"))
    asked = (
        queries.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding"))
        .where("vec_id is not null and embedding is not null")
        .groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    )
    out, rows = None, []
    local = asked.toLocalIterator()
    while True:
        row = next(local, None)
        if row is not None:
            rows.append(row)
        if rows and (row is None or len(rows) == block):
            part = _block_top_k(spark, pairs, _Block(rows, scale), k, scale)
            out, rows = part if out is None else out.union(part), []
        if row is None:
            break
    if out is None:
        out = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return out


def _block_top_k(spark, pairs: DataFrame, block: _Block, k: int, scale: int) -> DataFrame:
    sent = spark.sparkContext.broadcast(block)
    n = len(block.ids)

    def extent(batches):
        low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).min)
        for batch in batches:
            for numbers, _, s, own in sent.value.scored(batch, scale):
                low[numbers] = np.minimum(
                    low[numbers], np.where(own, np.iinfo(np.int64).max, s).min(axis=1))
                high[numbers] = np.maximum(
                    high[numbers], np.where(own, np.iinfo(np.int64).min, s).max(axis=1))
        seen = np.flatnonzero(low <= high)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int64()), pa.array(low[seen]), pa.array(high[seen])], ["q", "l", "h"]
        )

    found = (
        pairs.mapInArrow(extent, "q long, l long, h long")
        .groupBy("q").agg(F.min("l").alias("l"), F.max("h").alias("h")).collect()
    )
    low, high = np.zeros(n, np.int64), np.zeros(n, np.int64)  # bounded by the block
    for q, a, b in found:
        low[q], high[q] = a, b
    above = np.zeros(n, np.int64)
    width = 1
    while found and width * BINS < int((high - low).max()) + 1:
        width *= BINS
    while found and width:
        state = spark.sparkContext.broadcast((low.copy(), above.copy()))
        low, above = _refine(spark, pairs, sent, state, width, k, scale, n)
        state.unpersist()
        width = 0 if width == 1 else width // BINS
    limits = spark.sparkContext.broadcast(low)

    def reaching(batches):
        kept: list = []
        for batch in batches:
            for numbers, ids, s, own in sent.value.scored(batch, scale):
                i, j = np.nonzero((s >= limits.value[numbers][:, None]) & ~own)
                kept.append((numbers[i], ids[j], s[i, j]))
            if kept:  # ties beyond the k smallest ids of this task can't be among the result
                kept = [tuple(_merge_top(kept, k))]
        if kept:
            q, v, s = kept[0]
            ids = np.array(sent.value.ids, np.int64)[q]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in (ids, v, s)], ["query_id", "vec_id", "score"])

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        pairs.mapInArrow(reaching, "query_id long, vec_id long, score long")
        .withColumn("rank", F.row_number().over(best).cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _refine(spark, pairs, sent, state, width: int, k: int, scale: int, n: int):
    """One round: the bin of ``width`` that holds the k-th score, and the scores above that bin."""

    def counted(batches):
        low, above = state.value
        total = np.zeros((n, BINS), np.int64)
        for batch in batches:
            for numbers, _, s, own in sent.value.scored(batch, scale):
                bins = (s - low[numbers][:, None]) // width
                i, j = np.nonzero((bins >= 0) & (bins < BINS) & ~own)
                total[numbers] += np.bincount(
                    i * BINS + bins[i, j], minlength=len(numbers) * BINS).reshape(-1, BINS)
        over = total[:, ::-1].cumsum(axis=1)[:, ::-1] - total  # scores in higher bins
        q, b = np.nonzero((total > 0) & (over + above[:, None] < k))  # others can't hold it
        yield pa.RecordBatch.from_arrays(
            [pa.array(q, pa.int64()), pa.array(b, pa.int64()), pa.array(total[q, b])],
            ["q", "b", "c"])

    down = Window.partitionBy("q").orderBy(F.desc("b"))
    rows = (
        pairs.mapInArrow(counted, "q long, b long, c long")
        .groupBy("q", "b").agg(F.sum("c").alias("c"))
        .withColumn("n", F.sum("c").over(down.rowsBetween(Window.unboundedPreceding, 0)))
        .where(F.col("n") - F.col("c") < k)  # at most k bins a query
        .groupBy("q").agg(F.collect_list(F.struct("b", "c", "n")).alias("bins"))
        .collect()
    )
    low, above = (x.copy() for x in state.value)
    for q, bins in rows:
        bins = sorted(bins, reverse=True)
        hit = next((x for x in bins if above[q] + x.n >= k), bins[-1])
        low[q] += hit.b * width
        above[q] += hit.n - hit.c
    return low, above
