"""Hard negatives by exact products of anchor and candidate tiles.

Candidates are packed into blocks where they are read, anchors into blocks by a hash of their id.
Both are dealt to a grid of anchor groups and candidate parts. A cell is one task: it holds the
blocks of its anchors and reads the candidates past them. A tile is an anchor block with a part of a
candidate block; its scores come from Strassen's recursive multiplication on whole numbers. Two
passes over the tiles keep small heaps, merged until one is left for an anchor: first its best rows
of its own label, then, for each of these positives, the best rows of other labels inside a window
of scores below it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.llm.common import materialise

#: Rows of an anchor block and of a candidate block, and candidates that are scored at a time.
ANCHORS, CANDIDATES, SCORED = 1024, 4096, 1024
#: Components of the anchors that a task holds, and parts of the candidates on a small cluster.
HELD, PARTS = 4_000_000, 64
#: Matrices with a side up to this are multiplied directly.
LEAF = 32


def _leaf(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of two int64 matrices; in doubles while no sum can pass 2^53."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if bound < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def multiply(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Strassen's product of int64 matrices of any shape, sides padded with zeros to even ones.

    Sums wrap around at 2^64, and so does their end: a product that fits into int64 is exact even if
    sums on the way to it don't.
    """
    (m, d), n = a.shape, b.shape[1]
    if min(m, d, n) <= leaf:
        return _leaf(a, b)
    a = np.pad(a, ((0, m % 2), (0, d % 2)))
    b = np.pad(b, ((0, d % 2), (0, n % 2)))
    i, k, j = (x // 2 for x in (a.shape[0], a.shape[1], b.shape[1]))
    a11, a12, a21, a22 = a[:i, :k], a[:i, k:], a[i:, :k], a[i:, k:]
    b11, b12, b21, b22 = b[:k, :j], b[:k, j:], b[k:, :j], b[k:, j:]
    p1 = multiply(a11 + a22, b11 + b22, leaf)
    p2 = multiply(a21 + a22, b11, leaf)
    p3 = multiply(a11, b12 - b22, leaf)
    p4 = multiply(a22, b21 - b11, leaf)
    p5 = multiply(a11 + a12, b22, leaf)
    p6 = multiply(a21 - a11, b11 + b12, leaf)
    p7 = multiply(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * j), np.int64)
    out[:i, :j] = p1 + p4 - p5 + p7
    out[:i, j:] = p3 + p5
    out[i:, :j] = p2 + p4
    out[i:, j:] = p1 - p2 + p3 + p6
    return out[:m, :n]


# --- blocks ---------------------------------------------------------------------------------------

BLOCK = "dim int, ids binary, labels binary, cells binary"


def _usable(df: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) of the rows that take part, components as doubles."""
    return df.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    ).where("vec_id is not null and label is not null and embedding is not null").where(
        F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def _cells(vectors: pa.Array, scale: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, row numbers, matrix) of the floored components, for each dimension."""
    vectors = vectors.cast(pa.large_list(pa.float64()))
    lengths = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    begin = np.cumsum(lengths) - lengths
    for dim in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == dim)
        matrix = values[begin[rows][:, None] + np.arange(dim)]
        yield int(dim), rows, np.floor(scale * matrix).astype(np.int64)


def _packed(dim: int, ids: np.ndarray, labels: np.ndarray, cells: np.ndarray) -> list:
    """One block as Arrow values, its rows by id, components as wide as the largest one."""
    order = np.argsort(ids, kind="stable")
    low, high = cells.min(initial=0), cells.max(initial=0)
    kind = next(t for t in (np.int16, np.int32, np.int64)
                if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    return [dim, ids[order].tobytes(), labels[order].tobytes(), cells[order].astype(kind).tobytes()]


def _unpacked(ids: np.ndarray, dim: int, cells: pa.Buffer) -> np.ndarray:
    """The components of a packed block, a row for each id."""
    return np.frombuffer(cells, f"i{cells.size // (len(ids) * dim)}").astype(np.int64).reshape(-1, dim)


def _table(rows: list, names: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [x.split() for x in names.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kinds[kind]) for i, (_, kind) in enumerate(fields)],
        [name for name, _ in fields])


def _candidate_blocks(vectors: DataFrame, scale: int, block: int) -> DataFrame:
    """Blocks of up to ``block`` rows, packed by the tasks that read them."""

    def pack(batches):
        held: dict[int, list] = {}
        for batch in batches:
            ids, labels = (batch.column(i).to_numpy() for i in (0, 1))
            for dim, rows, cells in _cells(batch.column(2), scale):
                own = held.setdefault(dim, [])
                own.append((ids[rows], labels[rows], cells))
                if sum(len(x[0]) for x in own) >= block:
                    ids_, labels_, cells_ = (np.concatenate(x) for x in zip(*own, strict=True))
                    whole = len(ids_) - len(ids_) % block
                    for at in range(0, whole, block):
                        to = at + block
                        yield _table(
                            [_packed(dim, ids_[at:to], labels_[at:to], cells_[at:to])], BLOCK)
                    held[dim] = [(ids_[whole:], labels_[whole:], cells_[whole:])]
        rest = [_packed(dim, *(np.concatenate(x) for x in zip(*own, strict=True)))
                for dim, own in held.items() if sum(len(x[0]) for x in own)]
        if rest:
            yield _table(rest, BLOCK)

    return vectors.mapInArrow(pack, BLOCK)


def _anchor_blocks(anchors: DataFrame, scale: int, blocks: int) -> DataFrame:
    """One row for each block and dimension; ``limits`` holds the positives' scores of a row."""

    def pack(key, table):
        ids, labels = (table.column(c).to_numpy() for c in ("vec_id", "label"))
        scores = table.column("scores").combine_chunks()
        bounds = scores.offsets.to_numpy() - scores.offsets[0].as_py()
        many, flat = np.diff(bounds), scores.flatten().to_numpy()
        out = []
        for dim, rows, cells in _cells(table.column("embedding").combine_chunks(), scale):
            wide = np.zeros((len(rows), int(many[rows].max(initial=0)) + 1), np.int64)
            wide[:, 0] = many[rows]
            for n, r in enumerate(rows):
                wide[n, 1 : 1 + many[r]] = flat[bounds[r] : bounds[r + 1]]
            order = np.argsort(ids[rows], kind="stable")
            out.append([key[0].as_py(), *_packed(dim, ids[rows], labels[rows], cells),
                        wide[order].tobytes()])
        return pa.Table.from_batches([_table(out, f"anchor_block int, {BLOCK}, limits binary")])

    return (
        anchors.withColumn("anchor_block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
        .groupBy("anchor_block").applyInArrow(
            pack, f"anchor_block int, {BLOCK}, limits binary"))


GRID = f"cell int, block int, {BLOCK}, limits binary"


def _grid(anchors: DataFrame, groups: int, candidates: DataFrame, parts: int) -> DataFrame:
    """Each anchor block with all candidates of its dimension; a cell is a task, anchors first.

    An anchor block goes to every part of the candidates, a candidate block to every group of anchor
    blocks. Nothing is joined: copies of blocks are many times as large as the tables they come
    from, and a broadcast chosen by the size of those would send the copies to the driver.
    """
    place = F.col("group") * parts + F.col("part")
    left = anchors.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn(
        "group", F.pmod("anchor_block", F.lit(groups)))
    right = candidates.withColumn(
        "group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn(
        "part", F.pmod(F.xxhash64("ids"), F.lit(parts)))
    rows = left.select(
        place.cast("int").alias("cell"), F.col("anchor_block").alias("block"), "dim", "ids",
        "labels", "cells", "limits",
    ).unionByName(right.select(
        place.cast("int").alias("cell"), F.lit(None).cast("int").alias("block"), "dim", "ids",
        "labels", "cells", F.lit(None).cast("binary").alias("limits")))
    return rows.repartitionById(groups * parts, "cell").sortWithinPartitions(
        "cell", F.asc_nulls_last("block"))


#: Below and above all scores.
NONE, ALL = np.iinfo(np.int64).min, np.iinfo(np.int64).max


class _Anchors:
    """An anchor block and its heaps: the ``k`` best partners of a row inside each of its windows.

    ``least`` and ``most`` hold the bounds of the windows, a row for each anchor. Partners are of the
    anchor's own label or of other ones.
    """

    def __init__(
        self, ids: np.ndarray, labels: np.ndarray, cells: np.ndarray,
        windows: tuple[np.ndarray, np.ndarray], same: bool, k: int,
    ):
        self.ids, self.labels, self.cells, self.same, self.k = ids, labels, cells, same, k
        least, most = windows
        empty = least > most
        # Also the score of a full heap's last row, which a later row has to reach.
        self.least, self.most = np.where(empty, ALL, least), np.where(empty, NONE, most)
        none = np.zeros(0, np.int64)
        self.heaps = [(none, none, none)] * least.shape[1]  # (row, id, score)

    def meet(self, ids: np.ndarray, labels: np.ndarray, cells: np.ndarray) -> None:
        """Put the rows of a part of a candidate block into the heaps."""
        scores = multiply(self.cells, np.ascontiguousarray(cells.T))
        row, at = np.nonzero((scores >= self.least.min(axis=1, initial=ALL)[:, None])
                             & (scores <= self.most.max(axis=1, initial=NONE)[:, None]))
        partner = ((labels[at] == self.labels[row]) == self.same) & (ids[at] != self.ids[row])
        row, at = row[partner], at[partner]
        found = scores[row, at]
        for n in range(len(self.heaps)):
            fit = np.flatnonzero((found >= self.least[row, n]) & (found <= self.most[row, n]))
            if len(fit) > 8 * self.k * len(self.ids) and len(ids) > self.k:
                # Before many rows are sorted, those below the k-th score of this part go.
                dense = np.full(scores.shape, NONE)
                dense[row[fit], at[fit]] = found[fit]
                kth = np.partition(dense, len(ids) - self.k, axis=1)[:, len(ids) - self.k]
                fit = fit[found[fit] >= kth[row[fit]]]
            if len(fit):
                self._merge(n, row[fit], ids[at[fit]], found[fit])

    def _merge(self, n: int, *rows: np.ndarray) -> None:
        row, ids, score = (np.concatenate(x) for x in zip(self.heaps[n], rows, strict=True))
        order = np.lexsort((ids, -score, row))
        row, ids, score = row[order], ids[order], score[order]
        many = np.bincount(row, minlength=len(self.ids))
        place = np.arange(len(row)) - (np.cumsum(many) - many)[row]
        last = place == self.k - 1
        self.least[row[last], n] = np.maximum(self.least[row[last], n], score[last])
        self.heaps[n] = tuple(x[place < self.k] for x in (row, ids, score))

    def rows(self) -> pa.RecordBatch:
        place = np.repeat(np.arange(len(self.heaps)), [len(h[0]) for h in self.heaps])
        row, ids, score = (np.concatenate(x) for x in zip(*self.heaps, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (self.ids[row], place, ids, score)],
            ["anchor_id", "place", "vec_id", "score"])


HEAP = "anchor_id long, place long, vec_id long, score long"


def _heaps(windows, same: bool, k: int):
    """The heaps of each cell; ``windows(limits)`` gives the bounds of its anchors' windows."""

    def run(batches):
        cell, held = None, {}
        for batch in batches:
            for n in range(batch.num_rows):
                own, block, dim = (batch.column(c)[n].as_py() for c in ("cell", "block", "dim"))
                read = lambda c: batch.column(c)[n].as_buffer()  # noqa: B023, E731 - used at once
                ids, labels = (np.frombuffer(read(c), np.int64) for c in ("ids", "labels"))
                cells = _unpacked(ids, dim, read("cells"))
                if own != cell:
                    yield from (a.rows() for x in held.values() for a in x if a.heaps)
                    cell, held = own, {}
                if block is not None:
                    limits = np.frombuffer(read("limits"), np.int64).reshape(len(ids), -1)
                    held.setdefault(dim, []).append(
                        _Anchors(ids, labels, cells, windows(limits), same, k))
                    continue
                for anchors in held.get(dim, ()):
                    for at in range(0, len(ids), SCORED):
                        part = slice(at, at + SCORED)
                        anchors.meet(ids[part], labels[part], cells[part])
        yield from (a.rows() for x in held.values() for a in x if a.heaps)

    return run


def _best(grid: DataFrame, windows, same: bool, k: int) -> DataFrame:
    """(anchor_id, place, vec_id, score, rank): the heaps of all cells merged."""
    order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "vec_id")
    return grid.mapInArrow(_heaps(windows, same, k), HEAP).withColumn(
        "rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3,
    window: tuple[int, int] = (50, 95), scale: int = 256, anchor_block: int = ANCHORS,
    candidate_block: int = CANDIDATES, held: int = HELD,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) rows.

    Both frames hold (vec_id, embedding, label). A component x counts as floor(scale * x); a score
    is the inner product with the anchor, larger ones first, ties by smaller vec_id. An anchor's
    positives are its first ``positives`` rows of its own label. For each of them, the first
    ``negatives`` rows of other labels whose score lies within ``window`` per cent of the positive's
    are returned, all if there are fewer; an anchor or positive without any gives no row.

    Rows with a NULL id, label or vector, or a NULL or non-finite component, take no part. A row
    with the anchor's own id is no partner of it. Vectors of different lengths have no score, empty
    ones neither. Repeated candidate rows each count, so a repeated positive gives its rows again; a
    repeated anchor id is answered once, for its first row by content. Scores are exact while they
    fit into a long. No rows give no rows; other columns are not read.
    """
    low, high = window
    blocks = _usable(vectors)
    packed = materialise(_candidate_blocks(blocks, scale, candidate_block), "candidates")
    asked = materialise(
        _usable(anchors).groupBy("vec_id").agg(F.min(F.struct("embedding", "label")).alias("row"))
        .select("vec_id", "row.*"), "anchors")
    size = asked.agg(F.count(F.lit(1)), F.sum(F.size("embedding"))).first()
    many = size[0] // anchor_block + 1
    groups = min(many, (size[1] or 0) // held + 1)
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    parts = min(packed.count(), max(PARTS, 2 * cores)) or 1

    def closest(limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.full((len(limits), 1), NONE), np.full((len(limits), 1), ALL)

    def below(limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # 50 * top <= 100 * score <= 95 * top without a product that could overflow
        known = np.arange(limits.shape[1] - 1) < limits[:, :1]
        least = [[-(-low * int(x) // 100) for x in tops] for tops in limits[:, 1:]]
        most = [[high * int(x) // 100 for x in tops] for tops in limits[:, 1:]]
        least, most = (np.array(x, np.int64).reshape(known.shape) for x in (least, most))
        return np.where(known, least, ALL), np.where(known, most, NONE)

    none = F.array().cast("array<long>")
    first = _grid(_anchor_blocks(asked.withColumn("scores", none), scale, many), groups, packed,
                  parts)
    near = materialise(_best(first, closest, True, positives), "positives")

    # At most ``positives`` scores an anchor.
    scores = near.groupBy("anchor_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("best")).select(
        F.col("anchor_id").alias("vec_id"), F.col("best.score").alias("scores"))
    second = _grid(_anchor_blocks(asked.join(scores.hint("merge"), "vec_id"), scale, many), groups,
                   packed, parts)
    mined = _best(second, below, False, negatives).select(
        "anchor_id", (F.col("place") + 1).cast("int").alias("place"), "rank",
        F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return mined.join(
        near.select("anchor_id", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"),
                    F.col("score").alias("positive_score")).hint("merge"), ["anchor_id", "place"],
    ).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
