"""SimHash near duplicates by fuzzy keys from the binary Golay code.

The perfect (23, 12) code has exactly one codeword within 3 bits of every 23-bit word. A word's keys
are the codewords to which the word and its 23 neighbours at one bit decode: one key within 2 bits
of a codeword, six otherwise. Two words at 2 bits or less have a neighbour in common, and so a key.

A fingerprint is cut into three segments. Four differing bits leave either a segment as it is, and
then at most two of them are in one of the other two segments, or one or two in each of the three.
So two linked fingerprints meet in a bucket of (equal segment, a key of another) or of keys of all
three segments, 33 to 36 bits that unrelated fingerprints seldom share; there the XOR decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm import tokens
from pitchlake.llm.common import materialise
from pitchlake.llm.neardup import components

SHINGLE = 4
MOST_BITS = 4
#: (shift, bits) of the segments of a fingerprint; each is a 23-bit word with zeros above.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: (equal segment, segment of which a key is taken).
SEGMENT_PAIRS = ((0, 1), (0, 2), (1, 0), (1, 2), (2, 0), (2, 1))
#: Fingerprints of a bucket that meet as many others in one cell.
BLOCK = 4096
#: Buckets up to this size are compared many at a time.
SMALL = 24

U = np.uint64
#: The Golay code's generator polynomial, and the constants of XXH64.
GENERATOR = 0b1100_0111_0101
PRIME_1, PRIME_2, PRIME_3, PRIME_4, PRIME_5 = (
    U(0x9E3779B185EBCA87), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9), U(0x85EBCA77C2B2AE63),
    U(0x27D4EB2F165667C5))


# --- fingerprints ---------------------------------------------------------------------------------


def _rotate(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << U(bits)) | (x >> U(64 - bits))


def _round(state: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotate(state + lane * PRIME_2, 31) * PRIME_1


def _word(data: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """The little-endian numbers of ``size`` bytes that start at ``at``."""
    return np.lib.stride_tricks.sliding_window_view(data, size)[at].view(f"<u{size}")[:, 0]


def xxh64(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of the byte strings data[start:end], all at once."""
    length, at = (end - start).astype(np.uint64), start.copy()
    begin = np.full(1, seed, np.uint64)  # an array, as numbers alone warn when they wrap around
    h = np.repeat(begin + PRIME_5, len(start))
    rows = np.flatnonzero(length >= U(32))
    if len(rows):
        state = [np.repeat(x, len(rows)) for x in (
            begin + PRIME_1 + PRIME_2, begin + PRIME_2, begin, begin - PRIME_1)]
        live = np.arange(len(rows))
        while len(live):
            for lane in range(4):
                state[lane][live] = _round(
                    state[lane][live], _word(data, at[rows[live]] + 8 * lane, 8))
            at[rows[live]] += 32
            live = live[end[rows[live]] - at[rows[live]] >= 32]
        merged = sum(_rotate(x, bits) for x, bits in zip(state, (1, 7, 12, 18), strict=True))
        for x in state:
            merged = (merged ^ _round(U(0), x)) * PRIME_1 + PRIME_4
        h[rows] = merged
    h += length
    for size, add, bits, multiply, plus in (
        (8, None, 27, PRIME_1, PRIME_4), (4, PRIME_1, 23, PRIME_2, PRIME_3),
        (1, PRIME_5, 11, PRIME_1, U(0)),
    ):
        live = np.flatnonzero(end - at >= size)
        while len(live):
            x = _word(data, at[live], size).astype(np.uint64)
            x = _round(U(0), x) if add is None else x * add
            h[live] = _rotate(h[live] ^ x, bits) * multiply + plus
            at[live] += size
            live = live[end[live] - at[live] >= size]
    h ^= h >> U(33)
    h *= PRIME_2
    h ^= h >> U(29)
    h *= PRIME_3
    return h ^ (h >> U(32))


def _joined(words: tokens.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends) of the words in one stream with one space after each."""
    lengths = words.end - words.start
    starts = np.zeros(len(lengths), np.int64)
    np.cumsum(lengths[:-1] + 1, out=starts[1:])
    out = np.full(int(lengths.sum()) + len(lengths) + 8, 32, np.uint8)
    inside = np.repeat(starts, lengths) + (
        np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths))
    from_ = np.repeat(words.start, lengths) + (inside - np.repeat(starts, lengths))
    out[inside] = words.bytes[from_]
    return out, starts, starts + lengths


#: A byte's bits as the bytes of a number, so that sums of up to 255 of them count all at once.
_SPREAD = np.unpackbits(
    np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]


def majority(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per row of ``counts`` hashes, the bits that are set in over half of them."""
    out = np.zeros(len(counts), np.uint64)
    rows = np.flatnonzero(counts)
    if not len(rows):
        return out
    counts = counts[rows]
    parts = -(-counts // 255)
    first = np.cumsum(parts) - parts
    within = np.arange(parts.sum()) - np.repeat(first, parts)
    starts = np.repeat(np.cumsum(counts) - counts, parts) + 255 * within
    octets = h.view(np.uint8).reshape(-1, 8)
    bits = np.empty((len(rows), 64), bool)
    for k in range(8):
        sums = np.add.reduceat(_SPREAD[octets[:, k]], starts)
        sums = sums.view(np.uint8).reshape(-1, 8).astype(np.int64)
        bits[:, 8 * k : 8 * k + 8] = 2 * np.add.reduceat(sums, first, axis=0) > counts[:, None]
    out[rows] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def fingerprints(column: pa.Array, size: int = SHINGLE, seed: int = 42) -> np.ndarray:
    """The SimHash of each row's shingles of ``size`` words, repeats included."""
    words = tokens.split(column, tokens.SPACES, tokens.LOWER)
    counts = words.counts
    shingles = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    if not len(words.start):
        return np.zeros(len(counts), np.uint64)
    data, starts, ends = _joined(words)
    first = np.repeat(words.first[:-1] - (np.cumsum(shingles) - shingles), shingles) + np.arange(
        shingles.sum())
    last = first + np.repeat(np.minimum(counts, size), shingles) - 1
    return majority(xxh64(data, starts[first], ends[last], seed), shingles)


# --- keys -----------------------------------------------------------------------------------------


def _syndromes(words: np.ndarray) -> np.ndarray:
    """The remainders of 23-bit words by the generator polynomial."""
    rest = words.copy()
    for bit in range(22, 10, -1):
        rest ^= np.where(rest >> bit & 1, GENERATOR << (bit - 11), 0)
    return rest


def _corrections() -> np.ndarray:
    """The error of at most 3 bits for each syndrome."""
    one = 1 << np.arange(23)
    i, j, k = (x.ravel() for x in np.meshgrid(*[np.arange(24)] * 3))
    bits = np.append(one, 0)
    errors = np.unique(np.where((i < j) & (j < k) | (i == 23) | (j == 23) & (i < 23),
                                bits[i] | bits[j] | bits[k], 0))
    errors = errors[np.bitwise_count(errors) <= 3]
    out = np.zeros(2048, np.int64)
    out[_syndromes(errors)] = errors
    return out


def _changes() -> tuple[np.ndarray, np.ndarray]:
    """(changes, number) per syndrome: what leads a word to each codeword of its keys."""
    fix = _corrections()
    flips = np.append(0, 1 << np.arange(23))
    changes = flips[None, :] ^ fix[np.arange(2048)[:, None] ^ _syndromes(flips)[None, :]]
    changes.sort(axis=1)
    new = np.ones(changes.shape, bool)
    new[:, 1:] = changes[:, 1:] != changes[:, :-1]
    number = new.sum(axis=1)
    out = np.zeros((2048, int(number.max())), np.int64)
    where, _ = np.nonzero(new)
    out[where, (np.cumsum(new, axis=1) - 1)[new]] = changes[new]
    return out, number


_TABLES: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def segment_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, number): the codeword indices of each 23-bit word, as many as ``number`` says."""
    if not _TABLES:
        _TABLES["changes"] = _changes()
    changes, number = _TABLES["changes"]
    at = _syndromes(words)
    return (words[:, None] ^ changes[at]) >> 11, number[at]


def fuzzy_keys(fingerprint: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): the bucket keys of each fingerprint, 18 to 252 and about 180 on average."""
    words = [(fingerprint >> U(shift) & U((1 << bits) - 1)).astype(np.int64)
             for shift, bits in SEGMENTS]
    cut = [segment_keys(w) for w in words]
    used = [np.arange(keys.shape[1]) < number[:, None] for keys, number in cut]
    rows, keys = [], []
    for n, (same, other) in enumerate(SEGMENT_PAIRS):
        both = ((n << 36) | (words[same] << 12))[:, None] | cut[other][0]
        rows.append(np.nonzero(used[other])[0])
        keys.append(both[used[other]])
    three = cut[0][0][:, :, None, None] << 24 | cut[1][0][:, None, :, None] << 12 | (
        cut[2][0][:, None, None, :])
    fits = used[0][:, :, None, None] & used[1][:, None, :, None] & used[2][:, None, None, :]
    rows.append(np.nonzero(fits)[0])
    keys.append((len(SEGMENT_PAIRS) << 36) | three[fits])
    return np.concatenate(rows), np.concatenate(keys)


# --- links ----------------------------------------------------------------------------------------


def _bits_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def _small_groups(key: np.ndarray, fp: np.ndarray, most: int) -> np.ndarray:
    """For sorted keys, the index of the first row that each row reaches within its key."""
    n, first, second = len(key), [], []
    rows = np.arange(n)
    for step in range(1, n):
        rows = rows[rows + step < n]
        rows = rows[key[rows] == key[rows + step]]
        if not len(rows):
            break
        near = rows[_bits_apart(fp[rows], fp[rows + step]) <= most]
        first.append(near)
        second.append(near + step)
    root = np.arange(n)
    if first:
        a, b = np.concatenate(first), np.concatenate(second)
        while True:
            least = np.minimum(root[a], root[b])
            before = root.copy()
            np.minimum.at(root, a, least)
            np.minimum.at(root, b, least)
            root = root[root]
            if (root == before).all():
                break
    return root


def _large_group(fp: np.ndarray, most: int) -> np.ndarray:
    """As ``_small_groups`` for one large bucket: each row looks only at rows not reached yet."""
    root, rest = np.arange(len(fp)), np.arange(len(fp))
    while len(rest):
        origin, rest = rest[0], rest[1:]
        reached = [origin]
        while reached and len(rest):
            near = _bits_apart(fp[rest], fp[reached.pop()]) <= most
            if near.any():
                found, rest = rest[near], rest[~near]
                root[found] = origin
                reached.extend(found)
    return root


def _links(most: int):
    def emit(fp: np.ndarray, root: np.ndarray) -> pa.RecordBatch:
        moved = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays(
            [pa.array(fp[moved].view(np.int64)), pa.array(fp[root[moved]].view(np.int64))],
            ["a", "b"])

    def found(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Links of whole cells: columns key, cell and fingerprint, sorted."""
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
        cell = np.cumsum(new) - 1
        size = np.bincount(cell)
        fp = rows[:, 2].view(np.uint64)
        small = np.flatnonzero(size[cell] <= SMALL)
        if len(small):
            yield emit(fp[small], _small_groups(cell[small], fp[small], most))
        ends = np.cumsum(size)
        for c in np.flatnonzero(size > SMALL):
            part = fp[ends[c] - size[c] : ends[c]]
            yield emit(part, _large_group(part, most))

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 3), np.int64)
        for batch in batches:
            rows = np.column_stack([batch.column(i).to_numpy() for i in range(3)])
            rows = np.concatenate((held, np.ascontiguousarray(rows)))
            open_ = (rows[:, :2] == rows[-1, :2]).all(axis=1)  # the last cell may go on
            held, rows = rows[open_], rows[~open_]
            if len(rows):
                yield from found(rows)
        if len(held):
            yield from found(held)

    return links


def linked(nodes: DataFrame, most: int = MOST_BITS, block: int = BLOCK) -> DataFrame:
    """(a, b): links that join all of ``nodes`` (fp) within ``most`` (at most 4) differing bits.

    Within a cell of a bucket each fingerprint is led to the smallest one that it reaches there, so
    a cell of n fingerprints gives less than n links. A bucket of more than ``block`` fingerprints
    is cut into blocks, each two of which are a cell.
    """
    if most > MOST_BITS:
        raise ValueError(f"keys are shared up to {MOST_BITS} differing bits only")

    def deal(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy()
            for at in range(0, len(fp), 1024):
                rows, keys = fuzzy_keys(fp[at : at + 1024].view(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(fp[at : at + 1024][rows])], ["key", "fp"])

    # A fingerprint gives about 180 rows, so few of them make a task's worth.
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = nodes.select("fp").repartition(tasks, "fp").mapInArrow(deal, "key long, fp long")
    # Few buckets are large, so this side is small; all others are one cell.
    large = dealt.groupBy("key").agg(F.count("*").alias("crowd")).where(F.col("crowd") > block)
    blocks = F.coalesce(F.ceil(F.col("crowd") / block), F.lit(1).cast("long"))
    cells = (
        dealt.join(large, "key", "left").withColumn("blocks", blocks)
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("long"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("key", (F.least("own", "other") * F.col("blocks") + F.greatest("own", "other"))
                .alias("cell"), "fp"))
    return (
        cells.repartition("key", "cell").sortWithinPartitions("key", "cell", "fp")
        .mapInArrow(_links(most), "a long, b long").distinct())


def near_duplicates(
    docs: DataFrame, most: int = MOST_BITS, size: int = SHINGLE
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    A fingerprint's bit is set if it is set in over half of the XXH64 values (seed 42) of the text's
    shingles of ``size`` words in lower-case A-Z, repeats included; with fewer words the whole
    sequence is the only shingle. Fingerprints link at ``most`` or fewer differing bits, and
    ``component_id`` is the smallest id reachable over links. All links are found, whatever the size
    of a bucket.

    NULL, empty and wordless texts have the fingerprint 0, which links like any other. Repeated rows
    give repeated results. A row without an id takes part; its component's id is NULL only if no row
    there has one. Texts of any length are read whole. No rows give no rows; other columns are not
    read.
    """

    def sign(batches):
        for batch in tokens.pieces(batches, 4_000_000):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fingerprints(batch.column(1), size).view(np.int64))],
                ["doc_id", "fp"])

    signed = materialise(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                    F.col("text").cast("string").alias("text"))
        .mapInArrow(sign, "doc_id long, fp long"), "fingerprints")
    nodes = materialise(signed.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    labels = components(linked(nodes, most)).select(F.col("node").alias("fp"), "label")
    named = nodes.join(labels, "fp", "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label"))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    groups = named.join(least, "label").select("fp", "component_id")
    return signed.join(groups, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
