"""Removal of word sequences that occur earlier in the corpus, by prefix-partitioned suffix trees.

Suffixes (every position from which ``window`` words of a document follow) are split into groups by
a prefix of variable length: a suffix whose first word is rare is grouped by that word, one that
starts with frequent words by as many words as make the expected group small. A group's suffixes
are sorted by their ``window``-word path, which lays out the deep part of the group's suffix tree:
neighbours with equal paths are the leaves of one internal node at that depth. All leaves of such a
node but the earliest start a repeated window; overlapping windows merge into maximal repeats.

Work is dealt in chunks of whole documents. A chunk sends each different window once, to the
group that owns it, and gets back which of them occur earlier elsewhere.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm import tokens
from pitchlake.llm.common import in_chunks

WINDOW = 20
#: Word classes of the prefix statistics: a fixed number, whatever the corpus.
BUCKETS = 1 << 16
#: Suffixes that a prefix may have, as far as word frequencies tell.
GROUP_SUFFIXES = 50_000

#: Bytes of text in a chunk on average. A task holds a few arrays of eight bytes a word of one chunk.
CHUNK_CHARS = 9_000_000

_U = np.uint64


def word_statistics(docs: DataFrame) -> tuple[np.ndarray, int]:
    """(words of all documents by hash class, bytes of all texts)."""

    def count(batches):
        total, size = np.zeros(BUCKETS, np.int64), 0
        for batch in tokens.pieces(batches):
            words = tokens.split(batch.column(0))
            size += len(words.bytes)
            total += np.bincount(
                (tokens.hashes(words) % _U(BUCKETS)).astype(np.int64), minlength=BUCKETS)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(seen, -1)), pa.array(np.append(total[seen], size))], ["b", "n"])

    rows = (
        docs.select(F.col("text").cast("string")).mapInArrow(count, "b long, n long")
        .groupBy("b").agg(F.sum("n").alias("n")).collect()
    )
    counts, size = np.zeros(BUCKETS, np.int64), 0
    for b, n in rows:
        if b < 0:
            size = n
        else:
            counts[b] = n
    return counts, size


class _Chunk:
    """Documents of a chunk in order of (id, text hash), their words and windows."""

    def __init__(self, table: pa.Table, window: int):
        ids = table.column("doc_id").combine_chunks()
        self.missing = ids.is_null().to_numpy(zero_copy_only=False)
        key = ids.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
        digest = table.column("digest").to_numpy()
        order = np.lexsort((digest, key))
        self.key = key[order]
        self.missing = self.missing[order]
        texts = table.column("text").combine_chunks().cast(pa.large_string()).take(pa.array(order))
        self.words = tokens.split(texts)
        self.word_hashes = tokens.hashes(self.words)
        self.starts = tokens.window_starts(self.words.first, window)
        self.paths = tokens.window_hashes(self.word_hashes, window)[self.starts]
        # Equal windows side by side, the earliest first: only that one has to be sent.
        self.order = np.argsort(self.paths, kind="stable")
        sorted_paths = self.paths[self.order]
        self.new = np.ones(len(self.order), bool)
        self.new[1:] = sorted_paths[1:] != sorted_paths[:-1]

    def firsts(self) -> np.ndarray:
        """Indexes into ``starts`` of each window's earliest place in this chunk, ascending."""
        return np.sort(self.order[self.new])


def _prefix_groups(chunk: _Chunk, at: np.ndarray, share: np.ndarray, allowed: float, window: int):
    """The group key of each suffix: a hash of as many words as its frequencies ask for."""
    classes = (chunk.word_hashes % _U(BUCKETS)).astype(np.int64)
    rest, word = np.arange(len(at)), chunk.starts[at]
    expected, key = np.ones(len(at)), np.zeros(len(at), np.uint64)
    for depth in range(window):
        here = word[rest] + depth
        expected[rest] *= share[classes[here]]
        key[rest] = (key[rest] ^ chunk.word_hashes[here]) * _U(0x9E3779B97F4A7C15) + _U(1)
        rest = rest[expected[rest] > allowed]
        if not len(rest):
            break
    return tokens.mix(key)


def _pack(paths: np.ndarray, at: np.ndarray, chunk: _Chunk) -> bytes:
    """Windows of one group: their paths, and compressed their places as steps and documents."""
    doc = np.searchsorted(chunk.words.first, chunk.starts[at], "right") - 1
    docs, first = np.unique(doc, return_index=True)
    small = b"".join((
        np.diff(at, prepend=0).astype(np.uint32).tobytes(),
        np.diff(first, append=len(at)).astype(np.uint32).tobytes(),
        np.diff(chunk.key[docs], prepend=0).tobytes()))
    sizes = np.array([len(at), len(docs), len(small)], np.int64)
    return sizes.tobytes() + paths.tobytes() + pa.compress(small, "zstd", asbytes=True)


def _unpack(data: bytes):
    n, d, size = np.frombuffer(data, np.int64, 3).tolist()
    paths = np.frombuffer(data, np.uint64, n, 24)
    small = pa.decompress(data[24 + 8 * n :], size, "zstd", asbytes=True)
    steps = np.frombuffer(small, np.uint32, n)
    counts = np.frombuffer(small, np.uint32, d, 4 * n)
    keys = np.frombuffer(small[4 * (n + d) :], np.int64)
    return np.cumsum(steps, dtype=np.int64), paths, counts, np.cumsum(keys)


def _repeats_in_group(chunks: list[int], data: list[bytes]) -> list[np.ndarray]:
    """For each chunk's windows of one group: the places whose window starts earlier elsewhere."""
    parts = [_unpack(x) for x in data]
    paths = np.concatenate([p[1] for p in parts])
    order = np.argsort(paths, kind="stable")
    same = paths[order][1:] == paths[order][:-1]
    inner = np.concatenate((same, [False])) | np.concatenate(([False], same))
    leaves = order[inner]  # leaves of internal nodes at full depth
    keys = np.concatenate([np.repeat(p[3], p[2]) for p in parts])[leaves]
    owner = np.repeat(chunks, [len(p[1]) for p in parts])[leaves]
    by = np.lexsort((owner, keys, paths[leaves]))
    node = paths[leaves][by]
    later = np.zeros(len(paths), bool)
    later[leaves[by[1:]]] = node[1:] == node[:-1]
    cuts = np.cumsum([0] + [len(p[1]) for p in parts])
    return [p[0][later[a:b]] for p, a, b in zip(parts, cuts[:-1], cuts[1:], strict=True)]


def _kept(chunk: _Chunk, later: np.ndarray, window: int):
    """(removed words, kept text) from the windows that start earlier in another chunk."""
    flagged = np.zeros(len(chunk.starts), bool)
    flagged[later] = True
    # Later copies within the chunk, and all copies of what starts earlier elsewhere.
    leader = chunk.order[np.flatnonzero(chunk.new)][np.cumsum(chunk.new) - 1]
    flagged[chunk.order] = flagged[leader] | ~chunk.new
    words = chunk.words
    cover = np.zeros(len(words.start) + 1, np.int32)
    hit = chunk.starts[flagged]
    cover[hit] += 1  # starts are distinct
    cover[hit + window] -= 1
    removed = np.cumsum(cover[:-1]) > 0
    keep = ~removed
    length = (words.end - words.start)[keep] + 1
    to = np.cumsum(length)
    source = np.repeat(words.start[keep] - (to - length), length) + np.arange(to[-1] if len(to) else 0)
    data = np.append(words.bytes, np.uint8(32))[np.minimum(source, len(words.bytes))]
    data[to - 1] = 32
    ends = np.concatenate(([0], to))[np.concatenate(([0], np.cumsum(keep)))[words.first]]
    raw = data.tobytes()
    texts = [
        raw[a : b - 1] if b > a else b""
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)
    ]
    gone = np.concatenate(([0], np.cumsum(removed)))[words.first]
    # Maximal repeats: runs of removed words, cut where a document ends.
    inside = np.concatenate(([False], removed, [False]))
    border = words.first[1:-1]
    border = np.unique(border[inside[border] & inside[border + 1]])
    begin = np.sort(np.concatenate((np.flatnonzero(inside[1:] & ~inside[:-1]), border)))
    end = np.sort(np.concatenate((np.flatnonzero(~inside[1:] & inside[:-1]), border)))
    return np.diff(gone), texts, begin, end


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, chunk_chars: int = CHUNK_CHARS,
    group_suffixes: int = GROUP_SUFFIXES,
) -> DataFrame:
    """(doc_id, n_words, n_removed, text, repeats) for every row of ``docs``.

    A word goes if a window of ``window`` words covers it whose words also start earlier, in a
    document with a smaller id or before it in the same one. ``text`` holds the words that stay,
    joined by one space; ``repeats`` the removed maximal runs as flat word bounds. Windows are
    judged on the input. Words are ``[^\\x20\\x09-\\x0D]+`` as they are. NULL and empty texts have
    no words; rows without an id come last. Rows that share an id follow one another in the order
    of their texts' hashes, so of repeated rows one keeps its words. Other columns are not read.

    Windows are compared by 64-bit hashes of their words.
    """
    counts, size = word_statistics(docs)
    total = max(int(counts.sum()), 1)
    sent = docs.sparkSession.sparkContext.broadcast(counts / total)  # BUCKETS numbers
    allowed = group_suffixes / total
    n = int(size // chunk_chars) + 1
    chunks = in_chunks(docs, n).withColumn("digest", F.xxhash64("text"))

    def deal(key, table):
        chunk = _Chunk(table, window)
        at = chunk.firsts()
        group = (_prefix_groups(chunk, at, sent.value, allowed, window) % _U(n)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        cuts = np.searchsorted(group[order], np.arange(n + 1))
        parts, data = [], []
        for g in range(n):
            own = at[order[cuts[g] : cuts[g + 1]]]
            if len(own):
                parts.append(g)
                data.append(_pack(chunk.paths[own], own, chunk))
        return pa.table({
            "part": pa.array(parts, pa.int32()),
            "chunk": pa.array([key[0].as_py()] * len(parts), pa.int32()),
            "data": pa.array(data, pa.large_binary()).cast(pa.binary())})

    def match(table):
        found = _repeats_in_group(
            table.column("chunk").to_pylist(), table.column("data").to_pylist())
        return pa.table({
            "chunk": table.column("chunk"),
            "later": pa.array([x.astype(np.uint32).tobytes() for x in found], pa.binary())})

    def finish(left, right):
        chunk = _Chunk(left, window)
        later = [np.frombuffer(x, np.uint32) for x in right.column("later").to_pylist()]
        places = np.concatenate([np.zeros(0, np.uint32), *later]).astype(np.int64)
        removed, texts, begin, end = _kept(chunk, places, window)
        first = chunk.words.first
        row = np.searchsorted(first, begin, "right") - 1
        bounds = np.stack((begin - first[row], end - first[row]), axis=1).ravel()
        offsets = np.searchsorted(row, np.arange(len(first))) * 2
        return pa.table({
            "doc_id": pa.array(chunk.key, pa.int64(), mask=chunk.missing),
            "n_words": pa.array(chunk.words.counts, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "text": pa.array(texts, pa.binary()).cast(pa.string()),
            "repeats": pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.array(bounds, pa.int64()))})

    later = (
        chunks.groupBy("chunk").applyInArrow(deal, "part int, chunk int, data binary")
        .groupBy("part").applyInArrow(match, "chunk int, later binary")
    )
    return chunks.groupBy("chunk").cogroup(later.groupBy("chunk")).applyInArrow(
        finish, "doc_id long, n_words long, n_removed long, text string, repeats array<long>")


def digest(kept: DataFrame) -> DataFrame:
    """The contract's columns from ``remove_repeats``."""
    return kept.select(
        "doc_id", "n_words", "n_removed",
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
