"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton accepts every run of words of every item. A document's words are streamed through
it; the state and the length of the longest match that ends at each word tell which item windows
end there. Items are taken in blocks of bounded size, one pass over the documents per block.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.llm import tokens

WINDOW = 13
#: Words of items in one automaton; it is built in each worker, at about 0.5 kB a word.
BLOCK_WORDS = 150_000


class SuffixAutomaton:
    """Generalised suffix automaton over integer words, one transition table per state."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, parent: int, word: int, target: int) -> int:
        """A copy of ``target`` for the shorter strings that reach it through ``parent``."""
        copy = self._state(self.length[parent] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while parent >= 0 and self.next[parent].get(word) == target:
            self.next[parent][word] = copy
            parent = self.link[parent]
        return copy

    def add(self, last: int, word: int) -> int:
        """Append ``word`` to the string that ended in ``last``; the new end."""
        target = self.next[last].get(word)
        if target is not None:
            whole = self.length[target] == self.length[last] + 1
            return target if whole else self._split(last, word, target)
        end = self._state(self.length[last] + 1, {}, 0)
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = end
            state = self.link[state]
        if state >= 0:
            target = self.next[state][word]
            whole = self.length[target] == self.length[state] + 1
            self.link[end] = target if whole else self._split(state, word, target)
        return end


class ItemMatcher:
    """The automaton of a block of items, with the items of every window at the state it ends in."""

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int):
        self.window = window
        self.words: dict[bytes, int] = {}
        self.machine = machine = SuffixAutomaton()
        coded = []
        for item, words in items:
            ids = [self.words.setdefault(w, len(self.words)) for w in words]
            coded.append((item, ids))
            last = 0
            for word in ids:
                last = machine.add(last, word)
        self.shortest = min((min(len(ids), window) for _, ids in coded if ids), default=window)
        lengths = {min(len(ids), window) for _, ids in coded if ids}
        #: state -> (window length, items) of the windows whose ends that state stands for.
        self.ends: dict[int, dict[int, set[int]]] = {}
        for item, ids in coded:
            size, state = min(len(ids), window), 0
            for at, word in enumerate(ids):
                state = machine.next[state][word]
                if at + 1 >= size > 0:
                    node = self._holder(state, size)
                    self.ends.setdefault(node, {}).setdefault(size, set()).add(item)
        self.sizes = sorted(lengths)
        self.chains: dict[int, list] = {}

    def _holder(self, state: int, size: int) -> int:
        """The state of the last ``size`` words of a match that ended in ``state``."""
        link, length = self.machine.link, self.machine.length
        while length[link[state]] >= size:
            state = link[state]
        return state

    def _chain(self, state: int) -> list:
        """(size, items) of all windows that are suffixes of the state's strings, longest first."""
        found = self.chains.get(state)
        if found is None:
            found, node = [], state
            while node > 0:
                sizes = self.ends.get(node)
                if sizes:
                    found.extend((n, sizes[n]) for n in sorted(sizes, reverse=True))
                node = self.machine.link[node]
            self.chains[state] = found
        return found

    def matches(self, ids: list[int]):
        """(end, window size, items) of every window that ends within a run of known words."""
        machine_next, link, length = self.machine.next, self.machine.link, self.machine.length
        state = matched = 0
        for at, word in enumerate(ids):
            to = machine_next[state].get(word)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = machine_next[state].get(word)
            if to is None:
                continue
            state, matched = to, matched + 1
            if matched >= self.shortest:
                for size, items in self._chain(state):
                    if size <= matched:
                        yield at + 1, size, items


#: A-Z become a-z, other ASCII characters that are no digit or letter become blanks.
_PLAIN = bytes(32 if tokens.NOT_ALNUM[tokens.LOWER[b]] else int(tokens.LOWER[b]) for b in range(256))


def _words(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


def _item_blocks(items: DataFrame, window: int, limit: int) -> DataFrame:
    """(block, item_id, words): items cut into pieces that share window - 1 words, then grouped.

    A piece holds limit / 8 words at most and every window lies whole in one. Blocks are chosen by
    hash among enough of them that one holds limit words with room for chance.
    """
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.filter(
        F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: F.length(w) > 0
    )
    piece = max(limit // 8, window)
    step = piece - window + 1
    cut = (
        items.where("text is not null and item_id is not null")
        .select(F.col("item_id").cast("long").alias("item_id"), words.alias("w"))
        .where(F.size("w") > 0)
        .select("item_id", "w", F.explode(F.sequence(
            F.lit(0), F.greatest(F.size("w") - window, F.lit(0)), F.lit(step))).alias("at"))
        .select("item_id", F.slice("w", F.col("at") + 1, piece).alias("words"))
    )
    total = cut.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks = 1 if total <= limit else int(total // (limit // 2)) + 1
    return cut.withColumn(
        "block", F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)).cast("int"))


def _scan_block(docs: DataFrame, pieces: list, window: int) -> DataFrame:
    """docs with the hits of one block appended: marked words as bounds, and items."""
    sent, at = docs.sparkSession.sparkContext.broadcast(pieces), docs.columns.index("text")

    def scan(batches):
        matcher = ItemMatcher([(i, [w.encode() for w in ws]) for i, ws in sent.value], window)
        known = matcher.words
        for batch in tokens.pieces(batches, 8_000_000):
            raw, offsets = tokens.column_bytes(batch.column(at))
            raw, counts, hits, items = raw.tobytes(), [], [], []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                codes = [known.get(w, -1) for w in _words(raw[a:b])]
                bounds, found = _row_hits(matcher, codes)
                counts.append(len(codes))
                hits.append(bounds)
                items.append(found)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(counts, pa.int64()),
                 pa.array(hits, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.int64()))],
                [*batch.schema.names, "__words", "__hits", "__items"])

    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    return docs.mapInArrow(scan, f"{schema}, __words long, __hits array<long>, __items array<long>")


def _row_hits(matcher: ItemMatcher, codes: list[int]) -> tuple[list[int], list[int]]:
    """Bounds of the words inside windows, as a flat list of starts and ends, and the items."""
    if len(codes) < matcher.shortest:
        return [], []
    array = np.array(codes)
    inside = np.concatenate(([False], array >= 0, [False]))
    starts = np.flatnonzero(inside[1:] & ~inside[:-1])
    ends = np.flatnonzero(~inside[1:] & inside[:-1])
    bounds: list[int] = []
    found: set[int] = set()
    for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
        if end - start < matcher.shortest:
            continue
        for to, size, items in matcher.matches(codes[start:end]):
            found |= items
            a, b = start + to - size, start + to
            while bounds and a <= bounds[-1]:  # overlaps or touches what came before
                a, b = min(a, bounds[-2]), max(b, bounds[-1])
                del bounds[-2:]
            bounds += [a, b]
    return bounds, sorted(found)


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, limit: int = BLOCK_WORDS
) -> DataFrame:
    """Rows of ``docs`` with what of them occurs in ``items``.

    Added: ``__words`` (number of words), ``__hits`` (starts and ends of word spans inside item
    windows, flat, in order, disjoint), ``__items`` (ids of the items with a window in the text).
    Words are runs of digits, letters a-z after lower-casing A-Z, and all non-ASCII characters. An
    item shorter than ``window`` words is one window; an item without words or id has none. NULL
    and empty texts have no words. Repeated rows and items change nothing; each row is judged by
    itself, whatever its other columns hold. Without items nothing is hit.

    Item words are sent to executors in blocks of at most about ``limit`` words, so the automaton's
    memory doesn't depend on the number of items; more items mean more passes over ``docs``.
    """
    blocks = _item_blocks(items, window, limit).repartition("block").sortWithinPartitions("block")
    out, current, pending = None, None, []
    for row in blocks.toLocalIterator():  # the driver holds one block at a time
        if pending and row.block != current:
            out, pending = _with_block(docs, out, pending, window), []
        current = row.block
        pending.append((row.item_id, row.words))
    return _with_block(docs, out, pending, window)


def _with_block(docs: DataFrame, out: DataFrame | None, pieces: list, window: int) -> DataFrame:
    """The hits found so far in ``out`` and those of one more block."""
    if out is None:
        return _scan_block(docs, pieces, window)
    previous = out.select(
        *docs.columns, F.col("__hits").alias("__old_hits"), F.col("__items").alias("__old_items"))
    return _scan_block(previous, pieces, window).select(
        *docs.columns, "__words",
        _merged("__old_hits", "__hits").alias("__hits"),
        F.array_sort(F.array_union("__old_items", "__items")).alias("__items"))


def _merged(left: str, right: str) -> Column:
    """Union of two flat lists of disjoint spans."""
    def pairs(c):
        return F.transform(
            F.filter(F.sequence(F.lit(0), F.size(c)), lambda i: (i % 2 == 0) & (i < F.size(c))),
            lambda i: F.struct(F.get(c, i).alias("a"), F.get(c, i + 1).alias("b")))

    spans = F.array_sort(F.concat(pairs(F.col(left)), pairs(F.col(right))))
    joined = F.aggregate(
        spans, F.array().cast("array<long>"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (s["a"] <= F.try_element_at(acc, F.lit(-1))),
            F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(F.greatest(s["b"], F.try_element_at(acc, F.lit(-1))))),
        ).otherwise(F.concat(acc, F.array(s["a"], s["b"]))))
    return joined


def hit_words(hits: Column) -> Column:
    """Words inside the spans of ``__hits``: ends minus starts."""
    return F.aggregate(
        F.transform(hits, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)),
        F.lit(0).cast("long"), lambda a, x: a + x)


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``contamination``."""
    hit = hit_words(F.col("__hits"))
    names = F.concat_ws(",", F.array_sort(F.transform("__items", lambda x: x.cast("string"))))
    return found.select(
        "doc_id", F.col("__words").alias("n_words"), hit.alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(names.cast("binary"), 256).alias("items_sha256"),
        ((hit > 0) & (20 * hit >= F.col("__words"))).alias("contaminated"))


def clean(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, share: float = 0.05,
    max_span: int | None = None,
) -> DataFrame:
    """``docs`` without contaminated rows: those with at least ``share`` of their words in windows.

    With ``max_span``, spans of more words than that are cut out of the rows that stay; their other
    words and all white space remain as they are. Columns and the other rows are unchanged.
    """
    found = contamination(docs, items, window)
    hit = hit_words(F.col("__hits"))
    kept = found.where(~((hit > 0) & (hit >= share * F.col("__words"))))
    if max_span is not None:
        kept = kept.mapInArrow(_cutter(max_span, docs.columns.index("text")), found.schema)
    return kept.select(*docs.columns)


def _cutter(max_span: int, at: int):
    def cut(batches):
        for batch in tokens.pieces(batches, 8_000_000):
            column = batch.column(at)
            words = tokens.split(column, tokens.NOT_ALNUM, tokens.LOWER)
            raw = column.to_pylist()
            hits = batch.column(batch.schema.get_field_index("__hits")).to_pylist()
            for d, spans in enumerate(hits):
                pairs = [
                    (a, b) for a, b in zip(spans[::2], spans[1::2], strict=True) if b - a > max_span
                ]
                if pairs:
                    data, base = raw[d].encode(), words.offsets[d]
                    for a, b in reversed(pairs):
                        s = words.start[words.first[d] + a] - base
                        e = words.end[words.first[d] + b - 1] - base
                        data = data[:s] + data[e:]
                    raw[d] = data.decode()
            columns = list(batch.columns)
            columns[at] = pa.array(raw, column.type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return cut


def brute_digest(docs: list[tuple], items: list[tuple], window: int = WINDOW) -> list[tuple]:
    """The same digest by comparing every window with every position; for tests."""
    windows: dict[tuple, set[int]] = {}
    for item, text in items:
        words = _words((text or "").encode())
        size = min(len(words), window)
        for i in range(len(words) - size + 1 if size else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        words = _words((text or "").encode())
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if got := windows.get(tuple(words[i : i + size])):
                    hit.update(range(i, i + size))
                    found |= got
        names = ",".join(sorted(map(str, found)))
        out.append((doc, len(words), len(hit), len(found),
                    hashlib.sha256(names.encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(words)))
    return out
