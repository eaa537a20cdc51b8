"""Near-duplicate groups of documents by MinHash bands, odd sketches and exact confirmation.

Each shingle set gets MinHash samples. Bands of samples propose pairs; the same samples, folded
into a parity bitmap (an odd sketch), estimate a proposed pair's similarity from the population
count of an XOR; what the sketch can't rule out is confirmed on the full sets. Documents with equal
sets are one node from the start. Within a band's bucket, nodes are compared with one hub, not with
each other; nodes that are still in different groups after that are compared across groups, where
the odd sketch of a whole set rules out most pairs for certain.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.llm import tokens
from pitchlake.llm.common import materialise

SHINGLE = 2
#: 40 bands of 5 samples miss a pair of similarity 0.8 with a chance of (1 - 0.8^5)^40 = 1e-7.
BANDS, ROWS = 40, 5
SAMPLES = BANDS * ROWS
#: Bits of an odd sketch; at similarity 0.8 two sketches differ in about 75 of them.
SKETCH_BITS = 512
#: Sketches whose estimate is below this can't belong to a pair of 0.8: six standard deviations.
LEAST_ESTIMATE = 0.62
STAR_ROUNDS = 2
#: Bits of the odd sketch of a whole set. An XOR's population count never exceeds the number of
#: shingles in one set only, so what it rules out is no link for certain.
WIDE_BITS = 4096
#: Nodes of a bucket that are compared with as many others at a time.
BLOCK_NODES = 1024

_U = np.uint64
_SINGLE = _U(0x5851F42D4C957F2D)


def _multipliers() -> np.ndarray:
    return tokens.mix(np.arange(1, SAMPLES + 1, dtype=np.uint64)) | _U(1)


def shingle_sets(column: pa.Array, size: int = SHINGLE):
    """The sorted hashes of each row's distinct shingles."""
    words = tokens.split(column, tokens.SPACES, tokens.LOWER)
    h = tokens.hashes(words)
    windows = tokens.window_hashes(h, size)
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= size:
            yield np.unique(windows[a : b - size + 1])
        elif b > a:  # fewer words than a shingle: the whole sequence is one
            whole = _U(b - a) * _SINGLE
            for x in h[a:b]:
                whole = tokens.mix(np.array([x ^ whole]))[0]
            yield np.array([whole], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def _samples(shingles: np.ndarray, by: np.ndarray) -> np.ndarray:
    """For each multiplier the least product with a shingle hash, modulo 2^64."""
    out = np.full(len(by), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 256):
        np.minimum(out, (shingles[at : at + 256, None] * by).min(axis=0), out=out)
    return out


def _sign(size: int):
    def sign(batches):
        by = _multipliers()
        salts = tokens.mix(np.arange(SAMPLES, dtype=np.uint64) + _U(1 << 20))
        for batch in tokens.pieces(batches, 8_000_000):
            n, one, two, sketches, bands = [], [], [], [], []
            for s in shingle_sets(batch.column(2), size):
                n.append(len(s))
                one.append(s.sum(dtype=np.uint64) ^ _U(len(s)))
                two.append(tokens.mix(s).sum(dtype=np.uint64))
                if not len(s):
                    sketches.append([0] * (SKETCH_BITS // 64))
                    bands.append([])
                    continue
                m = tokens.mix(_samples(s, by) ^ salts)
                bit = np.bincount(
                    (m % _U(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1
                sketches.append(np.packbits(bit.astype(np.uint8)).view(np.int64))
                key = np.zeros(BANDS, np.uint64)
                for row in m.reshape(BANDS, ROWS).T:
                    key = tokens.mix(key + row)
                bands.append(key.view(np.int64))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(n, pa.int64()),
                pa.array(np.array(one, np.uint64).view(np.int64)),
                pa.array(np.array(two, np.uint64).view(np.int64)),
                pa.array(sketches, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64())),
            ], ["doc_id", "node", "n", "one", "two", "sketch", "bands"])

    return sign


def _wide(shingles: np.ndarray) -> bytes:
    bits = np.bincount(
        (tokens.mix(shingles ^ _SINGLE) % _U(WIDE_BITS)).astype(np.int64), minlength=WIDE_BITS)
    return np.packbits((bits & 1).astype(np.uint8)).tobytes()


def _estimate(a: str, b: str) -> Column:
    """Similarity from two odd sketches: the differing samples d that explain the differing bits."""
    bits = F.aggregate(
        F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    rest = F.greatest(1 - 2.0 * bits / SKETCH_BITS, F.lit(1e-9))
    differing = F.log(rest) / (2 * np.log(1 - 2.0 / SKETCH_BITS))
    return 1 - differing / SAMPLES


def _possible(a: str, b: str, percent: int) -> Column:
    """Pairs that the set sizes and the sketches of columns a_*, b_* leave possible."""
    small, large = F.least(f"{a}_n", f"{b}_n"), F.greatest(f"{a}_n", f"{b}_n")
    return (100 * small >= percent * large) & (
        _estimate(f"{a}_sketch", f"{b}_sketch") >= LEAST_ESTIMATE)


def _as(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}_{c}") for c in df.columns])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): the labels of the pairs with 100 * intersection >= percent * union on full sets."""

    def confirm(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = np.concatenate((x, y))
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (len(both) - shared))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("set").alias("a_set"))
    right = sets.select(F.col("node").alias("b"), F.col("set").alias("b_set"))
    return (
        pairs.join(left, "a").join(right, "b").select(
            F.col("a_label").alias("a"), F.col("b_label").alias("b"), "a_set", "b_set")
        .mapInArrow(confirm, "a long, b long")
    )


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable over ``links`` (a, b), for every linked node.

    Large and small stars in turn: neighbours above a node move to its smallest neighbour, then a
    node and its smaller neighbours do, until nothing moves. Each step is a grouped minimum and a
    join, and is written to the shared folder.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where(
        "u <> v").distinct()
    edges = materialise(edges, "edges")
    while not _are_stars(edges):
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = materialise(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", "m")).where("u <> v").distinct(), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        edges.select(F.col("v"), F.col("v")).distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Whether every edge (u, v) leads from a node without other edges to its group's smallest."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1)))
    inner = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return inner.where("up > 1 or up + down > 1").count() == 0


def _tree_labels(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label) for ``nodes``: the smallest node of each tree of ``links`` (a, b).

    Links lead each a to one b and never in a circle, so pointers are doubled until all end at
    roots; a step is one join, and a tree of depth d takes log2(d) + 1 steps.
    """
    ups = materialise(
        nodes.join(links.withColumnRenamed("a", "node"), "node", "left").select(
            "node", F.coalesce("b", "node").alias("up")), "ups")
    moved = True
    while moved:
        higher = ups.select(F.col("node").alias("up"), F.col("up").alias("higher"))
        ups = materialise(ups.join(higher, "up").select(
            "node", F.col("higher").alias("up"),
            (F.col("higher") != F.col("up")).alias("moved")), "ups")
        moved = ups.agg(F.max("moved")).first()[0]
    least = ups.groupBy("up").agg(F.min("node").alias("label"))
    return ups.join(least, "up").select("node", "label")


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, label) after ``links`` (a, b) of labels."""
    moved = components(links).select(F.col("node").alias("label"), F.col("label").alias("to"))
    return labels.join(moved, "label", "left").select(
        "node", F.coalesce("to", "label").alias("label"))


def _labelled(nodes: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return nodes.withColumn("label", F.col("node"))
    return nodes.join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node"))


def near_duplicates(
    docs: DataFrame, percent: int = 80, size: int = SHINGLE
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    A document's set holds its distinct shingles of ``size`` words, in lower-case A-Z; with fewer
    words the whole sequence is the only shingle. Documents are linked if ``percent`` per cent of
    the union of their sets is shared; ``component_id`` is the smallest id reachable over links and
    ``kept`` tells that it is the document's own. NULL and empty texts have no set and no links.
    Equal sets link at once, however many rows share them; repeated rows give repeated results. A
    row without an id takes part, and its component's id is NULL only if no row there has one
    (``kept`` is then true). Other columns are not read.

    A linked pair is proposed with a chance of 1 - 1e-7 at the limit and more above it; sets are
    compared by 64-bit hashes of their shingles.
    """
    return _grouped(docs, percent, size).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def deduplicate(docs: DataFrame, percent: int = 80, size: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: the one with the smallest id.

    Of rows with equal id and text one stays, also of those without words. A group without any id
    keeps one of its rows. Columns are unchanged.
    """
    groups = _grouped(docs, percent, size)
    row = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "node")
    first = groups.where("n > 0").groupBy("label").agg(F.min(row).alias("row")).select("row.*")
    alone = groups.where("n = 0").select("doc_id", "node").distinct()
    winners = first.select("doc_id", "node").union(alone).select(
        F.col("doc_id").alias("__id"), F.col("node").alias("__own"))
    rows = docs.withColumn("__node", F.xxhash64("text")).dropDuplicates(["doc_id", "__node"])
    return rows.join(
        winners, (F.col("__node") == F.col("__own")) & F.col("doc_id").eqNullSafe(F.col("__id")),
        "left_semi").select(*docs.columns)


def _grouped(docs: DataFrame, percent: int, size: int) -> DataFrame:
    """(doc_id, node, n, label, component_id) for every row; ``label`` is NULL without words."""
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("node"), F.coalesce("text", F.lit("")).alias("text"))
    signed = materialise(texts.mapInArrow(
        _sign(size),
        "doc_id long, node long, n long, one long, two long, sketch array<long>, bands array<long>",
    ), "signatures")

    # A node for all documents with the same set; its text is that of one of them.
    nodes = materialise(
        signed.where("n > 0").groupBy("one", "two", "n").agg(
            F.min("doc_id").alias("least"),
            F.min(F.struct("node", "doc_id", "sketch", "bands")).alias("own"))
        .select("one", "two", "n", "least", "own.*"), "nodes")
    # The buckets of more than one node.
    dealt = nodes.select("node", F.explode("bands").alias("key"))
    shared = dealt.groupBy("key").agg(
        F.min("node").alias("x"), F.max("node").alias("y"), F.count("*").alias("crowd")).where(
        "x <> y").select("key", "crowd")
    buckets = materialise(dealt.join(shared, "key"), "buckets")
    # A node that shares its buckets with many others is near the middle of its group.
    weights = buckets.groupBy("node").agg(F.sum("crowd").alias("weight"))
    traits = materialise(
        nodes.select("node", "doc_id", "n", "sketch", "bands").join(weights, "node"), "traits")

    def as_sets(batches):
        for batch in tokens.pieces(batches, 8_000_000):
            sets = list(shingle_sets(batch.column(1), size))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary()),
                pa.array([_wide(s) for s in sets], pa.binary())], ["node", "set", "wide"])

    wanted = traits.select("node", "doc_id")
    sets = materialise(
        texts.join(wanted, (texts.node == wanted.node) & texts.doc_id.eqNullSafe(wanted.doc_id),
                   "left_semi")
        .select("node", "text").mapInArrow(as_sets, "node long, set binary, wide binary")
        .groupBy("node").agg(F.first("set").alias("set"), F.first("wide").alias("wide")), "sets")

    labels = None
    wide = sets.select("node", "wide")
    for turn in ["star"] * STAR_ROUNDS + ["cross"]:
        rows = buckets.join(_labelled(traits.select("node", "weight"), labels), "node")
        if turn == "star":
            pairs = _star_pairs(rows, traits, percent)
        else:
            pairs = _cross_pairs(rows, traits.join(wide, "node"), percent)
        found = _confirmed(pairs, sets, percent)
        # At first labels are nodes, and every hub has more weight than those that it meets.
        labels = materialise(
            _tree_labels(traits.select("node"), found) if labels is None
            else _relabelled(labels, found), "labels")

    return _result(signed, nodes, labels)


def _star_pairs(rows: DataFrame, traits: DataFrame, percent: int) -> DataFrame:
    """At most one pair (a, b) for each node, with labels: with the most similar hub of its buckets.

    A bucket's hub is the node of most weight, the crowds of its own buckets, which near copies of
    one text have in common; nodes of the hub's label need no pair.
    """
    hubs = rows.groupBy("key").agg(
        F.max(F.struct("weight", "node", "label")).alias("hub"), F.min("label").alias("low"),
        F.max("label").alias("most")).where("low <> most").select(
        "key", F.col("hub.node").alias("hub"), F.col("hub.label").alias("hub_label"))
    pairs = rows.join(hubs, "key").where("label <> hub_label").select(
        F.col("node").alias("a"), F.col("hub").alias("b"), F.col("label").alias("a_label"),
        F.col("hub_label").alias("b_label")).distinct()
    # Joined by a at last, as what follows groups and joins by it.
    known = pairs.join(
        _as(traits.select("node", "n", "sketch"), "b"), F.col("b") == F.col("b_node")).join(
        _as(traits.select("node", "n", "sketch"), "a"), F.col("a") == F.col("a_node"))
    near = F.round(_estimate("a_sketch", "b_sketch"), 1)
    return (
        known.where(_possible("a", "b", percent))
        .groupBy("a").agg(F.min(F.struct((-near).alias("far"), "b", "a_label", "b_label")).alias(
            "best"))
        .select("a", "best.b", "best.a_label", "best.b_label")
    )


def _cross_pairs(rows: DataFrame, traits: DataFrame, percent: int) -> DataFrame:
    """All possible pairs of a bucket's nodes with different labels, each once, with the labels.

    Only buckets that still hold several labels take part. A bucket's nodes meet in blocks, so a
    task holds two blocks at most; sketches are compared there and only pairs come out that sizes,
    the samples' sketch and the whole set's sketch leave possible. A pair belongs to the first band
    that its nodes share.
    """
    mixed = rows.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where(
        "low <> high").select("key")
    blocks = F.ceil(F.col("crowd") / BLOCK_NODES).cast("int")
    own = F.pmod(F.xxhash64("node", "key"), F.col("blocks")).cast("int")
    near = (
        rows.select("key", "node", "crowd", "label").join(mixed, "key")
        .withColumn("blocks", blocks).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"),
                "own", "node", "label")
        .join(traits.select("node", "n", "sketch", "wide", "bands"), "node")
    )

    def compare(key, table):
        at, p, q = (k.as_py() for k in key)
        own = table.column("own").to_numpy()
        node, label = table.column("node").to_numpy(), table.column("label").to_numpy()
        n = table.column("n").to_numpy()
        sketch, bands = (
            np.array(table.column(c).combine_chunks().flatten()).reshape(len(n), -1).view(np.uint64)
            for c in ("sketch", "bands"))
        wide = np.frombuffer(b"".join(table.column("wide").to_pylist()), np.uint64).reshape(
            len(n), -1)
        band = np.argmax(bands == np.int64(at).view(np.uint64), axis=1)
        rest = 1 - 2 / SKETCH_BITS
        most = int(SKETCH_BITS / 2 * (1 - rest ** (2 * SAMPLES * (1 - LEAST_ESTIMATE)))) + 1
        left, right = np.flatnonzero(own == p), np.flatnonzero(own == q)
        first, second = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in left:
            js = right[right > i] if p == q else right
            js = js[(label[js] != label[i])
                    & (100 * np.minimum(n[js], n[i]) >= percent * np.maximum(n[js], n[i]))]
            js = js[np.bitwise_count(sketch[js] ^ sketch[i]).sum(axis=1) <= most]
            js = js[np.argmax(bands[js] == bands[i], axis=1) == band[i]]
            apart = np.bitwise_count(wide[js] ^ wide[i]).sum(axis=1).astype(np.int64)
            both = n[js] + n[i]
            js = js[100 * (both - apart) >= percent * (both + apart)]
            first.append(np.full(len(js), i))
            second.append(js)
        i, j = np.concatenate(first), np.concatenate(second)
        return pa.table({"a": node[i], "b": node[j], "a_label": label[i], "b_label": label[j]})

    return near.groupBy("key", "p", "q").applyInArrow(
        compare, "a long, b long, a_label long, b_label long")


def _result(signed: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    named = _labelled(nodes.select("node", "one", "two", "n", "least"), labels)
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    groups = named.join(least, "label").select("one", "two", "n", "label", "component_id")
    rows = signed.select("doc_id", "node", "one", "two", "n")
    grouped = rows.where("n > 0").join(groups, ["one", "two", "n"]).select(
        "doc_id", "node", "n", "label", "component_id")
    alone = rows.where("n = 0").select(
        "doc_id", "node", "n", F.lit(None).cast("long").alias("label"),
        F.col("doc_id").alias("component_id"))
    return grouped.union(alone)
