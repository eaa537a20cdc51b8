"""The divergence cube, Golay keys and Strassen tiles next to brute force."""

import collections
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash

from pitchlake.llm import divergence, golay, strassen
from pitchlake.llm.queries import QUERIES

LOWER = {c: c + 32 for c in range(65, 91)}
DOCS = [
    (1, "Alpha beta, ALPHA gämma x1y", "en", "a"), (2, "beta beta ß", "en", "b"), (3, None, "en", "c"),
    (4, "alpha gämma", None, None), (5, "1 2 3", "fr", "a"), (6, "delta delta alpha", "en", "a"),
    (7, "", "en", "d"), (7, "beta delta", "en", "d"), (7, "beta delta", "en", "d"),
    (None, "gämma alpha beta", "en", "b"), (9, "epsilon " * 4000 + "alpha", "en", "b"),
]


def _audit(rows, least, ranks):
    """The contract in plain loops over Python's unlimited whole numbers."""
    words = [(lang or "", source or "", re.findall(
        r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER)))
        for _, text, lang, source in rows]
    out = []
    for lang in {w[0] for w in words}:
        seen = collections.Counter(t for w in words if w[0] == lang for t in set(w[2]))
        kept = sorted(t for t, n in seen.items() if n >= least)
        counts = {s: collections.Counter() for x, s, _ in words if x == lang}
        for x, s, terms in words:
            if x == lang:
                counts[s].update(t for t in terms if t in set(kept))
        whole = sum(counts.values(), collections.Counter())

        def shares(c, kept=kept):
            total = sum(c.values()) + 5 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 5) // total for t in kept}

        p, q = {s: shares(c) for s, c in counts.items()}, shares(whole)
        for s in counts:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in counts if o != s]
            out += [(lang, s, "pair", o, -v, i + 1) for i, (v, o) in enumerate(
                sorted(pairs, key=lambda x: (x[0], x[1].encode())))]
            own = [(q[t] - p[s][t], t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            out += [(lang, s, "term", t, -v, i + 1) for i, (v, t) in enumerate(
                sorted(own, key=lambda x: (x[0], x[1].encode()))[:ranks])]
    return sorted(out)


@pytest.mark.parametrize("least,ranks,groups,terms", [(1, 50, 16, 2048), (2, 2, 1, 1), (9, 50, 2, 3)])
def test_divergences(spark, least, ranks, groups, terms):
    docs = spark.createDataFrame(
        [(*r, 7, "clash") for r in DOCS],
        "doc_id long, text string, lang string, source string, n int, term string").repartition(4)
    found = divergence.audit(docs, least, ranks, groups, terms).collect()
    assert sorted(map(tuple, found)) == _audit(DOCS, least, ranks)


def test_many_sources_in_blocks(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("abcdefghijklmnop") * rng.randint(1, 3) for _ in range(30)),
             "en", f"s{i % 40}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = divergence.audit(docs, 5, 50, 7, 10).collect()
    assert sorted(map(tuple, found)) == _audit(rows, 5, 50)


def test_shares_are_exact_beyond_long_products(spark):
    big = 9_000_000_000_000
    row = spark.createDataFrame([(big, 3 * big, 10**6)], "n long, t long, v long").select(
        divergence.share(*(divergence.F.col(c) for c in "ntv"))).first()
    assert row[0] == 1 + 10**9 * (big + 5) // (3 * big + 5 * 10**6)


# --- op12 -----------------------------------------------------------------------------------------


def _fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _groups(fps):
    """The smallest index reachable over links of four bits or less, by all pairs."""
    parent = list(range(len(fps)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    a = np.array(fps, np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1 :] ^ a[i]) <= 4) + i + 1:
            x, y = top(i), top(int(j))
            parent[max(x, y)] = min(x, y)
    return [top(i) for i in range(len(fps))]


def test_the_code_is_perfect():
    errors = golay._corrections()
    assert len(np.unique(errors)) == 2048 and np.bitwise_count(errors).max() == 3
    assert (golay._syndromes(errors) == np.arange(2048)).all()


@pytest.mark.parametrize("bits", range(5))
def test_close_fingerprints_share_a_key(bits):
    rng = np.random.default_rng(bits)
    for _ in range(300):
        x = int(rng.integers(0, 2**63)) * 2 + int(rng.integers(0, 2))
        y = x
        for b in rng.choice(64, bits, replace=False):
            y ^= 1 << int(b)
        rows, keys = golay.fuzzy_keys(np.array([x, y], np.uint64))
        assert set(keys[rows == 0]) & set(keys[rows == 1])


def test_fingerprints_equal_a_plain_count():
    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet").column("text").to_pylist()
    texts += ["", None, " \t", "One", "a B", "a b c d", "É é ü 中 x", "w" * 5000 + " b", "q " * 3000]
    found = golay.fingerprints(pa.array(texts, pa.string()))
    assert [int(x) for x in found] == [_fingerprint(t) for t in texts]


@pytest.mark.parametrize("block", [4096, 8])
def test_links_join_what_all_pairs_join(spark, block):
    rng = random.Random(11)
    fps = [rng.getrandbits(64) for _ in range(400)] + [0, 2**64 - 1]
    for _ in range(600):  # chains and stars of near fingerprints
        x = rng.choice(fps)
        for b in rng.sample(range(64), rng.randint(1, 6)):
            x ^= 1 << b
        fps.append(x)
    fps += [fps[0] ^ a ^ b for a, b in itertools.combinations([1 << i for i in range(0, 64, 5)], 2)]
    fps = sorted(set(fps), key=lambda x: np.uint64(x).view(np.int64))
    signed = [int(np.uint64(x).view(np.int64)) for x in fps]
    nodes = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(5)
    labels = dict(golay.components(golay.linked(nodes, 4, block)).collect())
    assert [labels.get(x, x) for x in signed] == [signed[i] for i in _groups(fps)]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_simhash_groups_of_all_documents(spark, sf):
    docs = pq.read_table(f"/root/testdata/{sf}/documents.parquet", columns=["doc_id", "text"])
    rows = sorted(zip(*docs.to_pydict().values(), strict=True))
    fps = [_fingerprint(t) for _, t in rows]
    want = [(rows[i][0], f"{fp:016x}", rows[g][0]) for i, (fp, g) in enumerate(
        zip(fps, _groups(fps), strict=True))]
    found = QUERIES["op12_golay_simhash"](spark, f"/root/testdata/{sf}").collect()
    assert sorted(map(tuple, found)) == want


def test_simhash_of_odd_rows(spark):
    rows = [(5, None), (3, ""), (4, " \n"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"),
            (None, "A  b c d\te f"), (None, None), (9, "lonely words stand here alone today"),
            (6, "long " * 100_000)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, fp int, key string")
    found = golay.near_duplicates(docs).collect()
    same = _fingerprint("a b c d e f")
    assert sorted((r.doc_id or 0, r.component_id) for r in found if int(r.fingerprint, 16) == same) == [
        (0, 1), (1, 1), (1, 1), (2, 1)]
    zero = [r for r in found if r.fingerprint == "0" * 16]
    assert {r.component_id for r in zero} == {3} and len(zero) == 4
    assert {r.doc_id for r in found if r.component_id == r.doc_id} >= {9, 6, 1, 3}


# --- op13 -----------------------------------------------------------------------------------------


@pytest.mark.parametrize("shape", [(1, 1, 1), (7, 5, 3), (33, 70, 41), (64, 64, 64), (100, 3, 129)])
def test_strassen_is_exact(shape):
    rng = np.random.default_rng(2)
    m, d, n = shape
    for most in (300, 2**31 - 1):  # beyond 2^53 the leaves multiply whole numbers
        a = rng.integers(-most, most, (m, d)) // max(1, d)
        b = rng.integers(-most, most, (d, n))
        want = (a.astype(object) @ b.astype(object)).astype(np.int64)
        assert (strassen.multiply(a, b, 2) == want).all()
        assert (strassen.multiply(a, b) == want).all()


def _mine(rows, anchors):
    rows = [(i, v, label) for i, v, label in rows if None not in (i, v, label) and v
            and all(x is not None and np.isfinite(x) for x in v)]
    whole = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v], label) for i, v, label in rows]
    out = []
    for a, va, la in whole:
        if a not in anchors:
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v, strict=True)), i, label)
                        for i, v, label in whole if i != a and len(v) == len(va))
        for s, p, _ in [x for x in scored if x[2] == la][:5]:
            fit = [x for x in scored if x[2] != la and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out += [(a, p, n + 1, i, -s, -t) for n, (t, i, _) in enumerate(fit)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(1024, 4096), (2, 3)])
def test_hard_negatives_of_odd_rows(spark, blocks):
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in rng.integers(-3, 4, 6) / 4], int(i) % 3) for i in range(60)]
    rows += [(70, rows[4][1], 1), (71, rows[4][1], 1), (72, rows[4][1], 2), (72, rows[4][1], 2),
             (80, None, 1), (81, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (82, [float("nan")] * 6, 1),
             (83, [float("inf")] * 6, 0), (84, [1.0] * 6, None), (None, [1.0] * 6, 1), (85, [], 1),
             (86, [1.0, 1.0], 1), (87, [1.0, 1.0], 1), (88, [0.75, 0.75], 2), (89, [0.0] * 6, 2)]
    anchors = {0, 5, 10, 15, 70, 80, 84, 85, 86, 89}
    frame = spark.createDataFrame(
        [(*r, 1, 2) for r in rows],
        "vec_id long, embedding array<float>, label int, score int, place int").repartition(4)
    found = strassen.hard_negatives(
        frame, frame.where(frame.vec_id.isin(*anchors)), anchor_block=blocks[0],
        candidate_block=blocks[1]).collect()
    assert sorted(map(tuple, found)) == _mine(rows, anchors)
    assert any(r[0] == 86 for r in found)


def test_hard_negatives_send_no_blocks_through_the_driver(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in rng.integers(-200, 200, 5) * [1, 1, 1, 1, 200] / 4], int(i) % 3)
            for i in range(90)]
    rows += [(91, rows[0][1], 0), (91, rows[0][1], 0), (92, [2.0**40, 1.0, 0.0, 0.0, 0.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    out = strassen.hard_negatives(
        frame, frame.where("vec_id % 3 = 0"), anchor_block=2, candidate_block=4, held=20)
    assert sorted(map(tuple, out.collect())) == _mine(rows, set(range(0, 90, 3)))
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
