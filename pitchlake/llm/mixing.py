"""Mixing sources to target weights by Pfair scheduling of blocks.

A source of weight w owns its j-th block's window: released at slot floor((j - 1) / w), due at slot
ceil(j / w). Each slot goes to the released block with the earliest deadline, which keeps every
source less than one block away from its share of any prefix. Weights are whole parts of their sum,
of any size, and windows are computed from them without rounding.

The schedule is cut into segments of slots that grouped tasks simulate at once. A segment starts
from a guess of which sources already had the block whose window lies across its start; segments
whose guess differs from the end of the segment before are simulated again from that end, until
all fit. The result is the schedule of one run from slot 0.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Mapping
from fractions import Fraction
from numbers import Rational

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchlake.llm.common import materialise

#: Parts into which ``quanta`` rounds, for callers that want a short period.
PERIOD = 1024
BLOCK_ROWS = 8
#: Rows of a source that one task numbers, on average.
NUMBER_ROWS = 200_000
#: Slots that one task schedules, unless there are more sources.
SEGMENT_SLOTS = 200_000
#: Whole parts of the weight 1 where weights are powers of counts.
WEIGHT_PARTS = 1e12


def quanta(shares: Mapping[str, float], period: int = PERIOD) -> dict[str, int]:
    """Whole parts of ``period`` for each source by largest remainders, one at least."""
    if len(shares) > period:
        raise ValueError(f"{len(shares)} sources have no whole parts of {period}")
    total = sum(shares.values())
    exact = {s: period * w / total for s, w in shares.items()}
    parts = {s: max(1, int(x)) for s, x in exact.items()}
    names = sorted(parts, key=lambda s: (parts[s] - exact[s], s))
    at = 0
    while (rest := period - sum(parts.values())) != 0:
        name = names[at % len(names)] if rest > 0 else names[-1 - at % len(names)]
        if rest > 0 or parts[name] > 1:
            parts[name] += 1 if rest > 0 else -1
        at += 1
    return parts


def schedule(parts: Mapping[str, int]) -> list[tuple[int, str, int, int, int]]:
    """(slot, source, block, release, deadline) of one period; blocks of a source count from 0."""
    period = sum(parts.values())
    waiting = [(0, s, 0) for s in sorted(parts)]  # (release, source, block)
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int, int]] = []
    out = []
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            release, source, block = heapq.heappop(waiting)
            deadline = -(-(block + 1) * period // parts[source])
            heapq.heappush(ready, (deadline, source, block, release))
        deadline, source, block, release = heapq.heappop(ready)
        if slot >= deadline:
            raise ValueError(f"block {block} of {source} misses its deadline")
        out.append((slot, source, block, release, deadline))
        if block + 1 < parts[source]:
            heapq.heappush(waiting, ((block + 1) * period // parts[source], source, block + 1))
    return out


def target_weights(docs: DataFrame, power: float = 0.5) -> DataFrame:
    """(source, n, weight): rows of each source, and rows to the power ``power`` in whole parts.

    ``weight`` is an integer as text, so that it may be of any size.
    """
    return docs.groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(
        F.count("*").alias("n")
    ).withColumn("weight", F.round(F.pow(F.col("n").cast("double"), F.lit(power)) * WEIGHT_PARTS)
                 .cast("decimal(38,0)").cast("string"))


def named_weights(docs: DataFrame, shares: Mapping[str, float]) -> DataFrame:
    """(source, n, weight) with weights in the ratio of ``shares``; decimal fractions are exact."""
    exact = {
        s: Fraction(w) if isinstance(w, Rational) else Fraction(str(w)) for s, w in shares.items()}
    if any(w <= 0 for w in exact.values()):
        raise ValueError("weights must be positive")
    unit = math.lcm(*(w.denominator for w in exact.values()))
    weights = docs.sparkSession.createDataFrame(
        [(s, str(int(w * unit))) for s, w in exact.items()], "source string, weight string")
    counts = docs.groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(
        F.count("*").alias("n"))
    return counts.join(weights, "source", "full").select(
        "source", F.coalesce("n", F.lit(0).cast("long")).alias("n"), "weight")


def _over_sources(sources: DataFrame, first: int, add, block_rows: int = 1) -> list[int]:
    """``add`` folded over the weights and blocks of all sources, a result per task."""
    def partial(batches):
        value = first
        for batch in batches:
            for n, w in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True
            ):
                value = add(value, int(w), -(-n // block_rows))
        yield pa.RecordBatch.from_arrays([pa.array([str(value)], pa.string())], ["value"])

    return [int(r[0]) for r in sources.select("n", "weight")
            .mapInArrow(partial, "value string").collect()]


def _in_units(sources: DataFrame, unit: int) -> DataFrame:
    """``sources`` with weights divided by ``unit``, a factor of all of them."""
    def divided(batches):
        for batch in batches:
            yield batch.set_column(2, "weight", pa.array(
                [str(int(w) // unit) for w in batch.column(2).to_pylist()], pa.string()))

    return sources if unit == 1 else materialise(sources.mapInArrow(
        divided, "source string, n long, weight string"), "mix_sources")


def _simulate(
    parts: list[int], blocks: list[int], period: int, start: int, end: int, early: set[int] | None
) -> tuple[list[tuple[int, int, int, int, int]], set[int], set[int]]:
    """(source, block, slot, release, deadline) of the slots from ``start`` to ``end``, of blocks
    that have rows; the sources that had the block across the start before it, and across the end.

    ``early`` None guesses the former: those with the earliest deadlines, as many as fit.
    """
    def due(i: int, block: int) -> int:
        return -(-(block + 1) * period // parts[i])

    following = [-(-p * start // period) for p in parts]  # the first block released from start on
    across = [i for i, p in enumerate(parts) if p * start % period]
    if early is None:
        room = start - sum(p * start // period for p in parts)
        early = set(sorted(across, key=lambda i: (due(i, following[i] - 1), i))[:room])
    for i in across:
        if i not in early:
            following[i] -= 1
    waiting = [
        (release, i) for i, p in enumerate(parts)
        if (release := max(start, following[i] * period // p)) < end]
    heapq.heapify(waiting)
    ready: list[tuple[int, int]] = []
    out = []
    for slot in range(start, end):
        while waiting and waiting[0][0] <= slot:
            i = heapq.heappop(waiting)[1]
            heapq.heappush(ready, (due(i, following[i]), i))
        deadline, i = heapq.heappop(ready)
        block = following[i]
        if slot >= deadline:
            raise ValueError(f"block {block} of source {i} misses its deadline")
        if block < blocks[i]:
            out.append((i, block, slot, block * period // parts[i], deadline))
        following[i] += 1
        release = following[i] * period // parts[i]
        if release < end:
            heapq.heappush(waiting, (release, i))
    return out, early, {i for i, p in enumerate(parts) if following[i] > p * end // period}


_SLOTS = "segment long, source string, block long, slot long, release long, due long"


def _slots(
    spark: SparkSession, sources: DataFrame, period: int, slots: int, length: int, block_rows: int,
) -> DataFrame:
    """(source, block, slot, release, due) of the blocks with rows in the first ``slots`` slots."""
    segments = -(-slots // length)

    def simulate(key, table):
        segment = key[0].as_py()
        data = sorted(zip(*(table.column(c).to_pylist() for c in (
            "source", "weight", "n", "early")), strict=True))
        names = [x[0] for x in data]
        guess = table.column("guess")[0].as_py()
        out, first, last = _simulate(
            [int(x[1]) for x in data], [-(-x[2] // block_rows) for x in data], period,
            segment * length, min(slots, (segment + 1) * length),
            None if guess else {i for i, x in enumerate(data) if x[3]})

        def mark(early: set[int]) -> str:
            return hashlib.sha256("\0".join(names[i] for i in sorted(early)).encode()).hexdigest()

        # Rows of slots; without a slot, rows of sources early at the end; one row of both marks.
        i, block, slot, release, due = zip(*out, strict=True) if out else [()] * 5
        source = [names[k] for k in i] + [names[k] for k in sorted(last)] + [None]
        empty = [None] * (len(last) + 1)
        return pa.table({
            "segment": pa.array([segment] * len(source), pa.int64()),
            "source": pa.array(source, pa.string()),
            **{name: pa.array([*values, *empty], pa.int64()) for name, values in (
                ("block", block), ("slot", slot), ("release", release), ("due", due))},
            "first": pa.array([None] * (len(source) - 1) + [mark(first)], pa.string()),
            "last": pa.array([None] * (len(source) - 1) + [mark(last)], pa.string()),
        })

    def run(of: DataFrame, early: DataFrame | None) -> DataFrame:
        rows = sources.crossJoin(of)
        if early is None:
            rows = rows.withColumn("early", F.lit(False)).withColumn("guess", F.lit(True))
        else:
            rows = rows.join(early, ["segment", "source"], "left").select(
                "segment", *sources.columns, F.coalesce("early", F.lit(False)).alias("early"),
                F.lit(False).alias("guess"))
        return materialise(rows.groupBy("segment").applyInArrow(
            simulate, f"{_SLOTS}, first string, last string"), "mix_slots")

    found = run(spark.range(segments).select(F.col("id").alias("segment")), None)
    while True:
        marks = {r["segment"]: r for r in found.where("first is not null").select(
            "segment", "first", "last").collect()}  # a row a segment
        wrong = [k for k in range(1, segments) if marks[k]["first"] != marks[k - 1]["last"]]
        if not wrong:
            return found.where("slot is not null").drop("segment", "first", "last")
        redo = spark.createDataFrame([(k,) for k in wrong], "segment long")
        ends = found.where("slot is null and source is not null").select(
            (F.col("segment") + 1).alias("segment"), "source", F.lit(True).alias("early"))
        found = materialise(
            found.join(redo, "segment", "left_anti").unionByName(run(redo, ends)), "mix_slots")


def mix(
    docs: DataFrame, shares: Mapping[str, float] | None = None, block_rows: int = BLOCK_ROWS,
    number_rows: int = NUMBER_ROWS, segment_slots: int = SEGMENT_SLOTS,
) -> DataFrame:
    """``docs`` in the order of a mix: added are ``mix_block``, ``mix_release``, ``mix_deadline``,
    ``mix_slot`` and ``mix_position`` (from 0, without gaps).

    Rows of a source stand in the order of the md5 of their id and are cut into blocks of
    ``block_rows``; the last may be short. ``mix_slot`` is the block's slot in an endless schedule.
    While no source has run out, each has received its share of the blocks to within one block;
    from then on its slots stay empty and the others go on. No row is lost or repeated.

    ``shares`` names a weight for every source; without it they are ``target_weights``, for any
    number of sources. A NULL source is the source ''; a NULL id is the id ''. Repeated rows each
    keep a place. An empty input gives no rows; a source without a weight is an error. Columns of
    these names are replaced.
    """
    spark = docs.sparkSession
    added = ["mix_block", "mix_release", "mix_deadline", "mix_slot", "mix_position"]
    docs = docs.drop(*added)
    sources = materialise(
        target_weights(docs) if shares is None else named_weights(docs, shares), "mix_sources")
    bare = sources.where("weight is null").first()
    if bare is not None:
        raise ValueError(f"no weight for source {bare['source']}")
    # Parts of the sum without common factors: the schedule repeats after so many slots.
    weight = sum(_over_sources(sources, 0, lambda x, w, n: x + w)) or 1
    unit = math.gcd(*_over_sources(sources, 0, lambda x, w, n: math.gcd(x, w))) or 1
    sources = _in_units(sources, unit)
    period = weight // unit
    last = max(_over_sources(
        sources, 0, lambda x, w, n: max(x, -(-n * period // w)), block_rows), default=0)
    repeats = period < last
    length = max(segment_slots, sources.count())
    planned = min(period, last)
    slots = _slots(spark, sources, period, planned, length, block_rows) if planned else (
        spark.createDataFrame([], _SLOTS).drop("segment"))
    if planned <= SEGMENT_SLOTS:
        slots = F.broadcast(slots)  # a row a slot

    total = docs.count()
    chunks = int(total // number_rows) + 1
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    # Chunks are ranges of the md5 order, so that no task numbers a whole source.
    leading = F.conv(F.substring("__order", 1, 8), 16, 10).cast("long")
    rows = (
        docs.withColumn("__source", F.coalesce(F.col("source"), F.lit("")))
        .withColumn("__order", order)
        .withColumn("__chunk", F.floor(leading * chunks / F.lit(float(1 << 32))).cast("int"))
    )
    sizes = rows.groupBy("__source", "__chunk").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("__source").orderBy("__chunk")
    offsets = materialise(sizes.select(
        "__source", "__chunk", "__n",
        (F.sum("__n").over(before) - F.col("__n")).alias("__before")), "mix_offsets")
    inside = Window.partitionBy("__source", "__chunk").orderBy(
        "__order", F.xxhash64(*docs.columns))
    numbered = (
        rows.withColumn("__number", F.row_number().over(inside).cast("long") - 1)
        .join(offsets.drop("__n"), ["__source", "__chunk"])
        .withColumn("__number", F.col("__number") + F.col("__before"))
        .withColumn("mix_block", F.floor(F.col("__number") / block_rows))
    )
    # Blocks by the chunk that holds their first row, with their rows and their place in a period.
    first = F.ceil(F.col("__before") / block_rows)
    end = F.ceil((F.col("__before") + F.col("__n")) / block_rows)
    blocks = (
        offsets.where(first < end)
        .select("__source", F.explode(F.sequence(first, end - 1)).alias("mix_block"))
        .join(sources.select(
            F.col("source").alias("__source"), "n",
            (F.col("weight").cast("long") if repeats else F.lit(None).cast("long"))
            .alias("__part")), "__source")
        .withColumn("__size", F.least(
            F.lit(block_rows).cast("long"), F.col("n") - F.col("mix_block") * block_rows))
        .withColumn("__turn", F.floor(F.col("mix_block") / F.col("__part")).cast("long")
                    if repeats else F.lit(0).cast("long"))
        .withColumn("__index", F.col("mix_block") - F.col("__turn") * F.col("__part")
                    if repeats else F.col("mix_block"))
        .join(slots.select(F.col("source").alias("__source"), F.col("block").alias("__index"),
                           "slot", "release", "due"), ["__source", "__index"])
    )
    turned = F.col("__turn") * (period if repeats else 0)
    placed = materialise(blocks.select(
        "__source", "mix_block", "__size", (turned + F.col("release")).alias("mix_release"),
        (turned + F.col("due")).alias("mix_deadline"), (turned + F.col("slot")).alias("mix_slot"),
        F.floor((turned + F.col("slot")) / segment_slots).alias("__segment")), "mix_blocks")
    # Rows in earlier slots: those of earlier segments, and those before it in its own.
    sums = placed.groupBy("__segment").agg(F.sum("__size").alias("__rows"))
    earlier = sums.select("__segment", (
        F.sum("__rows").over(Window.orderBy("__segment")) - F.col("__rows")).alias("__earlier"))
    within = Window.partitionBy("__segment").orderBy("mix_slot")
    places = placed.join(earlier, "__segment").select(
        "__source", "mix_block", "mix_release", "mix_deadline", "mix_slot",
        (F.col("__earlier") + F.sum("__size").over(within) - F.col("__size")).alias("__first"))
    return numbered.join(places, ["__source", "mix_block"]).withColumn(
        "mix_position", F.col("__first") + F.col("__number") - F.col("mix_block") * block_rows
    ).select(*docs.columns, *added)
