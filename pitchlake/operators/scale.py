"""Group-wise operators that keep working when one key holds a large share of all rows.

A plain ``Window.partitionBy(key)`` puts a whole group into one task. The three forms used here
do not:

* totals: aggregate with map-side combine, then join the small result back;
* running sums and row numbers: cut all groups into ordered chunks;
* latest rows: ``row_number() == 1``, which Spark limits per map task before it shuffles.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def null_safe_on(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return functools.reduce(
        lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs]
    )


def with_totals(
    df: DataFrame,
    groupings: Sequence[tuple[Sequence[str], Mapping[str, Column]]],
    source: DataFrame | None = None,
) -> DataFrame:
    """Add the totals of one or more groupings to every row; NULL keys form one group.

    ``groupings`` holds (keys, {name: aggregate}) pairs. ``source`` is an aggregate of ``df`` by
    all their keys together: the groupings then share its one exchange instead of each reading
    ``df`` again. Each join also compares a hash of the
    keys. That gives both sides an exchange of their own, so AQE may split a skewed partition of
    the detail rows instead of leaving it to one task.
    """
    out = df
    for n, (keys, totals) in enumerate(groupings):
        keys, h = list(keys), f"_h{n}"
        grouped = (
            (df if source is None else source).groupBy(*keys)
            .agg(*[c.alias(name) for name, c in totals.items()])
            .withColumn(h, F.xxhash64(*keys))
            .withColumnsRenamed({k: f"_k{n}_{k}" for k in keys})
        )
        detail = out.withColumn(f"_d{n}", F.xxhash64(*keys))
        on = (detail[f"_d{n}"] == grouped[h]) & null_safe_on(
            detail, grouped, [(k, f"_k{n}_{k}") for k in keys]
        )
        out = detail.join(grouped, on, "left").drop(h, f"_d{n}", *[f"_k{n}_{k}" for k in keys])
    return out


#: Rows of a chunk, on average. A frame of n rows has about n / CHUNK_ROWS chunk bounds, which are
#: sent to every task: half a million for 10^11 rows.
CHUNK_ROWS = 200_000

_SORT_ORDER = re.compile(r"Column<'(.+?)(?: (ASC|DESC))?(?: NULLS (FIRST|LAST))?'>")


def _before(order: Sequence[Column | str]) -> tuple[list[str], Callable[[Column, Column], Column]]:
    """The columns of an order, and whether one struct of them comes before another."""
    parts = []
    for item in order:
        found = _SORT_ORDER.fullmatch(str(F.col(item) if isinstance(item, str) else item))
        name, down, nulls = found.groups() if found else (None, None, None)
        if name is None or re.search(r"[( ]", name):
            raise ValueError(f"{item}: order by a column, up or down")
        first = nulls == "FIRST" if nulls else down != "DESC"
        parts.append((name.replace("`", ""), down == "DESC", first))

    def before(a: Column, b: Column) -> Column:
        out = F.lit(False)
        for name, down, nulls_first in reversed(parts):
            x, y = a[name], b[name]
            edge = x.isNull() & y.isNotNull() if nulls_first else x.isNotNull() & y.isNull()
            less = edge | F.coalesce(x > y if down else x < y, F.lit(False))
            out = less | (x.eqNullSafe(y) & out)
        return out

    return [name for name, *_ in parts], before


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    sums: Mapping[str, Column],
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Running sums per group, including the current row, over a total order.

    ``sums`` maps output names to numeric columns; ``F.lit(1)`` gives a row number. ``order`` holds
    column names, or such columns up or down. A group is cut into chunks of about ``chunk_rows``
    rows, at the places of rows whose hash is picked, so any group, however large, is dealt to as
    many tasks as its share asks for. Each row adds the sum up to it inside its chunk to the sum of
    its group's earlier chunks.

    All rows are shuffled once, by (keys, chunk). Bounds and chunk sums come from narrow
    aggregates. Which rows are picked depends on their content only, so all uses of the bounds, and
    any task that is run again, see the same chunks; nothing runs or is written while planning.
    """
    keys, order = list(keys), list(order)
    names, before = _before(order)
    inputs = {f"_in_{name}": c for name, c in sums.items()}
    rows = df.withColumns(inputs).withColumn("_place", F.struct(*names))
    picked = F.pmod(F.xxhash64(*keys, *names, *inputs), F.lit(chunk_rows)) == 0
    bounds = (
        rows.where(picked).groupBy(*keys).agg(F.collect_set("_place").alias("_found"))
        .select(
            *[F.col(k).alias(f"_b_{k}") for k in keys],
            F.array_sort("_found", lambda a, b: F.when(before(a, b), -1).when(
                before(b, a), 1).otherwise(0)).alias("_bounds"))
    )

    def at_or_after(bound: Column) -> Column:
        return ~before(F.col("_place"), bound)

    # Binary search: the number of bounds that a row has reached.
    size = F.size("_bounds")
    steps = F.transform(
        F.sequence(F.floor(F.log2(size)).cast("int"), F.lit(0), F.lit(-1)),
        lambda i: F.pow(F.lit(2), i).cast("int"))
    reached = F.aggregate(steps, F.lit(0), lambda n, step: F.when(
        (n + step <= size) & at_or_after(F.get("_bounds", n + step - 1)), n + step).otherwise(n))
    chunk = F.when(F.col("_bounds").isNull(), 0).otherwise(reached)

    def chunked(how: str) -> DataFrame:
        # About one bound for each ``chunk_rows`` rows.
        on = null_safe_on(rows, bounds, [(k, f"_b_{k}") for k in keys]) if keys else F.lit(True)
        return rows.join(F.broadcast(bounds), on, how).withColumn("_chunk", chunk)

    part = [*keys, "_chunk"]
    inside = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = chunked("left").select(
        *df.columns, "_chunk",
        *[F.sum(f"_in_{name}").over(inside).alias(f"_local_{name}") for name in sums],
    )
    # One row per chunk of the groups that have several.
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        chunked("inner").groupBy(*part)
        .agg(*[F.sum(f"_in_{name}").alias(f"_sum_{name}") for name in sums])
        .select(
            *[F.col(k).alias(f"_k_{k}") for k in part],
            *[F.sum(f"_sum_{name}").over(earlier).alias(f"_before_{name}") for name in sums],
        )
    )
    on = null_safe_on(local, offsets, [(k, f"_k_{k}") for k in part])
    return local.join(F.broadcast(offsets), on, "left").select(
        *[local[c] for c in df.columns],
        *[
            F.when(
                F.col(f"_local_{name}").isNull() & F.col(f"_before_{name}").isNull(), None
            )
            .otherwise(
                F.coalesce(f"_local_{name}", F.lit(0)) + F.coalesce(f"_before_{name}", F.lit(0))
            )
            .alias(name)
            for name in sums
        ],
    )


def row_numbers(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    name: str = "rn",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``row_number()`` for every row of every group."""
    ranked = running(df, keys, order, {name: F.lit(1)}, chunk_rows)
    return ranked.withColumn(name, F.col(name).cast("int"))


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of every group. Each map task keeps one row per key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    )


#: Into how many slots the hashes of keys are dealt: at most that many numbers are broadcast.
SLOTS = 1 << 22


def split_repeated(
    df: DataFrame, keys: Sequence[str], slots: int = SLOTS
) -> tuple[DataFrame, DataFrame]:
    """Rows whose key surely occurs once, and all others; together they are the rows of ``df``.

    Only hashes of keys are counted and shuffled. The slots of those that occur again are broadcast,
    and a row is in the second part if its slot is among them: all rows of n repeated keys, and about
    n / ``slots`` of the single ones. ``df`` is read three times and has to give the same rows each
    time. NULL keys count as equal.
    """
    h = F.xxhash64(*keys)
    slot = F.pmod(h, F.lit(slots)).cast("int")
    again = F.broadcast(  # at most ``slots`` rows
        df.select(h.alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        .select(F.pmod("_h", F.lit(slots)).cast("int").alias("_slot")).distinct()
    )
    on = slot == again["_slot"]
    return df.join(again, on, "left_anti"), df.join(again, on, "left_semi")


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
) -> DataFrame:
    """Linearly interpolated quantiles as rows (column, probability, value).

    The values are first counted, so only distinct values are ranked, and the ranking of a
    column with very many of them is dealt to several tasks like any other group.
    """
    columns = list(columns)
    long = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                    for c in columns
                ]
            )
        ).alias("r")
    ).select("r.column", "r.value")
    histogram = (
        long.filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = running(histogram, ["column"], ["value"], {"upto": F.col("n")})
    totals = histogram.groupBy("column").agg(F.sum("n").alias("total"))
    wanted = F.broadcast(  # columns x probabilities rows
        totals.select(
            F.col("column").alias("_c"),
            F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("probability"),
            (F.col("total") - 1).alias("last"),
        ).withColumn("position", F.col("probability") * F.col("last"))
    )
    low, high = F.floor("position"), F.ceil("position")
    first = F.col("upto") - F.col("n")

    def holds(rank: Column) -> Column:
        return (first <= rank) & (rank < F.col("upto"))

    picked = (
        ranked.join(wanted, F.col("column") == F.col("_c"))
        .filter(holds(low) | holds(high))
        .groupBy("column", "probability")
        .agg(
            F.max(F.when(holds(low), F.col("value"))).alias("at_low"),
            F.max(F.when(holds(high), F.col("value"))).alias("at_high"),
            F.max(F.col("position") - low).alias("part"),
        )
    )
    return picked.select(
        "column",
        "probability",
        (F.col("at_low") + (F.col("at_high") - F.col("at_low")) * F.col("part")).alias("value"),
    )


