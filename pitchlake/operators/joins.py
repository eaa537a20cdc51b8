"""Joins. Sides are broadcast by measured size (AQE) or by a bound known in advance, never blindly."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.functions.keys import surrogate_key
from pitchlake.operators.scale import first_rows


@dataclass(frozen=True)
class KeyLookup:
    """Attach ``sk`` for the dimension row whose ``natural`` key equals ``foreign``."""

    dim: DataFrame
    natural: str
    foreign: str
    sk: str


def with_keys(fact: DataFrame, lookups: Sequence[KeyLookup]) -> DataFrame:
    """Surrogate keys by left joins; unmatched rows stay, with a NULL key.

    A surrogate key is a function of the natural key, so only natural keys travel through the
    joins and the 32-character keys are computed once at the end. The same dimension may be
    listed several times under different roles.
    """
    out = fact
    for i, look in enumerate(lookups):
        keys = look.dim.select(F.col(look.natural).alias(f"_n{i}"))
        out = out.join(keys, out[look.foreign] == keys[f"_n{i}"], "left")
    return out.select(
        *[
            F.when(F.col(f"_n{i}").isNotNull(), surrogate_key(f"_n{i}")).alias(look.sk)
            for i, look in enumerate(lookups)
        ],
        *fact.columns,
    )


def known_id(sk: str, natural: str) -> Column:
    """The natural key of a row whose surrogate key ``sk`` is known, else NULL.

    As the one is a function of the other it joins and groups alike, and a number is a tenth of a
    32-character key where all rows are shuffled.
    """
    return F.when(F.col(sk).isNotNull(), F.col(natural))


def role(dim: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Project a dimension under role names: ``{'sk_club': 'home_club_key', ...}``."""
    return dim.select(*[F.col(old).alias(new) for old, new in columns.items()])


def lookup(df: DataFrame, dim: DataFrame, pairs: Mapping[str, str], how: str = "left") -> DataFrame:
    """Join on ``{left column: right column}`` and keep the right side's other columns."""
    side = dim.withColumnsRenamed({b: f"_k_{b}" for b in pairs.values()})
    on = functools.reduce(
        lambda x, y: x & y, [df[a] == side[f"_k_{b}"] for a, b in pairs.items()]
    )
    return df.join(side, on, how).drop(*[f"_k_{b}" for b in pairs.values()])


def star_inner(fact: DataFrame, *sides: tuple[DataFrame, Mapping[str, str]]) -> DataFrame:
    """Inner joins to several dimensions; rows with a NULL key drop out."""
    return functools.reduce(lambda acc, s: lookup(acc, s[0], s[1], "inner"), sides, fact)


def enrich(
    events: DataFrame,
    *sides: tuple[DataFrame, Sequence[str]],
    null_matches_null: bool = False,
) -> DataFrame:
    """Chain of left joins on shared column names, single or composite.

    ``null_matches_null`` reproduces data-frame libraries that treat NULL keys as equal.
    """
    out = events
    for side, on in sides:
        renamed = side.withColumnsRenamed({c: f"_k_{c}" for c in on})
        cond = functools.reduce(
            lambda a, b: a & b,
            [
                out[c].eqNullSafe(renamed[f"_k_{c}"])
                if null_matches_null
                else out[c] == renamed[f"_k_{c}"]
                for c in on
            ],
        )
        out = out.join(renamed, cond, "left").drop(*[f"_k_{c}" for c in on])
    return out


def enrich_within(
    events: DataFrame, within: str, *sides: tuple[DataFrame, Sequence[str]]
) -> DataFrame:
    """Chain of left joins whose keys all hold ``within``; every table is shuffled once, by it.

    Joins on (match, player) and on (match, club) would each shuffle the events anew, wider every
    time. So only ``within`` is a key of the join, and the others are compared as a condition, which
    Spark doesn't take for keys. ``within`` must have small groups, as all rows of a match on both
    sides are compared. NULL matches nothing; rows without ``within`` are dealt by a hash of theirs.
    """
    own = F.xxhash64(*events.columns).cast("string")
    dealt = F.coalesce(F.col(within).cast("string"), own)
    out = events
    for side, on in sides:
        renamed = side.withColumnsRenamed({c: f"_k_{c}" for c in on})
        same = [F.col(c).between(F.col(f"_k_{c}"), F.col(f"_k_{c}")) for c in on if c != within]
        cond = functools.reduce(
            lambda a, b: a & b, same,
            (dealt == F.col(f"_k_{within}").cast("string")) & F.col(within).isNotNull())
        out = out.join(renamed, cond, "left").drop(*[f"_k_{c}" for c in on])
    return out


def keep_keys(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return df.join(keys, on, "left_semi")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent, with their row counts; NULL is not an orphan.

    Values are counted before the join, so a frequent value is one row of it.
    """
    values = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    known = parent.select(F.col(parent_column).alias("value"))
    return values.join(known, "value", "left_anti")


def with_global(df: DataFrame, **aggregates: Column) -> DataFrame:
    """Add whole-table aggregates to every row, as scalar subqueries that stay lazy.

    Spark merges subqueries over the same table into one.
    """
    return df.withColumns({name: df.agg(c).scalar() for name, c in aggregates.items()})


def merge_dims(first: DataFrame, second: DataFrame, key: str, shared: Sequence[str]) -> DataFrame:
    """Full outer merge on ``key``; ``shared`` columns prefer the first side."""
    a, b = first.alias("a"), second.alias("b")
    only_a = [c for c in first.columns if c != key and c not in shared]
    only_b = [c for c in second.columns if c != key and c not in shared]
    return a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full").select(
        *[F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in (key, *shared)],
        *[F.col(f"a.{c}") for c in only_a],
        *[F.col(f"b.{c}") for c in only_b],
    )


def distinct_union(*frames: DataFrame) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames).distinct()


def extend_dimension(
    dim: DataFrame, seen: DataFrame, key: str, shared: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Add keys that only occur in facts; one row per key, first by ``order``."""
    return first_rows(merge_dims(dim, seen, key, shared), [key], order)
