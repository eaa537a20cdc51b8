"""Per-group ranking, totals next to detail rows, and running totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.operators.scale import row_numbers, running, with_totals


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    newest_first: Sequence[Column | str],
    rank: str = "rn",
    flag: str = "is_latest",
) -> DataFrame:
    """Rank every row of a key and flag rank 1; all rows stay."""
    ranked = row_numbers(df, keys, newest_first, rank)
    return ranked.withColumn(flag, F.col(rank) == 1)


def partition_totals(
    df: DataFrame, keys: Sequence[str], totals: Mapping[str, Column]
) -> DataFrame:
    """Whole-group totals on every detail row (``SUM(...) OVER (PARTITION BY ...)``)."""
    return with_totals(df, [(keys, totals)])


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    conditions: Mapping[str, Column],
) -> DataFrame:
    """Running count of rows that meet each condition, in the given total order."""
    return running(
        df, keys, order,
        {name: F.when(p, 1).otherwise(0) for name, p in conditions.items()},
    )
