"""Top-k, offsets and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, by: str, k: int, ties: Sequence[str] = ()) -> DataFrame:
    """Largest ``k`` rows; ``ties`` settle equal values. Each task keeps only ``k`` rows."""
    return df.orderBy(F.desc_nulls_last(by), *ties).limit(k)


def sort_rows(df: DataFrame, *by: Column | str) -> DataFrame:
    return df.orderBy(*by)


def distinct_values(df: DataFrame, name: str) -> DataFrame:
    return df.select(name).distinct().orderBy(name)


def nth_distinct(df: DataFrame, name: str, n: int) -> DataFrame:
    """The value at position ``n`` (from 0) of the ordered distinct values."""
    return distinct_values(df, name).offset(n).limit(1)


def head(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def sample_keys(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` distinct keys, the least by md5 of ``key/seed``, whatever the row order."""
    return (
        df.select(key).filter(F.col(key).isNotNull()).distinct()
        .orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f"/{seed}"))), key).limit(n)
    )
