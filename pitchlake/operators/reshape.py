"""Unpivot, pivot and unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def views(df: DataFrame, perspectives: Sequence[Mapping[str, Column]]) -> DataFrame:
    """One output row per perspective and input row, in a single scan (a UNION ALL unpivot)."""
    structs = [F.struct(*[c.alias(n) for n, c in p.items()]) for p in perspectives]
    return df.select(F.explode(F.array(*structs)).alias("_v")).select("_v.*")


def pivot_fields(
    df: DataFrame, keys: Sequence[str], field: str, value: str, names: Sequence[str],
    copies: str | None = None,
) -> DataFrame:
    """(keys, field, value) rows to one column per field. The names are given, so no extra job.

    ``copies`` names a column for how often a field occurs at most, for keys that repeat as a whole.
    """
    named = [F.col(field) == n for n in names]
    most = [] if copies is None else [
        F.array_max(F.array(*[F.count_if(is_it) for is_it in named])).alias(copies)]
    return df.groupBy(*keys).agg(
        *[F.max(F.when(is_it, F.col(value))).alias(n) for is_it, n in zip(named, names, strict=True)],
        *most,
    )


def to_points(df: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Wide rows to (keys, field, value) with text values."""
    return df.select(*keys, *[F.col(f).cast("string").alias(f) for f in fields]).unpivot(
        list(keys), list(fields), "field", "value"
    )


def union_stream(batch: DataFrame, stream_rows: DataFrame) -> DataFrame:
    """Batch rows and rows that arrived by stream, told apart by ``source_type``."""
    return batch.withColumn("source_type", F.lit("batch")).unionByName(
        stream_rows.withColumn("source_type", F.lit("stream")), allowMissingColumns=True
    )
