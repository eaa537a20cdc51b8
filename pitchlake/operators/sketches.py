"""Profiles that add up: a sketch per column and load, merged to the profile of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: log2 of the registers of a distinct-count sketch, and the size of a quantile sketch.
REGISTERS, WIDTH = 12, 200
#: Three standard errors of the first, 1.04 / sqrt(2^12) each, and the rank error of the second.
DISTINCT_ERROR, RANK_ERROR = 3 * 1.04 / 2 ** (REGISTERS / 2), 0.0165


def sketch_columns(df: DataFrame, columns: Sequence[str], numeric: Sequence[str] = ()) -> DataFrame:
    """One row per column: rows, known values, smallest and largest, and the sketches.

    (column, rows, known, low, high, distinct_sketch, quantile_sketch); the last three of those that
    are not ``numeric`` are NULL. One scan; a sketch has a bounded size, whatever the load.
    """
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in columns:
        number = F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")
        aggs += [
            F.count(c).alias(f"known__{c}"), F.min(number).alias(f"low__{c}"),
            F.max(number).alias(f"high__{c}"),
            F.hll_sketch_agg(F.col(c).cast("string"), REGISTERS).alias(f"distinct__{c}"),
            (F.kll_sketch_agg_double(number, WIDTH) if c in numeric
             else F.max(F.lit(None).cast("binary"))).alias(f"quantiles__{c}"),
        ]
    cells = F.array(*[
        F.struct(
            F.lit(c).alias("column"), "rows", F.col(f"known__{c}").alias("known"),
            F.col(f"low__{c}").alias("low"), F.col(f"high__{c}").alias("high"),
            F.col(f"distinct__{c}").alias("distinct_sketch"),
            F.col(f"quantiles__{c}").alias("quantile_sketch"))
        for c in columns])
    return df.agg(*aggs).select(F.inline(cells))


def merge_sketches(stored: DataFrame) -> DataFrame:
    """The stored sketches of several loads as those of their union."""
    return stored.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("known").alias("known"), F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"))


def estimates(sketches: DataFrame, probabilities: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(column, rows, known, low, high, distinct, quantiles) from sketches.

    ``distinct`` lies within ``DISTINCT_ERROR`` of the exact count, relatively, and the rank of each
    quantile within ``RANK_ERROR`` of its probability, each with a chance above 99 per cent.
    """
    marks = F.array(*[F.lit(float(p)) for p in probabilities])
    numeric = F.col("low").isNotNull()
    return sketches.select(
        "column", "rows", "known", "low", "high",
        F.hll_sketch_estimate("distinct_sketch").alias("distinct"),
        F.when(numeric, F.kll_sketch_get_quantile_double("quantile_sketch", marks)).alias(
            "quantiles"))
