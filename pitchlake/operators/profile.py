"""One profile per table, described by a ``ProfileSpec``."""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.functions import rules
from pitchlake.operators import aggregates as agg
from pitchlake.operators.aggregates import missing_flag


@dataclass(frozen=True)
class ProfileSpec:
    """What to look at in one raw table."""

    table: str
    key: tuple[str, ...]
    casts: Mapping[str, str] = field(default_factory=dict)
    numeric: Mapping[str, str] = field(default_factory=dict)
    dates: tuple[str, ...] = ()
    patterns: Mapping[str, str] = field(default_factory=dict)
    rules: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    categories: tuple[str, ...] = ()
    lengths: tuple[str, ...] = ()


def _metric(kind: str, subject: str) -> str:
    return f"{kind}|{subject}"


def fused_counts(df: DataFrame, spec: ProfileSpec) -> DataFrame:
    """All counters of a profile as (metric, subject, value) from a single scan."""
    aggs: dict[str, Column] = {_metric("rows", "*"): F.count(F.lit(1))}
    for f in df.schema:
        aggs[_metric("missing", f.name)] = F.count_if(missing_flag(f))
    for c, t in spec.casts.items():
        aggs[_metric("cast_failures", c)] = F.count_if(rules.cast_failure(c, t))
    for c in spec.dates:
        aggs[_metric("date_failures", c)] = F.count_if(rules.cast_failure(c, "date"))
    for c, p in spec.patterns.items():
        aggs[_metric("bad_format", c)] = F.count_if(rules.bad_format(c, p))
    for name, predicate in spec.rules.items():
        aggs[_metric("rule", name)] = F.count_if(predicate())
    for c in spec.lengths:
        aggs[_metric("max_length", c)] = F.max(F.length(c)).cast("bigint")
    counted = df.agg(*[c.alias(name) for name, c in aggs.items()])
    long = counted.unpivot([], list(aggs), "m", "value")
    return long.select(
        F.split_part("m", F.lit("|"), F.lit(1)).alias("metric"),
        F.split_part("m", F.lit("|"), F.lit(2)).alias("subject"),
        F.col("value").cast("bigint").alias("value"),
    )


def key_counts(df: DataFrame, spec: ProfileSpec, approx: bool = False) -> DataFrame:
    """Distinct values per column, from one count of all values, and repeated keys.

    Keys of several columns are grouped as they are: as one text each they would be the longest
    values of the table, and nearly all different. A key of one column is a column of the count.
    """
    name = ",".join(spec.key)
    counted = None if approx else agg.value_table(df, df.columns)
    if approx or len(spec.key) > 1:
        repeated = agg.dup_keys(df, spec.key).agg(F.count(F.lit(1)).alias("value"))
    else:
        repeated = counted.agg(F.count_if(
            (F.col("column") == name) & (F.col("n") > 1)).alias("value"))
    repeated = repeated.select(
        F.lit("repeated_keys").alias("metric"), F.lit(name).alias("subject"), "value")
    known = agg.distinct_counts(df, approx=True) if approx else agg.per_column(
        counted, df.columns, distinct=F.count("value"))
    return known.select(
        F.lit("distinct").alias("metric"), F.col("column").alias("subject"),
        F.col("distinct").alias("value")).unionByName(repeated)


def profile(df: DataFrame, spec: ProfileSpec, approx_distinct: bool = False) -> DataFrame:
    """Counters, distinct counts and repeated keys: (metric, subject, value)."""
    return fused_counts(df, spec).unionByName(key_counts(df, spec, approx_distinct))


def typed(df: DataFrame, spec: ProfileSpec) -> DataFrame:
    """The columns of the numeric summary after their safe casts."""
    return df.select(*[F.trim(c).try_cast(t).alias(c) for c, t in spec.numeric.items()])


def numeric_summary(df: DataFrame, spec: ProfileSpec, **options) -> DataFrame:
    """Summary of the numeric columns; ``options`` are those of ``agg.summary``."""
    return agg.summary(typed(df, spec), list(spec.numeric), **options)


def date_ranges(df: DataFrame, spec: ProfileSpec) -> DataFrame:
    return agg.min_max(df.select(*[F.try_to_date(c).alias(c) for c in spec.dates]), spec.dates)


def distributions(df: DataFrame, spec: ProfileSpec) -> DataFrame:
    """Frequencies of every categorical column: (column, value, count); one scan, no sort."""
    return agg.value_table(df, spec.categories).withColumnRenamed("n", "count")


def dq_report(df: DataFrame, numeric: tuple[str, ...]) -> DataFrame:
    """Shape, missing, distinct, duplicates, summary, outliers, constants and sparse columns.

    (section, subject, value) rows; percentages have two digits, the summary has four. Counts and
    moments of all columns come from one scan; values, whole rows and quartiles each need their own.
    """
    columns = df.columns
    missing = agg.null_profile(df, "null", 2)
    counted = agg.value_table(df, columns)
    # A column has one value if its table has one row, NULL being a value.
    kinds = agg.per_column(
        counted, columns, distinct=F.count("value"), rows=F.count(F.lit(1)))
    stats = agg.summary(df, list(numeric), quartiles="exact")
    metrics = ["count", "mean", "stddev", "min", "p25", "p50", "p75", "max"]

    def section(name: str, rows: DataFrame, subject: str | Column, value: Column) -> DataFrame:
        subject = F.col(subject) if isinstance(subject, str) else subject
        return rows.select(
            F.lit(name).alias("section"), subject.alias("subject"),
            value.cast("double").alias("value"))

    parts = [
        section("rows", missing.limit(1), F.lit("*"), F.col("rows")),
        section("columns", missing.limit(1), F.lit("*"), F.lit(len(columns))),
        section("missing", missing, "column", F.col("missing")),
        section("missing_pct", missing, "column", F.col("missing_pct")),
        section("distinct", kinds, "column", F.col("distinct")),
        section("duplicates", agg.dup_count(df), F.lit("*"), F.col("duplicates")),
        stats.unpivot(["column"], metrics, "metric", "value").select(
            F.concat(F.lit("summary_"), "metric").alias("section"), F.col("column").alias("subject"),
            F.round("value", 4).alias("value")),
        section("outliers", agg.iqr_outliers(df, numeric), "column", F.col("outliers")),
        section("constant", kinds.where("rows = 1"), "column", F.lit(1)),
        section("mostly_missing", missing.where("missing_pct > 50"), "column", F.col("missing_pct")),
    ]
    return functools.reduce(DataFrame.union, parts)
