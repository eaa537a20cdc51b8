"""Profiling aggregates. Results are long tables (one row per column), computed in few scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.functions import rules
from pitchlake.operators.scale import exact_quantiles


def missing_flag(field: T.StructField, mode: str = "any") -> Column:
    """``any``: NULL or blank, ``null``: NULL only, ``blank``: blank text only."""
    c = F.col(field.name)
    blank = F.trim(c.cast("string")) == ""
    if mode == "null" or not isinstance(field.dataType, T.StringType):
        return F.lit(False) if mode == "blank" else c.isNull()
    return blank if mode == "blank" else c.isNull() | blank


def melt(one_row: DataFrame, columns: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """A one-row frame with ``metric__column`` names to one row per column."""
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column"), *[F.col(f"`{m}__{c}`").alias(m) for m in metrics])
            for c in columns
        ]
    )
    return one_row.select(F.explode(rows).alias("r")).select("r.*")


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def null_profile(df: DataFrame, mode: str = "any", digits: int | None = None) -> DataFrame:
    """Rows, missing count and missing percentage of every column, in one scan."""
    fields = list(df.schema)
    total = F.count(F.lit(1))
    metrics = []
    for f in fields:
        missing = F.count_if(missing_flag(f, mode))
        pct = F.try_divide(missing * F.lit(100.0).cast("double"), total)
        metrics += [
            total.alias(f"rows__{f.name}"),
            missing.alias(f"missing__{f.name}"),
            (F.round(pct, digits) if digits is not None else pct).alias(f"missing_pct__{f.name}"),
        ]
    return melt(df.agg(*metrics), df.columns, ["rows", "missing", "missing_pct"])


def value_table(df: DataFrame, columns: Mapping[str, Column] | Sequence[str]) -> DataFrame:
    """(column, value, n): how often each value of each column occurs, as text; NULL is a value.

    One scan and one exchange for any number of columns: cells are counted where they are read, so
    a column of few values sends few rows. ``columns`` may name expressions.
    """
    if not isinstance(columns, Mapping):
        columns = {c: F.col(f"`{c}`") for c in columns}
    kinds = df.select(*[c.alias(name) for name, c in columns.items()]).schema
    cells = []
    for f, (name, c) in zip(kinds, columns.items(), strict=True):
        if isinstance(f.dataType, T.FractionalType) and not isinstance(f.dataType, T.DecimalType):
            c = F.when(c == 0, F.lit(0).cast(f.dataType)).otherwise(c)  # -0.0 equals 0.0
        cells.append(F.struct(F.lit(name).alias("column"), c.cast("string").alias("value")))
    return (
        df.select(F.explode(F.array(*cells)).alias("_cell"))
        .groupBy("_cell.column", "_cell.value").agg(F.count(F.lit(1)).alias("n")))


def per_column(counted: DataFrame, columns: Sequence[str], **measures: Column) -> DataFrame:
    """Aggregates of a value table, 0 for columns without rows."""
    names = counted.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(c) for c in columns])).alias("column"))
    found = counted.groupBy("column").agg(*[c.alias(name) for name, c in measures.items()])
    return names.join(found, "column", "left").select(
        "column", *[F.coalesce(name, F.lit(0)).alias(name) for name in measures])


def distinct_counts(
    df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False
) -> DataFrame:
    """Distinct known values per column: exact, or one mergeable sketch per column.

    The exact form counts a value table, which has two exchanges whatever the number of columns;
    several ``count(distinct)`` side by side would send every row once per column.
    """
    columns = list(columns or df.columns)
    if approx:
        return melt(
            df.agg(*[F.approx_count_distinct(F.col(c)).alias(f"distinct__{c}") for c in columns]),
            columns, ["distinct"])
    return per_column(value_table(df, columns), columns, distinct=F.count("value"))


def min_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Smallest and largest value per column, as text."""
    aggs = []
    for c in columns:
        aggs += [
            F.min(c).cast("string").alias(f"min__{c}"),
            F.max(c).cast("string").alias(f"max__{c}"),
        ]
    return melt(df.agg(*aggs), list(columns), ["min", "max"])


def dup_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def dup_count(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of each key (or of each whole row)."""
    grouped = df.groupBy(*(keys or df.columns)).agg(F.count(F.lit(1)).alias("n"))
    return grouped.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def value_counts(
    df: DataFrame, name: str, n: int | None = None, normalise: bool = False, as_name: str = ""
) -> DataFrame:
    """Frequencies, largest first, equal ones by value; ``normalise`` folds case and spaces."""
    c = F.lower(F.trim(F.col(name))) if normalise else F.col(name)
    out = as_name or name
    counts = df.groupBy(c.alias(out)).agg(F.count(F.lit(1)).alias("count"))
    ordered = counts.orderBy(F.desc("count"), F.asc_nulls_first(out))
    return ordered if n is None else ordered.limit(n)


def summary(
    df: DataFrame,
    columns: Sequence[str],
    quartiles: str = "approx",
) -> DataFrame:
    """count, mean, stddev, min, quartiles and max per numeric column.

    ``quartiles``: ``approx`` (mergeable sketch), ``exact`` (interpolated) or ``none``.
    """
    columns = list(columns)
    aggs, metrics = [], ["count", "mean", "stddev", "min", "max"]
    for c in columns:
        d = F.col(c).cast("double")
        aggs += [
            F.count(d).alias(f"count__{c}"),
            F.avg(d).alias(f"mean__{c}"),
            F.stddev_samp(d).alias(f"stddev__{c}"),
            F.min(d).alias(f"min__{c}"),
            F.max(d).alias(f"max__{c}"),
        ]
        if quartiles == "approx":
            q = F.percentile_approx(d, [0.25, 0.5, 0.75], 10_000)
            aggs += [q[i].alias(f"{p}__{c}") for i, p in enumerate(("p25", "p50", "p75"))]
    if quartiles == "approx":
        metrics += ["p25", "p50", "p75"]
    out = melt(df.agg(*aggs), columns, metrics)
    if quartiles != "exact":
        return out
    q = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    wide = q.groupBy("column").agg(
        *[
            F.max(F.when(F.col("probability") == p, F.col("value"))).alias(n)
            for n, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
        ]
    )
    return out.join(F.broadcast(wide), "column", "left")  # one row per column


def length_summary(df: DataFrame, name: str, **options) -> DataFrame:
    return summary(df.select(F.length(name).alias(f"{name}_length")), [f"{name}_length"], **options)


def per_key_count_stats(df: DataFrame, key: str) -> DataFrame:
    """Smallest, largest, average and median number of rows per key.

    The second step sees (row count, keys with it) pairs, so the exact median is taken over the
    distinct counts and not over the keys.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    counts = per_key.groupBy("n").agg(F.count(F.lit(1)).alias("keys"))
    return counts.agg(
        F.min("n").alias("min_rows"),
        F.max("n").alias("max_rows"),
        rules.ratio(F.sum(F.col("n") * F.col("keys")), F.sum("keys"), digits=4).alias("avg_rows"),
        F.percentile("n", 0.5, F.col("keys")).alias("median_rows"),
    )


def iqr_outliers(
    df: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """Rows outside 1.5 interquartile ranges per numeric column, count and percentage."""
    columns = list(columns)
    q = exact_quantiles(df, columns, [0.25, 0.75])
    bounds = q.groupBy("column").agg(
        F.max(F.when(F.col("probability") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("probability") == 0.75, F.col("value"))).alias("q3"),
    )
    spread = F.col("q3") - F.col("q1")
    limits = bounds.agg(
        F.map_from_entries(
            F.collect_list(  # one entry per column
                F.struct(
                    "column",
                    F.struct(
                        (F.col("q1") - 1.5 * spread).alias("low"),
                        (F.col("q3") + 1.5 * spread).alias("high"),
                    ),
                )
            )
        )
    ).scalar()
    limited = df.select(*columns, limits.alias("_limits"))
    counted = limited.agg(
        *[
            m
            for c in columns
            for m in (
                F.max(F.col("_limits")[c]["low"]).alias(f"lower__{c}"),
                F.max(F.col("_limits")[c]["high"]).alias(f"upper__{c}"),
                F.count_if(
                    (F.col(c) < F.col("_limits")[c]["low"]) | (F.col(c) > F.col("_limits")[c]["high"])
                ).alias(f"outliers__{c}"),
                F.count(F.lit(1)).alias(f"rows__{c}"),
            )
        ]
    )
    return melt(counted, columns, ["lower", "upper", "outliers", "rows"]).select(
        "column", "lower", "upper", "outliers",
        rules.ratio(F.col("outliers"), F.col("rows"), 100, 2).alias("outlier_pct"),
    )


def constant_cols(df: DataFrame) -> DataFrame:
    """Columns with a single value, NULL counting as a value. Needs no distinct count."""
    one = df.agg(
        *[
            m
            for c in df.columns
            for m in (
                F.min(c).eqNullSafe(F.max(c)).alias(f"same__{c}"),
                F.count_if(F.col(c).isNull()).alias(f"nulls__{c}"),
                F.count(F.lit(1)).alias(f"rows__{c}"),
            )
        ]
    )
    return (
        melt(one, df.columns, ["same", "nulls", "rows"])
        .filter((F.col("same") & (F.col("nulls") == 0)) | (F.col("nulls") == F.col("rows")))
        .filter(F.col("rows") > 0)
        .select("column")
    )


def high_missing(df: DataFrame, pct: float = 50.0, mode: str = "null") -> DataFrame:
    return null_profile(df, mode, 2).filter(F.col("missing_pct") > pct)


def global_max(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.max(name).alias(name))


def cast_failures(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Non-blank values per column whose safe cast is NULL, all columns in one scan."""
    failed = df.agg(
        *[F.count_if(rules.cast_failure(c, t)).alias(c) for c, t in types.items()]
    )
    return failed.unpivot([], list(types), "column", "failures")


def failed_values(df: DataFrame, types: Mapping[str, str], show: Sequence[str] = ()) -> DataFrame:
    """The failing cells themselves: (column, value, shown columns)."""
    hits = F.array_compact(
        F.array(
            *[
                F.when(
                    rules.cast_failure(c, t),
                    F.struct(F.lit(c).alias("column"), F.col(c).alias("value")),
                )
                for c, t in types.items()
            ]
        )
    )
    return df.select(*show, F.explode(hits).alias("_hit")).select("_hit.*", *show)


# --- measures for grouped star aggregation -------------------------------------------------------


def sum_if(predicate: Column) -> Column:
    return F.sum(F.when(predicate, 1).otherwise(0))


def star_agg(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*[c.alias(name) for name, c in measures.items()])


def totals_then_names(
    df: DataFrame,
    by_id: Sequence[str],
    sums: Mapping[str, Column],
    attach,
    by_name: Sequence[str],
    measures: Mapping[str, Column],
) -> DataFrame:
    """Aggregate by ids first, join the attributes to the small result, then aggregate by names.

    Sums and counts add up, so this equals joining first and aggregating once, while the joins
    see one row per id group instead of every detail row.
    """
    return star_agg(attach(star_agg(df, by_id, sums)), by_name, measures)
