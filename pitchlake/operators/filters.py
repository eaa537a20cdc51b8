"""Row filters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.functions import rules

EPOCH = dt.datetime(1970, 1, 1)


def keep_between(df: DataFrame, name: str, low, high, keep_null: bool = False) -> DataFrame:
    return df.filter(rules.between(name, low, high, keep_null))


def keep_nonblank(df: DataFrame, name: str) -> DataFrame:
    return df.filter(rules.nonblank(name))


def keep_true(df: DataFrame, flag: str) -> DataFrame:
    return df.filter(F.col(flag))


def keep_in(df: DataFrame, name: str, values: Sequence) -> DataFrame:
    return df.filter(rules.keep_in(name, values))


def last_hours(df: DataFrame, name: str, hours: int, now: dt.datetime | None = None) -> DataFrame:
    return df.filter(rules.within_last(name, hours, now))


def since_last(df: DataFrame, target: DataFrame | None, ts: str) -> DataFrame:
    """Rows newer than the newest row of ``target``; all rows when there is no target yet.

    The newest time is a scalar subquery, so it is computed once and pushed to the scan.
    """
    if target is None:
        return df
    newest = target.agg(F.coalesce(F.max(ts), F.lit(EPOCH).cast("timestamp"))).scalar()
    return df.filter(F.col(ts) > newest)


def regex_violations(
    df: DataFrame, patterns: Mapping[str, str], show: Sequence[str] = ()
) -> DataFrame:
    """Rows with a non-blank value outside its pattern, as (column, value, shown columns)."""
    return _violations(
        df, {name: rules.bad_format(name, p) for name, p in patterns.items()}, show, with_value=True
    )


def rule_violations(
    df: DataFrame, broken: Mapping[str, Column], show: Sequence[str] = ()
) -> DataFrame:
    """Rows that break a named rule, one row per broken rule, in one scan."""
    return _violations(df, broken, show, with_value=False)


def _violations(df, broken, show, with_value):
    label = "column" if with_value else "rule"
    hits = F.array_compact(
        F.array(
            *[
                F.when(
                    predicate,
                    F.struct(
                        F.lit(name).alias(label),
                        *([F.col(name).alias("value")] if with_value else []),
                    ),
                )
                for name, predicate in broken.items()
            ]
        )
    )
    return df.select(*show, F.explode(hits).alias("_hit")).select("_hit.*", *show)


def rule_counts(df: DataFrame, broken: Mapping[str, Column]) -> DataFrame:
    """Violations per rule in one aggregate over one scan."""
    counted = df.agg(*[F.count_if(p).alias(name) for name, p in broken.items()])
    return counted.unpivot([], list(broken), "rule", "violations")
