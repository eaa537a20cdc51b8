"""Data-quality tests as DataFrames of violation counts."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """One test of one column. ``kind``: not_null, unique, range, values or relationship."""

    column: str
    kind: str
    severity: str = "error"
    low: float | None = None
    high: float | None = None
    values: tuple = ()
    parent: str = ""
    parent_column: str = ""

    @property
    def label(self) -> str:
        return f"{self.kind}_{self.column}"

    def broken(self) -> Column:
        """Row predicate of the kinds that need only the row itself; NULL passes all but not_null."""
        c = F.col(self.column)
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "values":
            return ~c.isin(list(self.values))
        too_low = c < self.low if self.low is not None else F.lit(False)
        too_high = c > self.high if self.high is not None else F.lit(False)
        return too_low | too_high


#: Tests that compare values; all others need only the row itself.
ON_VALUES = ("unique", "relationship")


def not_null(column: str, severity: str = "error") -> Check:
    return Check(column, "not_null", severity)


def unique(column: str, severity: str = "error") -> Check:
    return Check(column, "unique", severity)


def accepted_range(column: str, low=None, high=None, severity: str = "error") -> Check:
    return Check(column, "range", severity, low=low, high=high)


def accepted_values(column: str, values: Sequence, severity: str = "error") -> Check:
    return Check(column, "values", severity, values=tuple(values))


def relationship(column: str, parent: str, parent_column: str, severity: str = "error") -> Check:
    return Check(column, "relationship", severity, parent=parent, parent_column=parent_column)


def run_checks(
    name: str, df: DataFrame, checks: Sequence[Check], parents: Mapping[str, DataFrame]
) -> DataFrame:
    """(model, test, severity, violations) rows.

    The table is read once whatever the number of tests.
    """
    on_values = any(c.kind in ON_VALUES for c in checks)
    found = _violations(df, checks, parents) if on_values else _row_violations(df, checks)
    severity = F.create_map(*[F.lit(x) for c in checks for x in (c.label, c.severity)])
    return found.select(
        F.lit(name).alias("model"), "test", severity[F.col("test")].alias("severity"), "violations"
    )


def _row_violations(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    counted = df.agg(*[F.count_if(c.broken()).alias(c.label) for c in checks])
    return counted.unpivot([], [c.label for c in checks], "test", "violations")


def _violations(
    df: DataFrame, checks: Sequence[Check], parents: Mapping[str, DataFrame]
) -> DataFrame:
    """Broken rows, repeated values and values without a parent. NULL is not a value.

    A row gives its known values to the tests on values and, with a NULL, each row test it breaks.
    Equal ones of a test are counted before they meet the parents, so a frequent value is one row
    of the join.
    """
    tested = F.array(
        *[
            F.when(
                F.col(c.column).isNotNull() if c.kind in ON_VALUES else c.broken(),
                F.struct(
                    F.lit(c.label).alias("test"),
                    (F.col(c.column).cast("string") if c.kind in ON_VALUES
                     else F.lit(None).cast("string")).alias("value"),
                ),
            )
            for c in checks
        ]
    )
    values = (
        df.select(F.explode(F.array_compact(tested)).alias("v")).select("v.*")
        .groupBy("test", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    lost = F.lit(False)
    if any(c.kind == "relationship" for c in checks):
        known = functools.reduce(DataFrame.unionByName, _known_values(checks, parents))
        values = values.join(known.withColumn("known", F.lit(True)), ["test", "value"], "left")
        lost = F.col("known").isNull()
    kinds = {k: [c.label for c in checks if c.kind == k] for k in ON_VALUES}
    broken = (
        F.when(F.col("test").isin(kinds["unique"]), F.when(F.col("n") > 1, 1).otherwise(0))
        .when(F.col("test").isin(kinds["relationship"]), F.when(lost, F.col("n")).otherwise(0))
        .otherwise(F.col("n"))
    )
    found = values.groupBy("test").agg(F.sum(broken).alias("violations"))
    # A test without any value or broken row has no group and no violation.
    every = df.sparkSession.createDataFrame([(c.label,) for c in checks], "test string")
    return every.join(found, "test", "left").select(
        "test", F.coalesce("violations", F.lit(0)).alias("violations")
    )


def _known_values(checks: Sequence[Check], parents: Mapping[str, DataFrame]) -> list[DataFrame]:
    """Distinct parent values, labelled by test; a parent is read once for all tests it serves."""
    tests: dict[tuple[str, str], list[str]] = {}
    for c in checks:
        if c.kind == "relationship":
            tests.setdefault((c.parent, c.parent_column), []).append(c.label)
    return [
        parents[parent]
        .select(F.col(column).cast("string").alias("value")).distinct()
        .select(F.explode(F.array(*[F.lit(t) for t in labels])).alias("test"), "value")
        for (parent, column), labels in tests.items()
    ]


def with_status(report: DataFrame) -> DataFrame:
    return report.withColumn(
        "status",
        F.when(F.col("violations") == 0, "pass")
        .when(F.col("severity") == "warn", "warn")
        .otherwise("error"),
    )


class QualityError(RuntimeError):
    """At least one test of severity ``error`` found violations."""


def enforce(report: DataFrame) -> DataFrame:
    """Raise when a test failed; warnings pass. The report has one row per test."""
    failed = with_status(report).filter(F.col("status") == "error").collect()
    if failed:
        raise QualityError(
            "; ".join(f"{r['model']}.{r['test']}: {r['violations']}" for r in failed)
        )
    return report
