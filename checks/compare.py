"""Run registered queries next to their SQL: ``python -m checks.compare [sf_dir] [names...]``."""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks import catalog, standins
from checks.registry import ENTRIES, run_entry
from pitchlake.session import get_spark

# Seconds to build the query and to run it.
SECONDS: dict[str, tuple[float, float]] = {}
OTHER_TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in (*standins.BASE_TABLES, *OTHER_TABLES):
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def rows_of(columns: list[str], rows: list) -> tuple[list[str], list[str]]:
    """Column names in order and rows as sorted text, independent of column and row order."""
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    text = sorted(repr(tuple(row[k] for k in order)) for row in rows)
    return [columns[k] for k in order], text


def difference(spark: SparkSession, con, name: str, sf_dir: str) -> str | None:
    """None when both results are equal, otherwise the first difference."""
    entry = ENTRIES[name]
    started = time.monotonic()
    df = run_entry(entry, spark, sf_dir)
    planned = time.monotonic()
    rows = df.collect()
    SECONDS[name] = (planned - started, time.monotonic() - planned)
    if entry.sql is None:
        return None
    oracle = con.sql(entry.sql)
    a_cols, a = rows_of(df.columns, [tuple(r) for r in rows])
    b_cols, b = rows_of(list(oracle.columns), oracle.fetchall())
    if a_cols != b_cols:
        return f"columns {a_cols} against {b_cols}"
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"\n  spark {x}\n  sql   {y}"
    return None


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(catalog.names())
    spark = get_spark(
        "compare", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
        spark__ui__showConsoleProgress="false", spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        started = time.monotonic()
        try:
            found = difference(spark, con, name, sf_dir)
        except Exception as exc:  # noqa: BLE001 - report and go on
            found = f"{type(exc).__name__}: {str(exc)[:1500]}"
        seconds = time.monotonic() - started
        kind = "" if ENTRIES[name].sql else " (rows only)"
        build, run = SECONDS.get(name, (0.0, 0.0))
        state = "ok  " if found is None else "FAIL"
        print(
            f"{state} build {build:5.2f} run {run:5.2f} all {seconds:5.2f} {name}{kind} {found or ''}",
            flush=True,
        )
        failed += found is not None
    print(f"{len(names)} queries, {failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
