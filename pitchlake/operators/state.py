"""Tables that change over time: keyed upsert, history, and runs over many tables."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.functions.keys import surrogate_key
from pitchlake.operators.filters import since_last
from pitchlake.operators.scale import first_rows


#: How stored tables are written: surrogate keys are random hexadecimal digits, which take half the
#: space behind an entropy coder and all of it behind the default codec. Version 2 of the format
#: stores the lengths and beginnings of texts, and the steps between numbers, by themselves.
STORED = {"compression": "zstd", "parquet.writer.version": "v2"}


def merge_upsert(
    target: DataFrame,
    delta: DataFrame,
    key: Sequence[str],
    newest_first: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Rows of ``delta`` replace rows with the same key or are added; other rows stay.

    Written as anti join and union, so a delta that AQE finds small is broadcast and the target
    is not shuffled. ``newest_first`` picks the row to use when a key repeats in the delta.
    """
    if newest_first is not None:
        delta = first_rows(delta, key, newest_first)
    keys = delta.select(*key)
    return target.join(keys, list(key), "left_anti").select(*target.columns).unionByName(
        delta.select(*target.columns)
    )


def history_rows(
    current: DataFrame | None,
    source: DataFrame,
    key: str,
    check_columns: Sequence[str],
    run_ts: dt.datetime,
) -> DataFrame:
    """What becomes of the open rows: each pair with a source row yields its one or two rows."""
    now = F.lit(run_ts).cast("timestamp")
    opened = source.select(
        "*",
        now.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        now.alias("updated_at"),
        surrogate_key(F.col(key), now).alias("scd_id"),
    )
    if current is None:
        return opened
    columns = opened.columns
    old = current.select(F.struct(*columns).alias("old"))
    fresh = opened.select(F.struct(*columns).alias("new"))
    pairs = old.join(fresh, F.col(f"old.{key}") == F.col(f"new.{key}"), "full")
    same = F.lit(True)
    for c in check_columns:
        same = same & F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    ended = F.col("old").withField("valid_to", now).withField("updated_at", now)
    rows = (
        F.when(F.col("old").isNull(), F.array("new"))
        .when(F.col("new").isNull() | same, F.array("old"))
        .otherwise(F.array(ended, F.col("new")))
    )
    return pairs.select(F.explode(rows).alias("r")).select("r.*")


def scd2_check(
    history: DataFrame | None,
    source: DataFrame,
    key: str,
    check_columns: Sequence[str],
    run_ts: dt.datetime,
) -> DataFrame:
    """Next version of a type-2 history.

    New key: open row. Any check column changed (NULL-safe): close the open row, open a new one.
    Unchanged, or missing in the source: kept as it is. Only open rows take part in the join.
    """
    if history is None:
        return history_rows(None, source, key, check_columns, run_ts)
    current = history.filter(F.col("valid_to").isNull())
    rows = history_rows(current, source, key, check_columns, run_ts)
    return history.filter(F.col("valid_to").isNotNull()).select(*rows.columns).unionByName(rows)


class VersionedTable:
    """A Parquet table as numbered versions below ``path``.

    A version counts once its ``_SUCCESS`` marker exists, so a failed write is never read and a
    table is never overwritten while it is being read.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _fs(self):
        jvm = self.spark._jvm
        hadoop_path = jvm.org.apache.hadoop.fs.Path(self.path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def versions(self) -> list[int]:
        fs, root = self._fs()
        if not fs.exists(root):
            return []
        found = []
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            marker = self.spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            if name.startswith("v=") and fs.exists(marker):
                found.append(int(name[2:]))
        return sorted(found)

    def read(self) -> DataFrame | None:
        versions = self.versions()
        if not versions:
            return None
        return self.spark.read.parquet(f"{self.path}/v={versions[-1]}")

    def write(self, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        nxt = (self.versions() or [0])[-1] + 1
        writer = df.write.mode("overwrite").options(**STORED)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.path}/v={nxt}")
        return self.read()

    def expire(self, keep: int = 2) -> None:
        """Remove all but the newest versions."""
        fs, _ = self._fs()
        for version in self.versions()[:-keep]:
            fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v={version}"), True)

    def merge(
        self,
        delta: DataFrame,
        key: Sequence[str],
        newest_first: Sequence[Column | str] | None = None,
        partition_by: Sequence[str] = (),
    ) -> DataFrame:
        current = self.read()
        if current is None:
            merged = first_rows(delta, key, newest_first) if newest_first else delta
        else:
            merged = merge_upsert(current, delta, key, newest_first)
        return self.write(merged, partition_by)


def build_incremental(
    table: VersionedTable, rows: DataFrame, key: Sequence[str], ts: str = "loaded_at"
) -> DataFrame:
    """First run: all rows. Later runs: only rows newer than the table, merged by key."""
    return table.merge(
        since_last(rows, table.read(), ts), key, newest_first=[F.desc(ts), *rows.drop(ts).columns]
    )


def snapshot(
    table: VersionedTable, source: DataFrame, key: str, check_columns: Sequence[str], run_ts
) -> DataFrame:
    return table.write(scd2_check(table.read(), source, key, check_columns, run_ts))


def merge_partitions(
    spark: SparkSession,
    path: str,
    stage: str,
    delta: DataFrame,
    key: Sequence[str],
    partition: str,
) -> None:
    """Upsert into a table partitioned by ``partition``, rewriting only touched partitions.

    Touched are the partitions of the delta and those that hold an older row of its keys. The new
    content is first written to ``stage``, a path that names this delta. A run that was broken
    off is repeated with the same ``stage``: once staged, only the publishing is done again.
    """
    # The delta is used several times, so it is written down once; a repeated run reads it again.
    staged_delta = VersionedTable(spark, f"{stage}/delta")
    if staged_delta.read() is None:
        staged_delta.write(delta)
    delta = staged_delta.read()
    target = spark.read.parquet(path)
    held = target.select(*key, partition).join(delta.select(*key), list(key), "left_semi")
    staging = VersionedTable(spark, f"{stage}/rows")
    if staging.read() is None:
        touched = _values(held.select(partition).union(delta.select(partition)))
        staging.write(merge_upsert(target.filter(_any_of(partition, touched)), delta, key))
    staged = staging.read()
    # Every row of these partitions has moved elsewhere, so no new content replaces their files.
    filled = _values(staged.select(partition))
    emptied = [v for v in _values(held.select(partition)) if v not in filled]
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "")
    stale = _values(target.filter(_any_of(partition, emptied)).select(folder)) if emptied else []
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        partition
    ).parquet(path)
    jvm = spark._jvm
    for partition_folder in stale:
        old = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(partition_folder))
        old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)


def build_partitions(
    spark: SparkSession,
    path: str,
    stage: str,
    rows: DataFrame,
    key: Sequence[str],
    partition: str,
    ts: str = "loaded_at",
) -> DataFrame:
    """Incremental build of a large table: later runs rewrite only the partitions they touch."""
    newest = [F.desc(ts), *rows.drop(ts).columns]
    if not path_exists(spark, path):
        # Files without the mark of a completed write are those of a first build that broke off.
        first_rows(rows, key, newest).write.mode("overwrite").partitionBy(partition).parquet(path)
    else:
        delta = first_rows(since_last(rows, spark.read.parquet(path), ts), key, newest)
        merge_partitions(spark, path, stage, delta, key, partition)
    return spark.read.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def _values(one_column: DataFrame) -> list:
    """Distinct partition values: one per partition of the table."""
    return [r[0] for r in one_column.distinct().collect()]


def _any_of(column: str, values: list) -> Column:
    known = F.col(column).isin([v for v in values if v is not None])
    return known | F.col(column).isNull() if None in values else known


RUN_SCHEMA = "table string, status string, seconds double, rows bigint, error string"


def run_tables(
    spark: SparkSession, jobs: Mapping[str, Callable[[], DataFrame]], at_once: int = 1
) -> DataFrame:
    """Run named jobs; a failure is recorded and the other jobs still run.

    Each job writes its table and returns it; the result has one row per job. With ``at_once``
    above 1 independent tables share the cluster, so the tail of one does not idle it.
    """

    def run(name: str) -> tuple:
        started = time.monotonic()
        try:
            rows, status, error = jobs[name]().count(), "ok", None
        except Exception as exc:  # noqa: BLE001 - every failure belongs in the report
            rows, status, error = None, "failed", str(exc).splitlines()[0]
        return name, status, time.monotonic() - started, rows, error

    if at_once == 1:
        results = [run(name) for name in jobs]
    else:
        with ThreadPoolExecutor(at_once) as pool:
            results = list(pool.map(inheritable_thread_target(spark)(run), jobs))
    return spark.createDataFrame(results, RUN_SCHEMA)
