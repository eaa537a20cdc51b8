"""Stored tables that later runs extend: keyed tables with row fingerprints, and type-2 histories."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.operators.scale import first_rows, null_safe_on
from pitchlake.operators.state import STORED, VersionedTable, history_rows


class Folder:
    """A path of any Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, name: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def has(self, name: str) -> bool:
        fs, where = self._at(name)
        return fs.exists(where)

    def names(self, name: str = "") -> list[str]:
        fs, where = self._at(name)
        if not fs.exists(where):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(where))

    def mark(self, name: str) -> None:
        """An empty file, which exists as a whole or not at all."""
        fs, where = self._at(name)
        fs.create(where, True).close()

    def delete(self, name: str) -> None:
        fs, where = self._at(name)
        fs.delete(where, True)


def fingerprint(df: DataFrame, without: Sequence[str] = ()) -> Column:
    """A hash of all columns but ``without``, and of which of them are NULL.

    The hash alone passes over NULLs, so a value that moves from one column to a NULL beside it
    would go unseen.
    """
    names = sorted(c for c in df.columns if c not in without)
    return F.xxhash64(*names, *[F.col(c).isNull() for c in names])


def packed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The frame with the named texts as bytes: 32 hexadecimal digits as 16, any other text whole.

    The first byte says which it is. A shuffle's codec finds nothing to save in random digits.
    """
    def pack(name: str) -> Column:
        text = F.col(name)
        key = F.unhex(text)
        return F.when(
            (F.length(text) == 32) & (F.lower(F.hex(key)) == text), F.concat(F.lit(b"\x01"), key)
        ).otherwise(F.concat(F.lit(b"\x00"), text.cast("binary")))

    return df.withColumns({name: pack(name) for name in names})


def unpacked(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The texts that were ``packed``."""
    def unpack(name: str) -> Column:
        rest = F.substr(F.col(name), F.lit(2))
        first = F.substr(F.col(name), F.lit(1), F.lit(1))
        return F.when(first == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))

    return df.withColumns({name: unpack(name) for name in names})


class KeyedTable:
    """A Parquet table with one row per key, in hash buckets of the key.

    Each row carries a fingerprint of its columns. A run compares incoming rows with keys and
    fingerprints only, so no load time has to be trusted: equal rows stay as they are, with their
    first load time, and only buckets with new or different rows are written, by Spark's dynamic
    partition overwrite. A run has a name and is done once: what it will write is first staged
    below ``runs``, so a run that broke off at any point is repeated under its name and goes on from
    there, and one that was completed changes nothing.

    ``buckets`` counts for a new table; a stored one keeps its own. ``unstable`` columns, such as
    load times, don't make a row different. Rows with NULL in the key count as one key.
    """

    def __init__(
        self, spark: SparkSession, path: str, key: Sequence[str], buckets: int = 32,
        unstable: Sequence[str] = ("loaded_at",),
    ):
        self.spark, self.key, self.unstable = spark, list(key), tuple(unstable)
        self.folder = Folder(spark, path)
        stored = [n for n in self.folder.names() if n.startswith("buckets=")]
        self.buckets = int(stored[0].removeprefix("buckets=")) if stored else buckets
        self.rows_path = f"{self.folder.path}/buckets={self.buckets}"

    def _stored(self) -> DataFrame | None:
        if not self.folder.has(f"buckets={self.buckets}/_SUCCESS"):
            return None
        return self.spark.read.parquet(self.rows_path)

    def read(self) -> DataFrame | None:
        """The rows, or None before the first run."""
        stored = self._stored()
        return None if stored is None else stored.drop("_fingerprint", "_bucket")

    def _marked(self, rows: DataFrame) -> DataFrame:
        own = fingerprint(rows, self.unstable)
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")
        return rows.withColumns({"_fingerprint": own, "_bucket": bucket})

    def _prepared(self, rows: DataFrame, newest_first: Sequence[Column | str]) -> DataFrame:
        order = [*newest_first, *[c for c in rows.columns if c not in self.key]] or self.key
        return first_rows(self._marked(rows), self.key, order)

    def _without_repeats(
        self, rows: DataFrame, newest_first: Sequence[Column | str], stage: str
    ) -> DataFrame:
        """The rows of a first run; only keys, and whole rows of repeated keys, are shuffled for it."""
        repeated = self._staged(f"{stage}/repeated", lambda: rows.groupBy(*self.key).agg(
            F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*self.key))
        if repeated.isEmpty():
            return self._marked(rows)
        twice = repeated.select(*[F.col(k).alias(f"_r_{k}") for k in self.key])
        on = null_safe_on(rows, twice, [(k, f"_r_{k}") for k in self.key])
        return self._marked(rows.join(twice, on, "left_anti")).unionByName(
            self._prepared(rows.join(twice, on, "left_semi"), newest_first))

    def changes(self, rows: DataFrame, newest_first: Sequence[Column | str] = ()) -> DataFrame:
        """The incoming rows whose key is new or whose fingerprint differs from the stored one."""
        return self._different(self._prepared(rows, newest_first))

    def _different(self, incoming: DataFrame, buckets: Sequence[int] | None = None) -> DataFrame:
        stored = self._stored()
        if stored is None:
            return incoming
        if buckets is not None:
            stored = stored.where(F.col("_bucket").isin(list(buckets)))
        known = stored.select(
            *[F.col(k).alias(f"_k_{k}") for k in self.key], F.col("_fingerprint").alias("_known"))
        on = null_safe_on(incoming, known, [(k, f"_k_{k}") for k in self.key])
        joined = incoming.join(known, on, "left")
        return joined.where(~F.col("_known").eqNullSafe(F.col("_fingerprint"))).select(
            *incoming.columns)

    def _changed_keys(self, rows: DataFrame) -> DataFrame:
        """The keys of which some incoming row is not stored as it is.

        Only keys and fingerprints are shuffled; whole rows then are those of these keys.
        """
        own = rows.select(*self.key, fingerprint(rows, self.unstable).alias("_fingerprint"))
        return self._different(own).select(*self.key).distinct()

    def _dealt(self, rows: DataFrame, marked: bool) -> DataFrame:
        """The rows by bucket; if not ``marked`` so far, fingerprints are made behind the shuffle.

        Columns that are named like keys are shuffled as bytes, whatever they hold.
        """
        keys = [f.name for f in rows.schema if f.dataType == T.StringType() and (
            f.name in self.key or f.name.startswith("sk_") or f.name.endswith("_key"))]
        narrow = packed(rows if marked else rows.drop("_fingerprint"), keys)
        dealt = unpacked(narrow.hint("rebalance", "_bucket"), keys)
        if not marked:
            own = fingerprint(dealt, (*self.unstable, "_bucket"))
            dealt = dealt.withColumn("_fingerprint", own)
        return dealt.select(*rows.columns)

    def _write(self, rows: DataFrame, marked: bool = True, **options) -> None:
        writer = self._dealt(rows, marked).write.mode("overwrite").options(**STORED, **options)
        writer.partitionBy("_bucket").parquet(self.rows_path)

    def _staged(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """``make()`` written below the run's folder; a repeated run reads what is there."""
        path = f"{self.folder.path}/{name}"
        if not self.folder.has(f"{name}/_SUCCESS"):
            make().write.mode("overwrite").options(**STORED).parquet(path)
        return self.spark.read.parquet(path)

    def upsert(
        self, rows: DataFrame, run: str, newest_first: Sequence[Column | str] = (),
        few: bool = False, reread: bool = False,
    ) -> DataFrame:
        """Add new rows and replace different ones; of a repeated key the newest row counts.

        ``few`` rows, as of a stream's batch, are written down first, so that only their own buckets
        are compared and not the keys of the whole table. ``reread`` says that ``rows`` come from
        stored tables and are cheap to read twice: a first run then looks for repeated keys by
        themselves, and otherwise orders all rows by key before they are dealt to their buckets.
        """
        stage, done = f"runs/{run}", f"done/{run}"
        if self.folder.has(done):
            return self.read()
        if self._stored() is None:
            self._write(
                self._without_repeats(rows, newest_first, stage) if reread
                else self._prepared(rows, newest_first), marked=False)
        else:
            def different() -> DataFrame:
                if not few:
                    keys = self._staged(f"{stage}/keys", lambda: self._changed_keys(rows))
                    new = keys.select(*[F.col(k).alias(f"_c_{k}") for k in self.key])
                    on = null_safe_on(rows, new, [(k, f"_c_{k}") for k in self.key])
                    return self.changes(rows.join(new, on, "left_semi"), newest_first)
                incoming = self._staged(
                    f"{stage}/incoming", lambda: self._prepared(rows, newest_first))
                return self._different(incoming, self._buckets_of(incoming))

            delta = self._staged(f"{stage}/delta", different)
            touched = self._buckets_of(delta)
            if touched:
                def content() -> DataFrame:
                    stored = self._stored().where(F.col("_bucket").isin(touched))
                    new = delta.select(*[F.col(k).alias(f"_k_{k}") for k in self.key])
                    on = null_safe_on(stored, new, [(k, f"_k_{k}") for k in self.key])
                    return stored.join(new, on, "left_anti").unionByName(
                        delta.select(*stored.columns))

                self._write(
                    self._staged(f"{stage}/rows", content), partitionOverwriteMode="dynamic")
        self.folder.mark(done)
        self.folder.delete(stage)
        return self.read()

    def _buckets_of(self, rows: DataFrame) -> list[int]:
        """At most as many numbers as there are buckets."""
        return [r[0] for r in rows.select("_bucket").distinct().collect()]

    def forget_runs(self, names: Sequence[str]) -> None:
        """Drop the marks of runs that can't be repeated any more."""
        for name in names:
            self.folder.delete(f"done/{name}")


class HistoryTable:
    """A type-2 history in an open and a closed part.

    A run writes its open rows and the rows that it closes to partitions of its own, in one job, and
    counts once its mark exists. Closed files are never written again; the open part of the run
    before is removed after the mark. A run is named by its time: repeating a completed one changes
    nothing, and what a broken one left behind is removed before the next.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.folder = Folder(spark, path)

    def runs(self) -> list[str]:
        """Completed runs, oldest first."""
        return self.folder.names("done")

    def _part(self, state: str, runs: Sequence[str]) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder.path}/rows").where(
            (F.col("state") == state) & F.col("run").isin(list(runs)))

    def open_rows(self) -> DataFrame | None:
        runs = self.runs()
        return self._part("open", runs[-1:]).drop("state", "run") if runs else None

    def read(self) -> DataFrame | None:
        """Open and closed rows, or None before the first run."""
        runs = self.runs()
        if not runs:
            return None
        closed = self._part("closed", runs).drop("state", "run")
        return closed.unionByName(self.open_rows())

    def snapshot(
        self, source: DataFrame, key: str, check_columns: Sequence[str], run_ts: dt.datetime
    ) -> DataFrame:
        """Compare ``source`` with the open rows; see ``scd2_check`` for the rules."""
        run, runs = run_ts.strftime("r%Y%m%dT%H%M%S%f"), self.runs()
        if run in runs:
            return self.read()
        if runs and run < runs[-1]:
            raise ValueError(f"{run} is older than {runs[-1]}")
        for state in self.folder.names("rows"):
            for left in self.folder.names(f"rows/{state}"):
                if left.startswith("run=") and left.removeprefix("run=") not in runs:
                    self.folder.delete(f"rows/{state}/{left}")
        rows = history_rows(self.open_rows(), source, key, check_columns, run_ts)
        state = F.when(F.col("valid_to").isNull(), "open").otherwise("closed")
        rows.withColumn("state", state).withColumn("run", F.lit(run)).write.mode(
            "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "state", "run").parquet(f"{self.folder.path}/rows")
        self.folder.mark(f"done/{run}")
        for old in runs[-1:]:
            self.folder.delete(f"rows/state=open/run={old}")
        return self.read()


def materialize(
    df: DataFrame | None, name: str, kind: str, path: str | None = None,
    key: Sequence[str] | None = None, run: str | None = None, spark: SparkSession | None = None,
    reread: bool = False,
) -> DataFrame:
    """Store ``df`` as its kind asks for and return what later models read.

    ``view``: a lazy temporary view. ``table``: a new version below ``path``; the one before stays
    for its readers. ``merge``: new and different rows of ``df`` by ``key``, under the name ``run``;
    ``reread`` as for ``KeyedTable.upsert``.
    Without ``df`` what is stored is returned.
    """
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    if kind not in ("table", "merge") or path is None or (kind == "merge") != (key is not None):
        raise ValueError(f"{name}: 'view', 'table' with a path, or 'merge' with a path and a key")
    spark = spark or df.sparkSession
    if kind == "merge":
        table = KeyedTable(spark, path, key)
        return table.read() if df is None else table.upsert(
            df, run or uuid.uuid4().hex, reread=reread)
    table = VersionedTable(spark, path)
    if df is not None:
        table.write(df)
        table.expire()
    return table.read()
