"""Points of many batches as a store: open days by batch, closed days in few sorted files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.operators.stored import Folder
from pitchlake.streaming.sinks import write_points

#: What the files of a closed day are sorted by, so that their statistics name few of them.
LAYOUT = ("club_name", "measurement", "time")


class PointStore:
    """Points below ``path``: ``open/point_date=…/batch_id=…`` and ``closed/point_date=…/upto=…``.

    ``compact`` writes the points of past days once more, sorted by club and kind, and then marks
    the day with the last batch that it holds. Readers take a day's closed files and the open
    batches after them, so a late batch is seen at once, and a reader that started before a
    compaction still finds its files: ``clean`` removes them later.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.open_path = f"{self.path}/open"
        self.folder = Folder(spark, path)

    def writer(self, time: str = "_silver_processed_at"):
        """For ``foreachBatch``."""
        return write_points(self.open_path, time)

    def closed_days(self) -> dict[dt.date, int]:
        """The last batch in the closed files of each day: a mark a day."""
        out: dict[dt.date, int] = {}
        for name in self.folder.names("done"):
            day, upto = name.split("_")
            out[dt.date.fromisoformat(day)] = max(int(upto), out.get(dt.date.fromisoformat(day), -1))
        return out

    def _after(self, closed: dict[dt.date, int]) -> Column:
        """Open batches that no closed file holds."""
        if not closed:
            return F.lit(True)
        held = F.lit(False)
        for day, upto in closed.items():
            held = held | ((F.col("point_date") == F.lit(day)) & (F.col("batch_id") <= upto))
        return ~held

    def _closed(self, closed: dict[dt.date, int]) -> DataFrame | None:
        if not closed:
            return None
        newest = F.lit(False)
        for day, upto in closed.items():
            newest = newest | ((F.col("point_date") == F.lit(day)) & (F.col("upto") == upto))
        return self.spark.read.parquet(f"{self.path}/closed").where(newest)

    def read(self, days: tuple[dt.date, dt.date] | None = None) -> DataFrame:
        """All points, or those of the days from the first to the last of ``days``."""
        closed = self.closed_days()
        if days is not None:
            closed = {d: n for d, n in closed.items() if days[0] <= d <= days[1]}
        inside = F.lit(True) if days is None else F.col("point_date").between(*map(F.lit, days))
        rows = self.spark.read.parquet(self.open_path).where(inside & self._after(closed)).drop(
            "batch_id")
        merged = self._closed(closed)
        return rows if merged is None else rows.unionByName(merged.drop("upto"))

    def compact(self, before: dt.date) -> list[dt.date]:
        """Close the days before ``before``; days with late batches are closed again."""
        closed = self.closed_days()
        waiting = (
            self.spark.read.parquet(self.open_path).where(F.col("point_date") < F.lit(before))
            .where(self._after(closed)).groupBy("point_date").agg(F.max("batch_id").alias("upto"))
            .collect())  # a row a day
        if not waiting:
            return []
        target = {r.point_date: r.upto for r in waiting}
        upto = F.create_map(*[x for d, n in target.items() for x in (F.lit(d), F.lit(n))])
        # A batch that arrives from now on is after its day's mark and stays open.
        rows = self.spark.read.parquet(self.open_path).where(
            F.col("point_date").isin(list(target)) & self._after(closed)
            & (F.col("batch_id") <= upto[F.col("point_date")])).drop("batch_id")
        older = self._closed({d: n for d, n in closed.items() if d in target})
        if older is not None:
            rows = rows.unionByName(older.drop("upto"))
        rows.withColumn("upto", upto[F.col("point_date")]).repartitionByRange(
            "point_date", *LAYOUT).sortWithinPartitions("point_date", *LAYOUT).write.mode(
            "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "point_date", "upto").parquet(f"{self.path}/closed")
        for day, last in target.items():
            self.folder.mark(f"done/{day}_{last}")
        return sorted(target)

    def clean(self) -> None:
        """Remove open batches and older closed files that no new reader needs."""
        for day, upto in self.closed_days().items():
            for part, name in (("open", "batch_id"), ("closed", "upto")):
                at = f"{part}/point_date={day}"
                for found in self.folder.names(at):
                    n = int(found.removeprefix(f"{name}=")) if found.startswith(f"{name}=") else None
                    if n is not None and (n <= upto if part == "open" else n < upto):
                        self.folder.delete(f"{at}/{found}")
            for mark in self.folder.names("done"):
                if mark.startswith(f"{day}_") and mark != f"{day}_{upto}":
                    self.folder.delete(f"done/{mark}")
