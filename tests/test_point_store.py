"""Open and closed days of a point store."""

import datetime as dt

from pyspark.sql import functions as F

from pitchlake.streaming.store import PointStore

DAY1, DAY2 = dt.date(2024, 5, 1), dt.date(2024, 5, 2)


def batch(spark, store, n, rows):
    at = {DAY1: dt.datetime(2024, 5, 1, 12), DAY2: dt.datetime(2024, 5, 2, 12)}
    spark.createDataFrame(
        [(f"Club {i % 20:02}", "goals" if i % 3 else "cards", at[d] + dt.timedelta(seconds=i), d, i, n)
         for d, i in rows],
        "club_name string, measurement string, time timestamp, point_date date, id int, batch_id long",
    ).repartition(4).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "point_date", "batch_id").parquet(store.open_path)


def ids(df):
    return sorted(r.id for r in df.collect())


def test_compaction_loses_nothing(spark, tmp_path):
    store = PointStore(spark, str(tmp_path / "p"))
    batch(spark, store, 0, [(DAY1, i) for i in range(100)])
    batch(spark, store, 1, [(DAY1, i) for i in range(100, 150)] + [(DAY2, 900)])
    everything = [*range(150), 900]
    early = store.read()  # a reader that has listed its files
    assert store.compact(DAY2) == [DAY1] and store.compact(DAY2) == []
    assert ids(early) == ids(store.read()) == everything
    batch(spark, store, 2, [(DAY1, 500), (DAY2, 901)])  # late for a closed day
    assert ids(store.read()) == [*everything[:-1], 500, 900, 901]
    assert ids(store.read((DAY2, DAY2))) == [900, 901]
    before = store.read()
    assert store.compact(DAY2) == [DAY1] and store.closed_days() == {DAY1: 2}
    assert ids(before) == ids(store.read())
    store.clean()
    assert ids(store.read()) == [*range(150), 500, 900, 901]
    assert not store.folder.names(f"open/point_date={DAY1}")
    assert store.folder.names(f"closed/point_date={DAY1}") == ["upto=2"]
    batch(spark, store, 2, [(DAY2, 901)])  # a repeated batch replaces itself
    assert ids(store.read()) == [*range(150), 500, 900, 901]


def test_closed_files_are_sorted_by_club(spark, tmp_path):
    store = PointStore(spark, str(tmp_path / "p"))
    batch(spark, store, 0, [(DAY1, i) for i in range(4000)])
    store.compact(DAY2)
    rows = store.read((DAY1, DAY1)).where("club_name = 'Club 07'")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(club_name,Club 07)" in plan and "PartitionFilters" in plan
    where = F.col("_metadata.file_path")
    all_files = spark.read.parquet(f"{store.path}/closed").select(where).distinct().count()
    holding = spark.read.parquet(f"{store.path}/closed").where("club_name = 'Club 07'").select(
        where).distinct().count()
    assert rows.count() == 200 and holding <= max(1, all_files // 2)
