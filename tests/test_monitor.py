"""Figures taken on the way, and totals read from the state of a stream."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pitchlake.operators.quality import accepted_range, not_null, unique
from pitchlake.sources.messages import stream_parquet
from pitchlake.streaming import live, monitor, sinks, stateful
from conftest import rows

SCHEMA = "id int, v int"


def test_a_write_counts_its_rows_and_violations(spark, tmp_path):
    df = spark.createDataFrame([(1, 5), (2, None), (None, 900)], SCHEMA)
    tests = [not_null("id"), not_null("v", "warn"), accepted_range("v", 0, 10)]
    report = monitor.observed_write(df, "t", tests, lambda x: x.write.parquet(str(tmp_path / "t")))
    assert rows(report) == [
        ("t", "not_null_id", "error", 1), ("t", "not_null_v", "warn", 1), ("t", "range_v", "error", 1),
        ("t", "rows", "info", 3)]
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    with pytest.raises(ValueError):
        monitor.observed_write(df, "t", [unique("id")], lambda x: None)


def test_progress_of_good_and_failed_queries(spark, tmp_path):
    df = spark.createDataFrame([(i, i % 4) for i in range(20)], SCHEMA)
    df.repartition(2).write.parquet(str(tmp_path / "in"))
    listener = monitor.ProgressTable(spark, str(tmp_path / "progress"))
    spark.streams.addListener(listener)
    try:
        stream = stream_parquet(spark, str(tmp_path / "in"), df.schema, 1)
        good = monitor.observed_stream(stream, [accepted_range("v", 1)])
        sinks.sink_parquet(good, str(tmp_path / "out"), str(tmp_path / "c1"), None).awaitTermination()
        bad = stream.select(F.raise_error(F.lit("broken")).cast("string").alias("x"))
        with pytest.raises(Exception, match="broken"):
            sinks.sink_parquet(bad, str(tmp_path / "out2"), str(tmp_path / "c2"), None).awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    table = listener.read()
    found = table.where("error is null").agg(
        F.sum("rows"), F.sum("input_rows"), F.sum(F.col("violations")["range_v"])).first()
    assert tuple(found) == (20, 20, 5)
    assert table.where("error is not null").count() == 1


def test_live_totals_from_the_state(spark, tmp_path):
    now = dt.datetime(2024, 5, 1, 20, 0)
    data = [("goals", "1", "Home", "goals", "L", now - dt.timedelta(minutes=m))
            for m in (1, 1, 30, 119, 121, 300)]
    data += [("cards", "1", "Home", "cards", "L", now - dt.timedelta(minutes=5)),
             ("goals", "2", "Away", "goals", "L", now - dt.timedelta(minutes=5))]
    names = "measurement string, game_id string, club_name string, event_type string, " \
            "competition_name string, time timestamp"
    points = spark.createDataFrame(data, names)
    points.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = stateful.recent_counts(
        stream_parquet(spark, str(tmp_path / "in"), points.schema), "time", live.SERIES, "3 hours")
    sinks.with_trigger(
        stream.writeStream.outputMode("update").format("noop"), str(tmp_path / "c"), None
    ).start().awaitTermination()
    state = stateful.state_counts(spark, str(tmp_path / "c"), live.SERIES)
    assert state.count() == 6  # the point of five hours ago has left it; two share a minute
    assert rows(live.live_score_from_state(state, "Home", now)) == [("1", "Home", "goals", "L", 4)]
