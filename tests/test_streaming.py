import datetime as dt
import json

from pyspark.sql import functions as F

from checks import catalog  # noqa: F401 - importing registers the queries
from checks.registry import ENTRIES, run_entry
from pitchlake.operators.reshape import union_stream
from pitchlake.operators.stored import KeyedTable
from pitchlake.sources import files, messages
from pitchlake.sources.messages import stream_parquet
from pitchlake.streaming import events as ev
from pitchlake.streaming import live, sinks, stateful
from pitchlake.streaming.schemas import BRONZE_SCHEMA, EVENT_SCHEMA, SILVER_SCHEMA
from conftest import rows

NOW = dt.datetime(2024, 5, 1, 20, 0)
CASES = [
    '{"game_event_id":"e1","game_id":"7","minute":12,"event_type":" Goals ","description":"3. Goal, Header"}',
    '{"game_event_id":"e2","game_id":"7","minute":121,"event_type":"Shootout","description":"Scored"}',
    '{"game_event_id":"e3","game_id":"7","minute":131}',
    '{"game_event_id":"e4","game_id":"7.0","minute":5}',
    '{"game_event_id":"e5","game_id":"7","minute":0,"description":null}',
    "not json",
    '{"game_event_id":"e6","game_id":7,"minute":45.0,"attendance":""}',
    '{"game_id":"7","minute":4}',
]


def raw(spark, lines=CASES):
    return ev.raw_ingest(spark.createDataFrame([(x,) for x in lines], "value string"), now=NOW)


def test_parse_cases(spark):
    out = ev.parse_events(raw(spark), now=NOW)
    got = rows(out.select("game_event_id", "minute", "event_type", "description", "season_count",
                          "penalty_result", "player_name"))
    assert got == [
        ("e1", 12, "goals", "3. Goal, Header", 3, None, "Unknown"),
        ("e2", 121, "shootout", "Scored", None, "scored", "Unknown"),
        ("e5", 0, None, "Unknown", None, None, "Unknown"),
        ("e6", 45, None, "Unknown", None, None, "Unknown"),
    ]
    lenient = ev.parse_events(raw(spark), ids_via_double=True)
    assert "e4" in {r["game_event_id"] for r in lenient.collect()}


def test_schemas_agree(spark):
    assert len(EVENT_SCHEMA) == 46 and len(SILVER_SCHEMA) == 52
    assert raw(spark).schema.names == BRONZE_SCHEMA.names
    parsed = {f.name: f.dataType for f in ev.parse_events(raw(spark)).schema}
    assert parsed == {f.name: f.dataType for f in SILVER_SCHEMA}


def test_parsing_happens_once_per_message(spark, tmp_path):
    raw(spark).write.parquet(str(tmp_path / "b"))
    parsed = ev.parse_events(spark.read.parquet(str(tmp_path / "b")))
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_messages_keep_nulls(spark):
    df = spark.createDataFrame([("45", 3.0, None)], "minute string, club_id double, player_name string")
    sent = json.loads(ev.to_event_json(df, now=NOW).first()["value"])
    assert sent["minute"] == 45 and sent["club_id"] == 3 and sent["player_name"] is None
    assert {"_ingested_at", "_source", "_pipeline"} <= set(sent)


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_path):
    topic, bronze, silver = (str(tmp_path / x) for x in ("topic", "bronze", "silver"))
    spark.createDataFrame([(x,) for x in CASES], "value string").write.text(topic)

    def run():
        sinks.sink_parquet(
            ev.raw_ingest(messages.stream_text(spark, topic)), bronze, bronze + "-c", None
        ).awaitTermination()
        q = sinks.sink_parquet(
            ev.parse_events(messages.stream_parquet(spark, bronze, BRONZE_SCHEMA)),
            silver, silver + "-c", None)
        q.awaitTermination()
        return q

    keep = ["game_event_id", "game_id", "minute", "event_type", "description"]
    batch = rows(ev.parse_events(raw(spark)).select(*keep))
    for _ in range(2):
        query = run()
        assert rows(spark.read.parquet(silver).select(*keep)) == batch
    assert sinks.progress(query)["active"] is False
    assert sinks.verify_output(spark, silver).first()["rows"] == len(batch)


def test_points_and_repeated_batches(spark, tmp_path):
    silver = ev.parse_events(raw(spark), now=NOW)
    write = sinks.write_points(str(tmp_path / "points"))
    write(silver, 0)
    write(silver, 0)
    points = spark.read.parquet(str(tmp_path / "points"))
    assert points.count() == 4
    p = {r["game_event_id"]: r for r in points.collect()}
    assert (p["e5"]["measurement"], p["e5"]["minute"], p["e5"]["season_count"]) == ("other", 0, 0)
    assert (p["e1"]["measurement"], p["e1"]["club_name"], p["e1"]["game_id"]) == ("goals", "", "7")


def test_time_range_skips_old_folders(spark, tmp_path):
    write = sinks.write_points(str(tmp_path / "points"))
    for i, when in enumerate((NOW, NOW - dt.timedelta(days=9))):
        write(ev.parse_events(raw(spark), now=when), i)
    points = spark.read.parquet(str(tmp_path / "points"))
    recent = live.recent(points, NOW + dt.timedelta(minutes=5))
    assert recent.count() == 4
    assert "PartitionFilters: [isnotnull(point_date" in recent._jdf.queryExecution().executedPlan().toString()


def test_live_queries(spark):
    data = [
        ("goals", "1", "Home", "b", 50, "x", "e1"), ("goals", "1", "Home", "a", 10, "x", "e2"),
        ("cards", "1", "Away", "c", 30, "Red card", "e3"), ("shootout", "1", "Zed", "d", 1, "", "e4"),
    ]
    points = spark.createDataFrame(
        data, "measurement string, game_id string, club_name string, player_name string, "
        "minute int, description string, game_event_id string",
    ).withColumns({"event_type": F.col("measurement"), "competition_name": F.lit("L"),
                   "time": F.lit(NOW).cast("timestamp")})
    now = NOW + dt.timedelta(hours=1)
    assert live.live_score(points, "Home", now).first()["goals"] == 2
    before = NOW - dt.timedelta(minutes=1)
    assert live.live_score(points, "Home", before).count() == 0  # the window ends at its now
    assert [r["minute"] for r in live.feed(points, "goals", "Home", now).collect()] == [10, 50]
    assert live.feed(points, "cards", "Away", now).first()["description"] == "Red card"
    assert live.home_club(points, now).first()[0] == "Away"
    assert live.away_club(points, now).first()[0] == "Home"
    assert live.feed(points, "goals", "Home", NOW + dt.timedelta(hours=3)).count() == 0
    pivoted = live.feed_from_fields(
        live.field_rows(points, ("player_name", "minute")), "goals", "Home", now)
    assert rows(pivoted) == rows(live.feed(points, "goals", "Home", now))


def test_late_rows_and_open_windows(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    at = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    (tmp_path / "src").mkdir()
    stream = messages.stream_parquet(
        spark, src, spark.createDataFrame([], "ts timestamp, id int").schema)
    counts = stateful.window_counts(stream, "ts", "1 hour", "10 minutes")
    for batch in ([at(1), at(1, 30), at(2)], [at(5)], [at(1, 5)]):  # the last row is too late
        spark.createDataFrame([(t, 1) for t in batch], "ts timestamp, id int").coalesce(1).write.mode(
            "append").parquet(src)
        sinks.sink_parquet(counts, out, out + "-c", None).awaitTermination()
    got = rows(spark.read.parquet(out).select("window_start", "n"))
    assert got == [(at(1), 2), (at(2), 1)]


def test_stream_dedup_within_delay(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    base = dt.datetime(2024, 1, 1)
    data = [("a", base), ("a", base + dt.timedelta(minutes=1)), ("b", base), (None, base)]
    spark.createDataFrame(data, "id string, ts timestamp").write.parquet(src)
    stream = messages.stream_parquet(spark, src, spark.read.parquet(src).schema)
    once = stateful.dedup_stream(stream, "id", "ts", "1 hour").select("id")
    sinks.sink_parquet(once, out, out + "-c", None).awaitTermination()
    assert rows(spark.read.parquet(out)) == [("a",), ("b",)]


def test_stop_all(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.range(3).write.parquet(src)
    stream = messages.stream_parquet(spark, src, spark.read.parquet(src).schema)
    sinks.sink_parquet(stream, src + "-o", src + "-c", "1 hour")
    assert sinks.stop_all(spark) == 1 and sinks.stop_all(spark) == 0


def test_topic_options():
    live_options = {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "events", "startingOffsets": "latest",
        "failOnDataLoss": "false"}
    assert messages.live_options("h:9092", "events") == live_options
    assert messages.live_options("h:9092", "events", 1000) == live_options | {
        "maxOffsetsPerTrigger": "1000"}
    assert messages.snapshot_options("h:9092", "events")["endingOffsets"] == "latest"


def test_union_of_batch_and_stream(spark):
    batch = spark.createDataFrame([(1, "x")], "id int, extra string")
    out = union_stream(batch, spark.createDataFrame([(2,)], "id int"))
    assert rows(out.select("id", "extra", "source_type")) == [(1, "x", "batch"), (2, None, "stream")]


def test_completeness(spark, tmp_path):
    for table in ("games", "clubs"):
        files.write_silver(spark.range(3), str(tmp_path / "silver" / table))
    found = files.list_files(spark, str(tmp_path / "silver"), "*.parquet")
    report = files.check_manifest(found, ["games", "players"])
    assert {r["table"]: r["status"] for r in report.collect()} == {
        "games": "found", "clubs": "extra", "players": "missing"}


def test_a_keyed_sink_merges_each_batch_once(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"], buckets=4)
    schema = "id long, goals int, loaded_at timestamp"

    def arrive(*data):
        spark.createDataFrame(list(data), schema).coalesce(1).write.mode("append").parquet(
            str(tmp_path / "in"))
        stream = stream_parquet(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema)
        sinks.keyed_sink(stream, table, str(tmp_path / "ckpt"), None).awaitTermination()
        return sorted((r.id, r.goals) for r in table.read().collect())

    at = dt.datetime(2024, 1, 1)
    assert arrive(*[(i, 0, at) for i in range(40)]) == [(i, 0) for i in range(40)]
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    assert dict(arrive((3, 1, at), (99, 2, at)))[3] == 1
    kept = [p for p in files if p.exists()]
    assert len(kept) >= 2  # at most two of four buckets were written
    assert all(p.stat().st_mtime_ns == files[p] for p in kept)
    before = sorted(map(tuple, table.read().collect()))
    other = spark.createDataFrame([(3, 7, at)], schema)
    assert sorted(map(tuple, table.upsert(other, "stream-1", few=True).collect())) == before
    assert table.folder.names("done") == ["stream-0", "stream-1"] and not table.folder.names("runs")


def test_uncounted_events_end_the_days_before_them(spark, tmp_path):
    schema = "game int, kind string, ts timestamp"
    day = dt.datetime(2024, 1, 1, 12)
    spark.createDataFrame(
        [(1, "goals", day), (1, "cards", day), (2, "goals", day), (2, "pause", day)], schema
    ).coalesce(1).write.parquet(str(tmp_path / "in"))
    table = KeyedTable(spark, str(tmp_path / "t"), ["day", "game"])

    def run():
        totals = stateful.match_totals(
            stream_parquet(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema),
            "ts", ["game"], {"goals": F.col("kind") == "goals"}, "1 hour",
            counted=F.col("kind") != "end")
        query = sinks.keyed_sink(totals, table, str(tmp_path / "ckpt"), None, mode="update")
        query.awaitTermination()
        return query.lastProgress["stateOperators"][0]["numRowsTotal"]

    assert run() == 2
    spark.createDataFrame([(0, "end", day + dt.timedelta(days=2))], schema).coalesce(1).write.mode(
        "append").parquet(str(tmp_path / "in"))
    assert run() == 0
    assert sorted((r.game, r.goals) for r in table.read().collect()) == [(1, 1), (2, 1)]


def test_points_never_broadcast_the_event_table(spark, sf_dir):
    for name in ("q_verify_points", "q_verify_fields", "q_points"):
        plan = run_entry(ENTRIES[name], spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan, name


def test_points_of_one_event_id_stay_apart_in_the_feed(spark):
    data = [("a", 10, "Red card"), ("b", 9, "Yellow card"), ("b", 9, "Yellow card"), ("b", 70, "")]
    points = spark.createDataFrame(data, "player_name string, minute int, description string").select(
        "*", F.lit("e1").alias("game_event_id"), F.lit("1").alias("game_id"),
        F.lit("Home").alias("club_name"), F.lit("L").alias("competition_name"),
        *[F.lit("cards").alias(c) for c in ("measurement", "event_type")],
        F.lit(NOW).cast("timestamp").alias("time"))
    fields = live.field_rows(points, live.FEED_FIELDS["cards"])
    pivoted = live.feed_from_fields(fields, "cards", "Home", NOW)
    assert rows(pivoted) == rows(live.feed(points, "cards", "Home", NOW)) and pivoted.count() == 4
