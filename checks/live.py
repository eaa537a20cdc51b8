"""Streams over the event table, point sinks and live queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.registry import RUN_TS, check, cte, with_ctes
from pitchlake.operators.quality import accepted_range, not_null
from pitchlake.operators.stored import KeyedTable
from pitchlake.plans.facts import build_fact, event_keys
from pitchlake.plans.warehouse import Warehouse
from pitchlake.session import work_path
from pitchlake.sources.files import read_parquet, write_silver
from pitchlake.sources.messages import stream_parquet, stream_text
from pitchlake.streaming import events as ev
from pitchlake.streaming import live, monitor, sinks, stateful
from pitchlake.streaming.schemas import BRONZE_SCHEMA, SILVER_SCHEMA
from pitchlake.streaming.store import PointStore

NOW = dt.datetime(2024, 1, 30, 23, 0)
ARRIVED = dt.datetime(2024, 1, 31)

# Live events from the event table: every fiftieth id repeats, some messages are broken, some
# minutes are out of range, and match ids may come as text that is no number.
LIVE_SQL = """
    select md5(cast(case when event_id % 50 = 49 then event_id - 1 else event_id end as string))
               as game_event_id,
           case when event_id % 31 = 0 then 'final' else cast(user_id % 20 as string) end as game_id,
           cast(cast(ts as date) as string) as game_date,
           cast(event_id % 140 as string) as minute,
           case event_type when 'purchase' then ' Goals ' when 'click' then 'Cards'
                when 'view' then 'Substitutions' when 'signup' then 'Shootout' else '' end
               as event_type,
           case event_type when 'purchase' then cast(event_id % 9 as string) || '. Goal, Header'
                when 'signup' then case when event_id % 2 = 0 then 'Scored' else 'Missed' end
                when 'click' then 'Yellow card' end as description,
           cast(user_id as string) as player_id,
           case when event_id % 9 = 0 then null else 'Player ' || cast(user_id as string) end
               as player_name,
           'Club ' || cast(user_id % 3 as string) as club_name,
           case when event_id % 5 = 0 then null else 'League' end as competition_name,
           case when event_id % 4 = 0 then '' else cast(event_id % 1000 as string) end as attendance,
           cast(event_id % 4 as string) as home_club_goals
    from {events}"""


def live_rows(ctx) -> DataFrame:
    return ctx.spark.sql(LIVE_SQL, events=ctx.base("events"))


def messages(ctx) -> DataFrame:
    """One JSON message per event; every 61st is not JSON."""
    encoded = ev.to_event_json(live_rows(ctx), (), now=ARRIVED)
    broken = F.get_json_object("value", "$.minute") == "61"
    return encoded.select(F.when(broken, F.lit("not json")).otherwise(F.col("value")).alias("value"))


cte("live_rows", (), LIVE_SQL.format(events="events"))
cte(
    "parsed", ["live_rows"],
    r"""
    select game_event_id, try_cast(game_id as integer) as game_id, game_date,
           try_cast(minute as integer) as minute, lower(trim(event_type)) as event_type,
           coalesce(description, 'Unknown') as description,
           try_cast(player_id as integer) as player_id,
           coalesce(player_name, 'Unknown') as player_name, club_name, competition_name,
           cast(try_cast(attendance as float) as double) as attendance,
           try_cast(home_club_goals as integer) as home_club_goals,
           try_cast(regexp_extract(description, '^(\d+)\.', 1) as integer) as season_count,
           case when description like '%Scored%' then 'scored'
                when description like '%Missed%' then 'missed' end as penalty_result
    from live_rows
    where try_cast(game_id as integer) is not null
      and try_cast(minute as integer) between 0 and 130 and minute <> '61'""",
)

PARSED = (
    "game_event_id", "game_id", "game_date", "minute", "event_type", "description", "player_id",
    "player_name", "club_name", "competition_name", "attendance", "home_club_goals",
    "season_count", "penalty_result",
)


def parsed_columns(df: DataFrame) -> DataFrame:
    return df.select(*PARSED).withColumn("attendance", F.col("attendance").cast("double"))


def bronze_stream(ctx) -> tuple[str, str]:
    """Messages as files, ingested by a stream into bronze files. Returns folder and bronze path."""
    folder = work_path(ctx.spark, "stream")
    messages(ctx).write.text(f"{folder}/topic")
    raw = ev.raw_ingest(stream_text(ctx.spark, f"{folder}/topic"), now=ARRIVED)
    sinks.sink_parquet(raw, f"{folder}/bronze", f"{folder}/ckpt-bronze", None).awaitTermination()
    return folder, f"{folder}/bronze"


def silver_stream(ctx) -> str:
    folder, bronze = bronze_stream(ctx)
    parsed = ev.parse_events(stream_parquet(ctx.spark, bronze, BRONZE_SCHEMA), now=ARRIVED)
    sinks.sink_parquet(parsed, f"{folder}/silver", f"{folder}/ckpt-silver", None).awaitTermination()
    return folder


@check(
    "q_stream_ingest", "STM-1 STM-4 SRC-7 SNK-2 CST-12 STM-10",
    with_ctes(
        ["live_rows"],
        """select count(*) as rows, 4 as columns,
                  count(*) filter (minute = '61') as broken from live_rows""",
    ),
)
def _(ctx):
    folder, bronze = bronze_stream(ctx)
    broken = ctx.spark.read.parquet(bronze).agg(F.count_if(F.col("raw_json") == "not json"))
    return sinks.verify_output(ctx.spark, bronze).withColumn("broken", broken.scalar())


@check("q_parse_batch", "STM-2 CST-9 PRJ-6 FLT-4 NUL-1 NUL-6 SCL-13", with_ctes(
    ["parsed"], "select * from parsed"))
def _(ctx):
    return parsed_columns(ev.parse_events(ev.raw_ingest(messages(ctx), now=ARRIVED)))


@check(
    "q_stream_parse", "STM-1 STM-2 STM-5 SRC-7 SNK-2 SNK-5 CST-3 CST-9 CST-10",
    with_ctes(["parsed"], "select * from parsed"),
)
def _(ctx):
    return parsed_columns(ctx.spark.read.parquet(f"{silver_stream(ctx)}/silver"))


@check(
    "q_stream_restart", "STM-5 STM-6",
    with_ctes(
        ["parsed"], "select count(*) as rows, 2 as runs, false as active from parsed"),
)
def _(ctx):
    """A stopped query goes on from its checkpoint: half of the messages each run, none twice."""
    folder = work_path(ctx.spark, "restart")
    half = F.abs(F.hash("value")) % 2
    runs, active = 0, False
    for part in (0, 1):
        messages(ctx).filter(half == part).write.mode("append").text(f"{folder}/topic")
        stream = ev.parse_events(ev.raw_ingest(stream_text(ctx.spark, f"{folder}/topic")))
        query = sinks.sink_parquet(stream, f"{folder}/out", f"{folder}/ckpt", None)
        query.awaitTermination()
        state = sinks.progress(query)
        runs += state["error"] is None
        active = active or state["active"]
    rows = ctx.spark.read.parquet(f"{folder}/out").agg(F.count(F.lit(1)).alias("rows"))
    return rows.select("rows", F.lit(runs).alias("runs"), F.lit(active).alias("active"))


def event_stream(ctx, files: int = 8) -> DataFrame:
    """The event table as a stream of several files with an event time."""
    path = work_path(ctx.spark, "events")
    rows = ctx.base("events").withColumn("ts", F.col("ts").cast("timestamp"))
    rows.repartitionByRange(files, "ts").write.parquet(path)
    return stream_parquet(ctx.spark, path, rows.schema)


def complete(ctx, stream: DataFrame, label: str) -> DataFrame:
    """Final result of an aggregation: each batch replaces the table with all groups."""
    path = work_path(ctx.spark, label)

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/v={batch_id}")

    writer = stream.writeStream.outputMode("complete").foreachBatch(replace)
    query = sinks.with_trigger(writer, f"{path}-ckpt", None).start()
    query.awaitTermination()
    return ctx.spark.read.parquet(f"{path}/v={query.lastProgress['batchId']}")


@check(
    "q_stream_window", "STM-8",
    """select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as window_start,
              strftime(date_trunc('hour', ts) + interval 1 hour, '%Y-%m-%d %H:%M:%S')
                  as window_end,
              event_type, count(*) as n
       from events group by date_trunc('hour', ts), event_type""",
)
def _(ctx):
    counts = stateful.window_counts(event_stream(ctx), "ts", "1 hour", "10 minutes", ["event_type"])
    return complete(ctx, counts, "windows")


@check(
    "q_stream_window_closed", "STM-8",
    """select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as window_start,
              strftime(date_trunc('hour', ts) + interval 1 hour, '%Y-%m-%d %H:%M:%S')
                  as window_end, count(*) as n
       from events group by date_trunc('hour', ts)
       having date_trunc('hour', ts) + interval 1 hour
              <= (select max(ts) from events) - interval 10 minutes""",
)
def _(ctx):
    """Append output: windows the watermark has passed, once each."""
    path = work_path(ctx.spark, "closed")
    counts = stateful.window_counts(event_stream(ctx), "ts", "1 hour", "10 minutes")
    sinks.sink_parquet(counts, path, f"{path}-ckpt", None).awaitTermination()
    return ctx.spark.read.parquet(path)


@check(
    "q_stream_dedup", "STM-7",
    "select distinct event_id - event_id % 2 as event_id from events",
)
def _(ctx):
    """Neighbouring events share an id here; the repeat arrives within the delay."""
    path = work_path(ctx.spark, "dedup")
    twice = event_stream(ctx).withColumn("event_id", F.expr("event_id - event_id % 2"))
    once = stateful.dedup_stream(twice, "event_id", "ts", "1 day").select("event_id")
    sinks.sink_parquet(once, path, f"{path}-ckpt", None).awaitTermination()
    return ctx.spark.read.parquet(path)


@check(
    "q_stream_running", "STM-9 AGG-15",
    """select user_id, count(*) filter (event_type = 'purchase') as goals,
              count(*) filter (event_type = 'click') as cards from events group by 1""",
)
def _(ctx):
    totals = stateful.running_totals(
        event_stream(ctx), ["user_id"],
        {"goals": F.col("event_type") == "purchase", "cards": F.col("event_type") == "click"},
    )
    return complete(ctx, totals, "running")


# --- points and live queries ---------------------------------------------------------------------


def point_rows(ctx) -> DataFrame:
    """Points of the parsed events, timed by the event table so that the window has a fixed end."""
    times = ctx.base("events").select(
        F.md5(F.col("event_id").cast("string")).alias("game_event_id"),
        F.col("ts").cast("timestamp").alias("at"),
    )
    parsed = ev.parse_events(ev.raw_ingest(messages(ctx), now=ARRIVED))
    # Both sides are whole event tables, which the size of their files makes look small: without
    # the hint one of them passes the driver as a broadcast.
    return sinks.points(parsed.join(times.hint("merge"), "game_event_id"), "at")


cte(
    "points", ["parsed"],
    """
    select case when event_type <> '' then event_type else 'other' end as measurement,
           cast(game_id as varchar) as game_id, coalesce(club_name, '') as club_name,
           case when event_type <> '' then event_type else 'other' end as event_type,
           coalesce(competition_name, '') as competition_name, minute,
           coalesce(player_id, 0) as player_id, player_name, description, game_event_id,
           coalesce(home_club_goals, 0) as home_club_goals, 0 as away_club_goals, '' as stadium,
           coalesce(season_count, 0) as season_count, '' as player_nationality,
           '' as sub_position, '' as referee, coalesce(attendance, 0.0::double) as attendance,
           '' as round, '' as coach_name, '' as country_name, 0 as season, game_date,
           coalesce(penalty_result, '') as penalty_result, ts as time
    from parsed join (select md5(cast(event_id as varchar)) as id, ts from events)
         on game_event_id = id""",
)
RECENT = "time between timestamp '2024-01-30 21:00:00' and timestamp '2024-01-30 23:00:00'"


@check(
    "q_points", "NUL-10 STM-3 SET-4",
    with_ctes(["points"], "select * exclude (time) from points"),
)
def _(ctx):
    return point_rows(ctx).drop("time").withColumn("attendance", F.col("attendance").cast("double"))


@check(
    "q_sink_points", "SNK-3 STM-3 NUL-10",
    with_ctes(
        ["points"],
        """select measurement, club_name, count(*) as n, cast(sum(minute) as bigint) as minutes,
                  cast(sum(season_count) as bigint) as season_counts from points group by 1, 2""",
    ),
)
def _(ctx):
    """Silver stream to point folders; the batch is written a second time without doubling."""
    folder = silver_stream(ctx)
    stream = stream_parquet(ctx.spark, f"{folder}/silver", SILVER_SCHEMA)
    path = f"{folder}/points"
    sinks.points_sink(stream, path, f"{folder}/ckpt-points", None).awaitTermination()
    sinks.write_points(path)(ctx.spark.read.parquet(f"{folder}/silver"), 0)
    return ctx.spark.read.parquet(path).groupBy("measurement", "club_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum("minute").alias("minutes"),
        F.sum("season_count").alias("season_counts"),
    )


@check(
    "q_live_score", "LIV-1 FLT-12",
    with_ctes(
        ["points"],
        f"""select game_id, club_name, event_type, competition_name, count(player_name) as goals
            from points where {RECENT} and measurement = 'goals' and club_name = 'Club 1'
            group by all""",
    ),
)
def _(ctx):
    return live.live_score(point_rows(ctx), "Club 1", NOW)


@check(
    "q_live_score_state", "LIV-1 STM-6 STM-9",
    with_ctes(
        ["points"],
        f"""select game_id, club_name, event_type, competition_name, cast(count(*) as bigint) as goals
            from points where {RECENT} and measurement = 'goals' and club_name = 'Club 1'
            group by all""",
    ),
)
def _(ctx):
    """The live score from the state of a stream of points; the points are not read again."""
    folder = work_path(ctx.spark, "state")
    rows = point_rows(ctx)
    rows.repartitionByRange(4, "time").write.parquet(f"{folder}/points")
    counts = stateful.recent_counts(
        stream_parquet(ctx.spark, f"{folder}/points", rows.schema), "time", live.SERIES, "6 hours")
    writer = counts.writeStream.outputMode("update").format("noop")
    sinks.with_trigger(writer, f"{folder}/ckpt", None).start().awaitTermination()
    state = stateful.state_counts(ctx.spark, f"{folder}/ckpt", live.SERIES)
    return live.live_score_from_state(state, "Club 1", NOW)


def _feed_sql(kind: str, club: str) -> str:
    fields = ", ".join(live.FEED_FIELDS[kind])
    return with_ctes(
        ["points"],
        f"""select club_name, {fields} from points
            where {RECENT} and measurement = '{kind}' and club_name = '{club}'""",
    )


for _kind, _club, _covers in (
    ("goals", "Club 0", "LIV-2"), ("cards", "Club 1", "LIV-3"), ("substitutions", "Club 2", "LIV-4"),
):
    check(f"q_live_{_kind}", _covers + " SRT-2", _feed_sql(_kind, _club))(
        lambda ctx, kind=_kind, club=_club: live.feed(point_rows(ctx), kind, club, NOW)
    )


@check("q_live_feed_pivot", "LIV-3 SET-3 SET-4", _feed_sql("cards", "Club 1"))
def _(ctx):
    fields = live.field_rows(point_rows(ctx), live.FEED_FIELDS["cards"])
    return live.feed_from_fields(fields, "cards", "Club 1", NOW)


_CLUBS = f"""(select distinct club_name from points where {RECENT} and measurement in
              ('goals', 'cards', 'substitutions') order by 1"""


@check(
    "q_club_vars", "LIV-5 SRT-3",
    with_ctes(
        ["points"],
        f"""select 'home' as side, * from {_CLUBS} limit 1)
            union all select 'away', * from {_CLUBS} limit 1 offset 1)""",
    ),
)
def _(ctx):
    points = point_rows(ctx)
    home = live.home_club(points, NOW).select(F.lit("home").alias("side"), "club_name")
    return home.union(live.away_club(points, NOW).select(F.lit("away"), "club_name"))


@check(
    "q_verify_points", "LIV-6",
    with_ctes(
        ["points"],
        f"""select strftime(time, '%Y-%m-%d %H:%M:%S') as time, measurement, game_id, club_name,
                   player_name, minute from points where {RECENT}""",
    ),
)
def _(ctx):
    rows = live.verify_points(point_rows(ctx), NOW)
    return rows.withColumn("time", F.date_trunc("second", "time"))


@check(
    "q_verify_fields", "LIV-6 SET-3 SET-4",
    with_ctes(
        ["points"],
        f"""select *, count(*) over () as total from (
              select strftime(time, '%Y-%m-%d %H:%M:%S.%f') as time, measurement, game_id, club_name,
                     max(player_name) as player_name,
                     cast(max(cast(minute as varchar)) as integer) as minute
              from points where {RECENT} group by points.time, measurement, game_id, club_name)""",
    ),
)
def _(ctx):
    """The fields of the window's points, pivoted by time and match, and how many there are."""
    fields = live.field_rows(point_rows(ctx), ("minute", "player_name", "description"))
    return live.verify_fields(fields, NOW).withColumn(
        "time", F.date_format("time", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@check(
    "q_point_store", "SNK-3 STM-3 FLT-12",
    with_ctes(
        ["points"],
        """select cast(time as date)::varchar as day, measurement, count(*) as n,
                  cast(sum(minute) as bigint) as minutes from points group by all""",
    ),
)
def _(ctx):
    """Points of three batches; past days are closed, one of them gets late points and is closed
    again, and what nobody needs any more is removed."""
    store = PointStore(ctx.spark, work_path(ctx.spark, "store"))
    arrived = work_path(ctx.spark, "arrived")
    point_rows(ctx).write.parquet(arrived)  # parsed once, not again for each batch
    rows = ctx.spark.read.parquet(arrived)
    part = F.pmod(F.xxhash64("game_event_id", "minute"), F.lit(3))
    write = lambda n: rows.where(part == n).withColumns(
        {"point_date": F.to_date("time"), "batch_id": F.lit(n).cast("long")}).write.mode(
        "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "point_date", "batch_id").parquet(store.open_path)
    write(0)
    write(1)
    store.compact(dt.date(2024, 1, 20))
    write(2)
    store.compact(dt.date(2024, 1, 10))
    store.clean()
    return store.read().groupBy(
        F.col("point_date").cast("string").alias("day"), "measurement").agg(
        F.count(F.lit(1)).alias("n"), F.sum("minute").alias("minutes"))


# --- streams into stored tables ------------------------------------------------------------------


@check(
    "q_stream_fact", "SET-5 SNK-2 TBL-26 INC-1",
    with_ctes(
        ["fact_game_events"],
        """select * exclude (loaded_at) replace (
                  cast(event_date as varchar) as event_date,
                  case when minute between 60 and 130 and game_id is not null then 'stream'
                       else 'batch' end as source_type)
           from fact_game_events""",
    ),
)
def _(ctx):
    """The stored fact holds a first account of the late events, or none; a stream then brings them,
    and brings them again."""
    folder = work_path(ctx.spark, "stream-fact")
    write_silver(ctx.silver("game_events"), f"{folder}/events")  # cleaned once, used three times
    events = read_parquet(ctx.spark, f"{folder}/events")
    late = F.col("minute").between(60, 130) & F.col("game_id").isNotNull()
    early = events.where(~F.coalesce(late, F.lit(False)) | (F.col("minute") > 90)).withColumn(
        "description", F.when(late, "unconfirmed").otherwise(F.col("description")))
    sources = {"clubs": ctx.silver("clubs"), "game_events": early}
    wh = Warehouse(ctx.spark, sources, run_ts=RUN_TS)
    build_fact(wh, "fact_game_events", f"{folder}/fact", "first")
    table = KeyedTable(ctx.spark, f"{folder}/fact", ["game_event_id"])
    sent = ev.to_event_json(
        events.where(late).withColumnsRenamed({"date": "game_date", "type": "event_type"}), ())
    for _ in range(2):
        sent.write.mode("append").option("compression", "gzip").text(f"{folder}/topic")
        parsed = ev.parse_events(ev.raw_ingest(stream_text(ctx.spark, f"{folder}/topic")))
        sinks.keyed_sink(
            parsed, table, f"{folder}/ckpt", None,
            rows=lambda batch: event_keys(wh, ev.staged_events(batch))).awaitTermination()
    return table.read().drop("loaded_at")


@check(
    "q_stream_match_totals", "STM-9 AGG-15",
    """select strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') as day, user_id,
              count(*) filter (event_type = 'purchase') as goals,
              count(*) filter (event_type = 'click') as cards, 0 as rows_in_state
       from events group by date_trunc('day', ts), user_id""",
)
def _(ctx):
    """Totals by update output into a keyed table, with a restart and late events between; when the
    last day is over no state is left."""
    folder = work_path(ctx.spark, "match-totals")
    rows = ctx.base("events").select(
        "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    late = F.expr("day(ts) % 2 = 0 and event_type <> 'click'")
    over = rows.agg(
        F.max("user_id").alias("user_id"), F.lit("final whistle").alias("event_type"),
        (F.max("ts") + F.expr("interval 90 days")).alias("ts"))
    table = KeyedTable(ctx.spark, f"{folder}/totals", ["day", "user_id"], buckets=8)
    for part in (rows.where(~late), rows.where(late), over):
        part.repartitionByRange(4, "ts").write.mode("append").parquet(f"{folder}/events")
        totals = stateful.match_totals(
            stream_parquet(ctx.spark, f"{folder}/events", rows.schema, 2), "ts", ["user_id"],
            {"goals": F.col("event_type") == "purchase", "cards": F.col("event_type") == "click"},
            "31 days", counted=F.col("event_type") != "final whistle")
        query = sinks.keyed_sink(totals, table, f"{folder}/ckpt", None, mode="update")
        query.awaitTermination()
    left = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    return table.read().withColumn("rows_in_state", F.lit(left))


# --- figures on the way --------------------------------------------------------------------------


@check(
    "q_observed_write", "QLT-2 QLT-4 QLT-6 AGG-1 SNK-1",
    with_ctes(
        ["stg_appearances"],
        """select 'appearances' as model, 'rows' as test, 'info' as severity, count(*) as violations
           from stg_appearances
           union all select 'appearances', 'not_null_player_club_id', 'warn',
                            count(*) filter (player_club_id is null) from stg_appearances
           union all select 'appearances', 'range_minutes_played', 'error',
                            count(*) filter (minutes_played < 10 or minutes_played > 80)
                     from stg_appearances""",
    ),
)
def _(ctx):
    """Rows and violations of a table, counted by the job that writes it."""
    path = work_path(ctx.spark, "observed")
    tests = [not_null("player_club_id", "warn"), accepted_range("minutes_played", 10, 80)]
    return monitor.observed_write(
        ctx.ref("stg_appearances"), "appearances", tests, lambda df: df.write.parquet(path))


@check(
    "q_stream_progress", "STM-6 STM-10 QLT-6",
    with_ctes(
        ["live_rows", "parsed"],
        """select (select count(*) from live_rows) as input_rows,
                  (select count(*) from parsed) as rows,
                  (select count(*) from parsed where competition_name is null) as without_league,
                  (select count(*) from parsed where minute > 90) as late, 0 as errors""",
    ),
)
def _(ctx):
    """Rows in and out of a stream, and violations, from its progress alone."""
    folder = work_path(ctx.spark, "progress")
    messages(ctx).repartition(4).write.text(f"{folder}/topic")
    listener = monitor.ProgressTable(ctx.spark, f"{folder}/progress")
    ctx.spark.streams.addListener(listener)
    try:
        parsed = ev.parse_events(ev.raw_ingest(stream_text(ctx.spark, f"{folder}/topic", 2)))
        tests = [not_null("competition_name"), accepted_range("minute", None, 90)]
        stream = monitor.observed_stream(parsed, tests)
        sinks.sink_parquet(stream, f"{folder}/out", f"{folder}/ckpt", None).awaitTermination()
        ctx.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        ctx.spark.streams.removeListener(listener)
    found = F.col("violations")
    return listener.read().agg(
        F.sum("input_rows").alias("input_rows"), F.sum("rows").alias("rows"),
        F.sum(found["not_null_competition_name"]).alias("without_league"),
        F.sum(found["range_minute"]).alias("late"),
        F.count("error").cast("int").alias("errors"))
