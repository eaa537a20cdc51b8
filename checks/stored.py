"""Stored models: builds in dependency order, incremental facts, histories."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.models import MODELS as REGISTERED
from checks.models import first_season, second_season
from checks.registry import RUN_TS, SilverTables, check, table_sql, with_ctes
from pitchlake.operators.stored import Folder, KeyedTable
from pitchlake.plans import history
from pitchlake.plans.build import ModelStore, kind_of
from pitchlake.plans.facts import build_fact
from pitchlake.plans.specs import SPECS
from pitchlake.plans.warehouse import MODELS, Warehouse
from pitchlake.session import shuffles_removed, work_path
from pitchlake.sources.files import read_parquet, write_silver


def stored_silver(ctx, folder: str) -> dict:
    """All cleaned tables, written and read back."""
    with shuffles_removed(ctx.spark):
        for name in SPECS:
            write_silver(ctx.silver(name), f"{folder}/{name}")
    return {name: read_parquet(ctx.spark, f"{folder}/{name}") for name in SPECS}


def on(ctx, sources) -> Warehouse:
    return Warehouse(ctx.spark, sources, run_ts=RUN_TS)


TABLES = sorted(m for m in MODELS if kind_of(m) != "view")
VIEWS = sorted(m for m in MODELS if kind_of(m) == "view")
#: What reads the transfers.
AFTER_TRANSFERS = ("dim_club_extended", "fact_transfers", "mart_club_transfer_spending")
FEWER = "(select * from stg_transfers where player_id % 3 <> 0)"


def _reports() -> str:
    """Rows (run, model, status, rows) of three builds, as plain counts."""
    counts = {name: f"(select count(*) from {name})" for name in TABLES}
    after = {
        **counts,
        "dim_club_extended": f"""(select count(*) from (
            select club_id from stg_clubs union select from_club_id from {FEWER}
            where from_club_id is not null union select to_club_id from {FEWER}
            where to_club_id is not null))""",
        "fact_transfers": f"(select count(*) from {FEWER})",
        "mart_club_transfer_spending": f"(select count(*) from {FEWER})",
    }
    parts = []
    for run in (1, 2, 3):
        for name in TABLES:
            built = run == 1 or run == 3 and name in AFTER_TRANSFERS
            n = (after if run == 3 else counts)[name]
            parts.append(f"select {run} as run, '{name}' as model, "
                         f"'{'built' if built else 'unchanged'}' as status, {n} as rows")
        parts += [f"select {run}, '{name}', 'view', null" for name in VIEWS]
    return with_ctes([*TABLES, "stg_clubs", "stg_transfers"], " union all ".join(parts))


@check("q_warehouse_build", "INC-6 INC-7 TBL-30 TBL-31 TBL-32 TBL-33", _reports())
def _(ctx):
    """All models built in order of their parents; again; and again after a change of transfers."""
    folder = work_path(ctx.spark, "build")
    sources = stored_silver(ctx, f"{folder}/silver")
    store = ModelStore(ctx.spark, f"{folder}/gold")
    build = lambda: store.build(on(ctx, sources), stored_sources=True)[1]
    reports = [build() for _ in range(2)]
    write_silver(sources["transfers"].where("player_id % 3 <> 0"), f"{folder}/fewer")
    sources["transfers"] = read_parquet(ctx.spark, f"{folder}/fewer")
    Folder(ctx.spark, f"{folder}/silver").delete("transfers")  # replaced, and read by nothing more
    reports.append(build())
    out = None
    for run, report in enumerate(reports, 1):
        part = report.select(F.lit(run).alias("run"), "model", "status", "rows")
        out = part if out is None else out.union(part)
    return out


for _mart in (m for m in TABLES if m.startswith("mart_")):
    @check(f"q_stored_{_mart}", f"INC-6 {REGISTERED[_mart][0]}",
           table_sql(_mart, REGISTERED[_mart][1]))
    def _(ctx, name=_mart):
        """The mart and what it reads, each stored before its readers are built."""
        store = ModelStore(ctx.spark, work_path(ctx.spark, "build"))
        return store.build(on(ctx, SilverTables(ctx)), [name])[0].ref(name)


@check(
    "q_failing_model", "INC-7 INC-6",
    with_ctes(
        ["fact_transfers", "fact_game_events", "dim_competitions"],
        """select 'fact_matches' as model, 'failed' as status, cast(null as bigint) as rows
           union all select 'mart_club_match_stats', 'skipped', null
           union all select 'fact_transfers', 'built', (select count(*) from fact_transfers)
           union all select 'fact_game_events', 'built', (select count(*) from fact_game_events)
           union all select 'dim_competitions', 'built', (select count(*) from dim_competitions)""",
    ),
)
def _(ctx):
    """Matches with a season that is no number: what reads them fails or is skipped, no more."""
    broken = ctx.silver("games").withColumn("season", F.concat(F.col("season"), F.lit("?")))
    sources = {**{n: SilverTables(ctx)[n] for n in SPECS}, "games": broken.withColumn(
        "home_club_goals", F.col("season").cast("int"))}
    store = ModelStore(ctx.spark, work_path(ctx.spark, "build"))
    wanted = ["mart_club_match_stats", "fact_transfers", "fact_game_events"]
    report = store.build(on(ctx, sources), wanted)[1]
    return report.where(F.col("model").isin(*wanted, "fact_matches", "dim_competitions")).select(
        "model", "status", "rows")


# --- incremental facts by fingerprints -----------------------------------------------------------


def corrected(games):
    """The matches as they arrive later: one of a hundred with another result, some new."""
    return games.withColumn("home_club_goals", F.when(
        F.col("game_id") % 100 == 3, F.col("home_club_goals") + 5).otherwise(
        F.col("home_club_goals")))


@check(
    "q_fingerprint_fact", "INC-1 INC-2 TBL-27",
    with_ctes(
        ["fact_matches"],
        """select game_id, home_goals + case when game_id % 100 = 3 then 5 else 0 end as home_goals,
                  away_goals, case when game_id % 7 = 0 then 3
                                   when game_id % 100 = 3 and home_goals is not null then 3
                                   else 1 end as seen
           from fact_matches""",
    ),
)
def _(ctx):
    """Four runs over stored matches without any load time in them.

    ``seen`` is the run that wrote a row: new and corrected rows are of the third, unchanged ones
    keep the first, although later runs bring them again.
    """
    folder = work_path(ctx.spark, "incremental")
    for name in ("clubs", "competitions", "games"):
        write_silver(ctx.silver(name), f"{folder}/{name}")
    sources = {n: read_parquet(ctx.spark, f"{folder}/{n}") for n in ("clubs", "competitions")}
    games = read_parquet(ctx.spark, f"{folder}/games")
    early = games.where("game_id % 7 <> 0")
    for run, rows in enumerate((early, early, corrected(games), corrected(games)), 1):
        wh = Warehouse(ctx.spark, {**sources, "games": rows}, run_ts=RUN_TS.replace(day=run))
        out = build_fact(wh, "fact_matches", f"{folder}/fact", str(run))
    return out.select("game_id", "home_goals", "away_goals", F.dayofmonth("loaded_at").alias("seen"))


@check(
    "q_touched_buckets", "INC-1 INC-2",
    with_ctes(
        ["stg_games"],
        """select 1 as run, true as first_files_kept, (select count(*) from stg_games) as rows
           union all select 2, true, (select count(*) from stg_games)
           union all select 3, (select count(*) from stg_games where game_id = 3) = 0,
                     (select count(*) from stg_games)""",
    ),
)
def _(ctx):
    """Whether a run leaves all earlier files in place: an unchanged one does, a change doesn't."""
    table = KeyedTable(ctx.spark, work_path(ctx.spark, "keyed"), ["game_id"], buckets=64)
    rows = ctx.ref("stg_games").withColumn("round", F.coalesce("round", F.lit("")))
    change = F.when(F.col("game_id") == 3, F.lit("moved")).otherwise(F.col("round"))
    found, files = [], set()
    for run, part in enumerate((rows, rows, rows.withColumn("round", change)), 1):
        out = table.upsert(part, str(run))
        now = set(out.inputFiles())
        found.append((run, files <= now, out.count()))
        files = files or now
    return ctx.spark.createDataFrame(found, "run int, first_files_kept boolean, rows long")


# --- histories -----------------------------------------------------------------------------------

HISTORY = """
    , s1 as (
        select player_id, player_full_name, current_club_id, current_club_name, is_active,
               contract_expiration_date, current_market_value_in_eur
        from stg_players where player_id % 25 <> 11),
    s2 as (
        select player_id, player_full_name,
               current_club_id + case when player_id % 10 = 0 then 1 else 0 end as current_club_id,
               current_club_name, is_active, contract_expiration_date,
               case when player_id % 15 <> 0 then current_market_value_in_eur end
                   as current_market_value_in_eur
        from stg_players where player_id % 20 <> 7),
    runs as (
        select *, '2024-07-01 00:00:00' as loaded_at, 1 as run from s1
        union all select *, '2024-08-01 00:00:00', 2 from s2
        union all select *, '2024-09-01 00:00:00', 3 from s1),
    seen as (
        select *, lag(run) over w as before, lag(current_club_id) over w as club_before,
               lag(current_market_value_in_eur) over w as value_before
        from runs window w as (partition by player_id order by run)),
    opened as (
        select * exclude (run, before, club_before, value_before), loaded_at as valid_from
        from seen where before is null or club_before is distinct from current_club_id
            or value_before is distinct from current_market_value_in_eur),
    closed as (
        select *, lead(valid_from) over (partition by player_id order by valid_from) as valid_to
        from opened)
    select * replace (cast(contract_expiration_date as varchar) as contract_expiration_date),
           coalesce(valid_to, valid_from) as updated_at,
           md5(cast(player_id as varchar) || '-' || valid_from) as scd_id
    from closed"""


@check("q_history_runs", "INC-3 TBL-34", with_ctes(["stg_players"], HISTORY.lstrip()))
def _(ctx):
    """Four runs: the second breaks off before its mark and is repeated, the third finds nothing
    new, and in the last the first values come back."""
    path = work_path(ctx.spark, "snap_dim_player")
    august = RUN_TS.replace(month=8)
    history.snap_dim_player(first_season(ctx), path, RUN_TS)
    left = history.player_rows(second_season(ctx)).limit(50).select(
        "*", F.lit(RUN_TS).alias("valid_from"), F.lit(august).alias("valid_to"),
        F.lit(august).alias("updated_at"), F.lit("?").alias("scd_id"),
        F.lit("closed").alias("state"), F.lit(august.strftime("r%Y%m%dT%H%M%S%f")).alias("run"))
    left.write.mode("append").partitionBy("state", "run").parquet(f"{path}/rows")
    for at in (august, august, RUN_TS.replace(month=8, day=15)):
        history.snap_dim_player(second_season(ctx), path, at)
    september = RUN_TS.replace(month=9)
    again = first_season(ctx)
    again.run_ts = september
    return history.snap_dim_player(again, path, september)
