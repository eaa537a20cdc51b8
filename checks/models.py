"""Staging, dimensions, facts, marts, enrichment, histories and model tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import AS_OF, RUN_TS, check, cte, table_sql, with_ctes
from pitchlake.operators.clean import clean
from pitchlake.operators.reshape import union_stream
from pitchlake.operators.state import (
    VersionedTable, build_incremental, build_partitions, merge_upsert,
)
from pitchlake.plans import enrichment, history, model_tests
from pitchlake.plans.facts import build_fact
from pitchlake.plans.marts import club_view
from pitchlake.plans.specs import SPECS
from pitchlake.plans.warehouse import Warehouse
from pitchlake.session import work_path

LOADED = "timestamp '2024-07-01 00:00:00'"
NULL_KEY = "_dbt_utils_surrogate_key_null_"


def sk(*columns: str) -> str:
    parts = ", ".join(f"coalesce(cast({c} as varchar), '{NULL_KEY}')" for c in columns)
    return f"md5(concat_ws('-', {parts}))"


# --- staging -------------------------------------------------------------------------------------

STAGING = {
    "stg_appearances": f"""
        select appearance_id, game_id, player_id, player_club_id, player_current_club_id,
               date as appearance_date, player_name, competition_id,
               coalesce(yellow_cards, 0) as yellow_cards, coalesce(red_cards, 0) as red_cards,
               coalesce(goals, 0) as goals, coalesce(assists, 0) as assists,
               coalesce(minutes_played, 0) as minutes_played,
               case when goals > 0 then true else false end as scored,
               case when assists > 0 then true else false end as assisted, {LOADED} as loaded_at
        from appearances
        where appearance_id is not null and game_id is not null and player_id is not null""",
    "stg_clubs": f"""
        select * rename (name as club_name), {LOADED} as loaded_at from clubs
        where club_id is not null""",
    "stg_competitions": f"""
        select * rename (name as competition_name, type as competition_type), {LOADED} as loaded_at
        from competitions where competition_id is not null""",
    "stg_game_events": f"""
        select * rename (date as event_date, type as event_type), 'batch' as source_type,
               {LOADED} as loaded_at
        from game_events where game_event_id is not null""",
    "stg_games": f"""
        select * rename (date as game_date),
               cast(season as varchar) || '/' || right(cast(season + 1 as varchar), 2)
                   as season_label,
               {LOADED} as loaded_at
        from games where game_id is not null""",
    "stg_player_valuations": f"""
        select * rename (date as valuation_date),
               cast(row_number() over (partition by player_id order by date desc nulls last)
                    as integer) as rn,
               row_number() over (partition by player_id order by date desc nulls last) = 1
                   as is_latest_valuation,
               {LOADED} as loaded_at
        from player_valuations where market_value_in_eur is not null""",
    "stg_players": f"""
        select * rename (name as player_full_name, country_of_citizenship as nationality,
                         foot as preferred_foot,
                         market_value_in_eur as current_market_value_in_eur),
               {LOADED} as loaded_at
        from players where player_id is not null""",
    "stg_transfers": f"""
        select * rename (transfer_fee as transfer_fee_eur,
                         market_value_in_eur as player_value_at_transfer_eur),
               case when transfer_fee is null or transfer_fee = 0 then 'FREE_OR_UNKNOWN'
                    else 'PAID' end as transfer_fee_type,
               {LOADED} as loaded_at
        from transfers where player_id is not null""",
}
for _name, _sql in STAGING.items():
    cte(_name, [_name.removeprefix("stg_")], _sql)

# --- dimensions ----------------------------------------------------------------------------------

cte(
    "dim_date", (),
    f"""
    select {sk('d')} as sk_date, d as date_id, d as full_date,
           cast(year(d) as integer) as year, cast(month(d) as integer) as month,
           cast(day(d) as integer) as day, cast(dayofweek(d) as integer) as day_of_week,
           strftime(d, '%a') as day_name, strftime(d, '%b') as month_name,
           cast(quarter(d) as integer) as quarter, cast(weekofyear(d) as integer) as week_of_year,
           printf('%d/%02d', first_year, (first_year + 1) % 100) as season_label,
           cast(first_year as integer) as season_start_year
    from (select d, year(d + interval 6 months) - 1 as first_year from (
          select cast(g as date) as d
          from generate_series(date '2000-01-01', date '2030-12-30', interval 1 day) as s(g)))""",
)
cte(
    "dim_club", ["stg_clubs"],
    f"select {sk('club_id')} as sk_club, * exclude (loaded_at), {LOADED} as updated_at from stg_clubs",
)
cte(
    "dim_club_extended", ["stg_clubs", "stg_transfers"],
    f"""
    select {sk('coalesce(c.club_id, t.club_id)')} as sk_club,
           coalesce(c.club_id, t.club_id) as club_id,
           coalesce(c.club_name, t.club_name) as club_name,
           c.* exclude (club_id, club_name, loaded_at), {LOADED} as updated_at
    from stg_clubs c full join (
        select club_id, min(club_name) as club_name
        from (select from_club_id as club_id, from_club_name as club_name from stg_transfers
              union select to_club_id, to_club_name from stg_transfers)
        where club_id is not null group by club_id) t on c.club_id = t.club_id""",
)
cte(
    "dim_competitions", ["stg_competitions"],
    f"""select {sk('competition_id')} as sk_competition, * exclude (loaded_at),
        {LOADED} as updated_at from stg_competitions""",
)
cte(
    "dim_player", ["stg_players", "stg_player_valuations"],
    f"""
    select {sk('p.player_id')} as sk_player, p.player_id, player_full_name, first_name, last_name,
           position, sub_position, preferred_foot, nationality, country_of_birth, date_of_birth,
           age, height_in_cm, p.current_club_id, p.current_club_name,
           current_club_domestic_competition_id, last_season, international_caps,
           international_goals, contract_expiration_date, current_market_value_in_eur,
           highest_market_value_in_eur, v.market_value_in_eur as latest_market_value_eur,
           v.valuation_date as latest_valuation_date, is_international, is_active,
           {LOADED} as updated_at
    from stg_players p left join stg_player_valuations v
         on p.player_id = v.player_id and v.is_latest_valuation""",
)

# --- facts ---------------------------------------------------------------------------------------

cte(
    "fact_appearances",
    ["stg_appearances", "dim_player", "dim_club", "dim_competitions", "dim_date"],
    """
    select p.sk_player, c.sk_club, k.sk_competition, d.sk_date, a.* exclude (player_name)
    from stg_appearances a
    left join dim_player p on a.player_id = p.player_id
    left join dim_club c on a.player_club_id = c.club_id
    left join dim_competitions k on a.competition_id = k.competition_id
    left join dim_date d on a.appearance_date = d.date_id""",
)
cte(
    "fact_game_events", ["stg_game_events", "dim_club", "dim_date"],
    """
    select c.sk_club, d.sk_date, e.* from stg_game_events e
    left join dim_club c on e.club_id = c.club_id
    left join dim_date d on e.event_date = d.date_id""",
)
cte(
    "fact_matches", ["stg_games", "dim_club", "dim_competitions", "dim_date"],
    """
    select h.sk_club as home_club_key, a.sk_club as away_club_key,
           k.sk_competition as competition_key, d.sk_date as date_key,
           g.* rename (home_club_goals as home_goals, away_club_goals as away_goals),
           g.home_club_goals + g.away_club_goals as total_goals,
           g.home_club_goals - g.away_club_goals as goal_difference,
           case when g.home_club_goals > g.away_club_goals then true else false end as home_win,
           case when g.home_club_goals < g.away_club_goals then true else false end as away_win,
           case when g.home_club_goals = g.away_club_goals then true else false end as is_draw
    from stg_games g
    left join dim_club h on g.home_club_id = h.club_id
    left join dim_club a on g.away_club_id = a.club_id
    left join dim_competitions k on g.competition_id = k.competition_id
    left join dim_date d on g.game_date = d.date_id""",
)
cte(
    "fact_player_valuations", ["stg_player_valuations", "dim_player", "dim_club", "dim_date"],
    """
    select p.sk_player, c.sk_club, d.sk_date,
           v.* exclude (rn) rename (market_value_in_eur as market_value_eur)
    from stg_player_valuations v
    left join dim_player p on v.player_id = p.player_id
    left join dim_club c on v.current_club_id = c.club_id
    left join dim_date d on v.valuation_date = d.date_id""",
)
cte(
    "fact_transfers", ["stg_transfers", "dim_player", "dim_club", "dim_date"],
    f"""
    select {sk('t.player_id', 't.from_club_id', 't.to_club_id', 't.transfer_date')} as transfer_key,
           p.sk_player, f.sk_club as sk_from_club, b.sk_club as sk_to_club, d.sk_date, t.*
    from stg_transfers t
    left join dim_player p on t.player_id = p.player_id
    left join dim_club f on t.from_club_id = f.club_id
    left join dim_club b on t.to_club_id = b.club_id
    left join dim_date d on t.transfer_date = d.date_id""",
)


# --- marts ---------------------------------------------------------------------------------------


def rounded(top: str, bottom: str, scale: int = 1, digits: int = 2) -> str:
    """Whole-number ratio, rounded half up in integer arithmetic; for values that are not negative."""
    unit = 10**digits
    up, down = f"cast({top} as hugeint) * {scale * unit * 2}", f"cast({bottom} as hugeint)"
    return (
        f"case when {bottom} > 0 then "
        f"cast(({up} + {down}) // (2 * {down}) as double) / {float(unit)} end"
    )


# The marts are added up by ids first, then by names, or from aggregates that are joined back.

cte(
    "mart_player_performance", ["fact_appearances", "dim_player", "dim_club", "dim_date"],
    f"""
    select m.* replace (
           cast(total_goals as bigint) as total_goals, cast(total_assists as bigint) as total_assists,
           cast(total_minutes as bigint) as total_minutes,
           cast(total_yellow_cards as bigint) as total_yellow_cards,
           cast(total_red_cards as bigint) as total_red_cards,
           cast(total_appearances as bigint) as total_appearances),
           {rounded('total_goals', 'total_appearances')} as avg_goals_per_match,
           {rounded('total_assists', 'total_appearances')} as avg_assists_per_match,
           {rounded('total_minutes', 'total_appearances', digits=0)} as avg_minutes_per_match,
           {rounded('total_goals', 'total_minutes', 90)} as goals_per_90_min
    from (
        select player_full_name, position, nationality, current_club_name, age, is_active,
               is_international, latest_market_value_eur, season, season_start_year, club_at_time,
               sum(n) as total_appearances, sum(goals) as total_goals,
               sum(assists) as total_assists, sum(minutes) as total_minutes,
               sum(yellow) as total_yellow_cards, sum(red) as total_red_cards
        from (
            select sk_player, sk_club, season_label as season, season_start_year, count(*) as n,
                   sum(goals) as goals, sum(assists) as assists, sum(minutes_played) as minutes,
                   sum(yellow_cards) as yellow, sum(red_cards) as red
            from fact_appearances join dim_date using (sk_date)
            group by sk_player, sk_club, season_label, season_start_year)
        join dim_player using (sk_player)
        join (select sk_club, club_name as club_at_time from dim_club) using (sk_club)
        group by all) m""",
)
cte(
    "club_view", ["fact_matches"],
    """
    select game_id, club_key, club_id, competition_key, competition_id, date_key, hosting,
           coalesce(goals_scored > goals_conceded, false) as is_win,
           ['LOSS', 'DRAW', 'WIN'][
               2 + coalesce(cast(sign(goals_scored - goals_conceded) as integer), -1)] as result,
           goals_scored, goals_conceded, goals_scored - goals_conceded as goal_difference
    from (
        select game_id, competition_key, competition_id, date_key, unnest([
            {'hosting': 'Home', 'club_key': home_club_key, 'club_id': home_club_id,
             'goals_scored': home_goals, 'goals_conceded': away_goals},
            {'hosting': 'Away', 'club_key': away_club_key, 'club_id': away_club_id,
             'goals_scored': away_goals, 'goals_conceded': home_goals}], recursive := true)
        from fact_matches)""",
)
cte(
    "mart_club_match_stats", ["club_view", "dim_club", "dim_competitions", "dim_date"],
    f"""
    select club_name, competition_name, competition_type, season, hosting,
           cast(games as bigint) as total_matches, cast(won as bigint) as wins,
           cast(drawn as bigint) as draws, cast(lost as bigint) as losses,
           {rounded('won', 'n', 100, 1)} as win_rate_pct,
           cast(scored as bigint) as total_goals_scored,
           cast(conceded as bigint) as total_goals_conceded,
           {rounded('scored', 'with_score')} as avg_goals_scored,
           {rounded('conceded', 'with_other')} as avg_goals_conceded,
           cast(difference as bigint) as total_goal_difference
    from (
        select club_name, competition_name, competition_type, season, hosting, sum(n) as n,
               sum(games) as games, sum(won) as won, sum(drawn) as drawn, sum(lost) as lost,
               sum(scored) as scored, sum(with_score) as with_score, sum(conceded) as conceded,
               sum(with_other) as with_other, sum(difference) as difference
        from (
            select club_id, competition_id, hosting,
                   (select season_label from dim_date where sk_date = date_key) as season,
                   count(*) as n, count(game_id) as games, count(*) filter (is_win) as won,
                   count(*) filter (result = 'DRAW') as drawn,
                   count(*) filter (result = 'LOSS') as lost, sum(goals_scored) as scored,
                   count(goals_scored) as with_score, sum(goals_conceded) as conceded,
                   count(goals_conceded) as with_other, sum(goal_difference) as difference
            from club_view group by club_id, competition_id, hosting, date_key)
        left join (select club_id, club_name from dim_club) using (club_id)
        left join (select competition_id, competition_name, competition_type
                   from dim_competitions) using (competition_id)
        group by all)""",
)
cte(
    "seasoned_transfers", ["fact_transfers", "dim_date"],
    """
    select t.* exclude (transfer_season), s.season_label as transfer_season
    from fact_transfers t left join (select sk_date, season_label from dim_date) s
         on s.sk_date = t.sk_date""",
)
cte(
    "mart_club_transfer_spending", ["seasoned_transfers", "dim_club", "dim_player"],
    """
    with clubs as (select sk_club, club_name from dim_club),
    bought as (select sk_to_club as club, transfer_season as season, sum(transfer_fee_eur) as fee
               from seasoned_transfers group by 1, 2),
    sold as (select sk_from_club as club, transfer_season as season, sum(transfer_fee_eur) as fee
             from seasoned_transfers group by 1, 2)
    select (select club_name from clubs where sk_club = sk_to_club) as buying_club,
           (select club_name from clubs where sk_club = sk_from_club) as selling_club,
           player_full_name, position, transfer_season, transfer_fee_eur,
           player_value_at_transfer_eur, transfer_fee_type, transfer_date,
           cast(bought.fee as bigint) as total_spent_that_season,
           cast(sold.fee as bigint) as total_received_that_season
    from seasoned_transfers
    join bought on bought.club is not distinct from sk_to_club
         and bought.season is not distinct from transfer_season
    join sold on sold.club is not distinct from sk_from_club
         and sold.season is not distinct from transfer_season
    left join (select sk_player, player_full_name, position from dim_player) using (sk_player)""",
)
cte(
    "mart_match_events_live", ["fact_game_events", "dim_club", "dim_date"],
    """
    with kinds as (
        select game_id, club_id, count(*) filter (event_type = 'goals') as goals,
               count(*) filter (event_type = 'cards') as cards,
               count(*) filter (event_type = 'substitutions') as subs
        from fact_game_events group by game_id, club_id)
    select e.game_id, (select club_name from dim_club where sk_club = e.sk_club) as club_name,
           (select full_date from dim_date where sk_date = e.sk_date) as event_date,
           minute, event_type, description, player_id, source_type, goals as goals_in_match,
           cards as cards_in_match, subs as subs_in_match
    from fact_game_events e join kinds on kinds.game_id is not distinct from e.game_id
         and kinds.club_id is not distinct from e.club_id""",
)

MODELS = {
    "stg_appearances": ("TBL-13 PRJ-2 NUL-3 SCL-6 PRJ-5 FLT-4", ("appearance_date", "loaded_at")),
    "stg_clubs": ("TBL-14 PRJ-2 PRJ-5 FLT-4", ("loaded_at",)),
    "stg_competitions": ("TBL-15 PRJ-2 PRJ-5 FLT-4", ("loaded_at",)),
    "stg_game_events": ("TBL-16 PRJ-2 PRJ-4 PRJ-5 FLT-4", ("event_date", "loaded_at")),
    "stg_games": ("TBL-17 SCL-2 PRJ-2 FLT-4", ("game_date", "loaded_at")),
    "stg_player_valuations": ("TBL-18 FLT-5 WIN-1 SCL-11", ("valuation_date", "loaded_at")),
    "stg_players": (
        "TBL-19 PRJ-2 FLT-4", ("date_of_birth", "contract_expiration_date", "loaded_at")),
    "stg_transfers": ("TBL-20 NUL-3 SCL-10 FLT-4", ("transfer_date", "loaded_at")),
    "dim_date": ("TBL-23 INC-5 PRJ-8 SCL-3 SCL-4", ("date_id", "full_date")),
    "dim_club": ("TBL-21 PRJ-8 PRJ-5", ("updated_at",)),
    "dim_club_extended": ("TBL-21 JON-9 SET-2 WIN-4", ("updated_at",)),
    "dim_competitions": ("TBL-22 PRJ-8 PRJ-5", ("updated_at",)),
    "dim_player": (
        "TBL-24 FLT-6 JON-4 PRJ-8",
        ("date_of_birth", "contract_expiration_date", "latest_valuation_date", "updated_at"),
    ),
    "fact_appearances": ("TBL-25 JON-1", ("appearance_date", "loaded_at")),
    "fact_game_events": ("TBL-26 JON-1", ("event_date", "loaded_at")),
    "fact_matches": ("TBL-27 JON-1 JON-2 PRJ-9 SCL-7", ("game_date", "loaded_at")),
    "fact_player_valuations": ("TBL-28 JON-1", ("valuation_date", "loaded_at")),
    "fact_transfers": ("TBL-29 PRJ-8 JON-1 JON-2", ("transfer_date", "loaded_at")),
    "mart_player_performance": ("TBL-30 JON-3 AGG-14 AGG-16 AGG-17", ()),
    "mart_club_match_stats": ("TBL-31 SET-1 SCL-9 JON-4 AGG-15 AGG-16 AGG-17 NUL-9", ()),
    "mart_club_transfer_spending": ("TBL-32 JON-4 WIN-2", ("transfer_date",)),
    "mart_match_events_live": ("TBL-33 JON-4 WIN-3", ("event_date",)),
}
for _name, (_covers, _days) in MODELS.items():
    # The calendar is generated, so it is only registered where the test tables use it.
    if _name != "dim_date":
        check(_name, _covers, table_sql(_name, _days))(lambda ctx, name=_name: ctx.ref(name))


@check(
    "q_dim_date", "TBL-23 INC-5 PRJ-8 SCL-2 SCL-3 SCL-4",
    with_ctes(
        ["dim_date"],
        """select d.* replace (cast(date_id as varchar) as date_id,
                               cast(full_date as varchar) as full_date), n.shipped
           from dim_date d join (select cast(l_shipdate as date) as day, count(*) as shipped
                                 from lineitem group by 1) n on d.date_id = n.day""",
    ),
)
def _(ctx):
    shipped = ctx.base("lineitem").groupBy(F.to_date("l_shipdate").alias("date_id")).agg(
        F.count(F.lit(1)).alias("shipped")
    )
    return shipped.join(ctx.ref("dim_date"), "date_id")


@check("q_club_view", "SET-1 SCL-9", table_sql("club_view"))
def _(ctx):
    return club_view(ctx.ref("fact_matches"))


# --- enrichment ----------------------------------------------------------------------------------

cte(
    "enriched",
    [f"raw_{t}" for t in
     ("game_events", "games", "competitions", "players", "clubs", "game_lineups", "club_games")],
    """
    select e.game_event_id, e.game_id, e.date as event_date, g.date as game_date, e.minute,
           e.type as event_type, e.description, e.player_in_id, e.player_assist_id,
           e.player_id, p.name as player_name, p.position as player_position,
           p.sub_position as player_sub_position, p.foot as player_foot,
           p.country_of_citizenship as player_nationality, p.height_in_cm as player_height_cm,
           p.market_value_in_eur as player_market_value,
           e.club_id, c.name as club_name, c.coach_name,
           c.total_market_value as club_total_market_value,
           l.type as lineup_type, l.position as lineup_position, l.number as shirt_number,
           coalesce(try_cast(l.team_captain as integer), 0) as team_captain,
           s.own_goals as club_goals_scored, s.opponent_goals as club_goals_conceded,
           s.own_position as club_league_position,
           s.opponent_position as opponent_league_position, s.hosting, s.is_win,
           g.competition_id, k.name as competition_name, k.type as competition_type,
           k.country_name, k.confederation,
           g.season, g.round, g.stadium, g.attendance, g.referee, g.home_club_id, g.away_club_id,
           g.home_club_name, g.away_club_name, g.home_club_goals, g.away_club_goals,
           g.home_club_formation, g.away_club_formation
    from raw_game_events e
    left join raw_games g on e.game_id = trim(g.game_id)
    left join raw_competitions k on g.competition_id = k.competition_id
    left join raw_players p on e.player_id = cast(p.player_id as varchar)
    left join raw_clubs c on e.club_id = c.club_id
    left join raw_game_lineups l on e.game_id = l.game_id
          and e.player_id = l.player_id
    left join raw_club_games s on e.game_id = s.game_id
          and e.club_id = s.club_id""",
)


def raw_for_enrichment(ctx):
    return {name: ctx.raw(name) for name in enrichment.SELECTIONS}


V1 = ", ".join(enrichment.ENRICHED_COLUMNS_V1)


@check("q_enrich", "TBL-35 SRC-8 JON-5 PRJ-2 PRJ-7 NUL-2", table_sql("enriched"))
def _(ctx):
    return enrichment.enriched_events(raw_for_enrichment(ctx), sample_games=None)


@check(
    "q_enrich_v1", "TBL-36 JON-5 NUL-4",
    with_ctes(
        ["enriched"],
        f"""select {V1} from (select * rename (event_type as type,
                player_sub_position as sub_position, club_total_market_value as club_market_value,
                country_name as competition_country)
            from (select * replace (coalesce(event_date, game_date) as event_date) from enriched))""",
    ),
)
def _(ctx):
    return enrichment.enriched_events_v1(raw_for_enrichment(ctx), sample_games=None)


@check(
    "q_enrich_streamed", "TBL-37 PRJ-1",
    table_sql("enriched", without=enrichment.NOT_STREAMED),
)
def _(ctx):
    return enrichment.streamed_events(raw_for_enrichment(ctx), sample_games=None)


@check(
    "q_enrich_sampled", "SRT-5 JON-6 TBL-35",
    with_ctes(
        ["enriched"],
        """select * from enriched where game_id in (
               select game_id from (select distinct game_id from enriched
                                    where game_id is not null)
               order by md5(cast(game_id as varchar) || '/42'), game_id limit 20)""",
    ),
)
def _(ctx):
    return enrichment.enriched_events(raw_for_enrichment(ctx), sample_games=20)


# --- incremental facts, upsert, histories --------------------------------------------------------


def two_loads(ctx):
    """Matches as loaded first, and as loaded later: late matches and corrected scores."""
    early, late = RUN_TS.replace(day=1), RUN_TS.replace(day=2)
    stored = VersionedTable(ctx.spark, work_path(ctx.spark, "all_matches"))
    rows = stored.write(ctx.ref("fact_matches").drop("loaded_at"))
    first = rows.filter(F.col("game_id") % 5 != 0).withColumn("loaded_at", F.lit(early))
    second = rows.filter((F.col("game_id") % 5 == 0) | (F.col("game_id") % 10 == 3))
    second = second.withColumns({"round": F.lit("replayed"), "loaded_at": F.lit(late)})
    return first, second


MERGED = """select * replace (
        case when game_id % 5 = 0 or game_id % 10 = 3 then 'replayed' else round end as round,
        case when game_id % 5 = 0 or game_id % 10 = 3 then '2024-07-02 00:00:00'
             else '2024-07-01 00:00:00' end as loaded_at,
        cast(game_date as varchar) as game_date)
    from fact_matches"""


@check("q_merge", "INC-1 FLT-7", with_ctes(["fact_matches"], MERGED))
def _(ctx):
    first, second = two_loads(ctx)
    return merge_upsert(first, second, ["game_id"], [F.desc("loaded_at")])


@check(
    "q_incremental_fact", "INC-1 INC-2 FLT-7 TBL-27 SNK-1 SRC-3",
    with_ctes(["fact_matches"], MERGED),
)
def _(ctx):
    """First run, later run, and a repeat of the later run that must change nothing."""
    table = VersionedTable(ctx.spark, work_path(ctx.spark, "fact_matches"))
    first, second = two_loads(ctx)
    for rows in (first, first.unionByName(second), second):
        build_incremental(table, rows, ["game_id"])
    return table.read()


@check("q_incremental_partitions", "INC-1 INC-2 FLT-7", with_ctes(["fact_matches"], MERGED))
def _(ctx):
    """The same runs on a table laid out by season, where only touched seasons are rewritten."""
    path = work_path(ctx.spark, "fact_matches")
    first, second = two_loads(ctx)
    for run, rows in enumerate((first, first.unionByName(second), second)):
        out = build_partitions(ctx.spark, path, f"{path}-{run}", rows, ["game_id"], "season")
    return out


@check(
    "q_stored_fact", "TBL-26 INC-6 SNK-1",
    table_sql("fact_game_events", ("event_date", "loaded_at")),
)
def _(ctx):
    return build_fact(ctx.warehouse, "fact_game_events", work_path(ctx.spark, "fact_game_events"))


@check(
    "q_union_stream", "SET-5 INC-1",
    with_ctes(
        ["stg_game_events"],
        """select * exclude (loaded_at)
               replace (cast(event_date as varchar) as event_date,
                        case when minute >= 60 then 'stream' else 'batch' end as source_type)
           from stg_game_events""",
    ),
)
def _(ctx):
    """Late events arrive by stream and replace or extend the batch rows by event id."""
    rows = ctx.ref("stg_game_events").drop("source_type", "loaded_at")
    both = union_stream(rows, rows.filter(F.col("minute") >= 60))
    batch, stream = (both.filter(F.col("source_type") == s) for s in ("batch", "stream"))
    return merge_upsert(batch, stream, ["game_event_id"])


def second_season(ctx) -> Warehouse:
    """The same players a month later: some moved, some gained or lost a value, some are new."""
    raw = ctx.raw("players").withColumns(
        {
            "current_club_id": F.when(
                F.col("player_id") % 10 == 0, F.col("current_club_id") + 1
            ).otherwise(F.col("current_club_id")),
            "market_value_in_eur": F.when(
                F.col("player_id") % 15 == 0, F.lit(None)
            ).otherwise(F.col("market_value_in_eur")),
            "first_name": F.lit("Renamed"),
        }
    ).filter(F.col("player_id") % 20 != 7)
    sources = {"players": clean(raw, SPECS["players"], as_of=AS_OF)}
    return Warehouse(ctx.spark, sources, run_ts=RUN_TS.replace(month=8))


def first_season(ctx) -> Warehouse:
    raw = ctx.raw("players").filter(F.col("player_id") % 25 != 11)
    return Warehouse(
        ctx.spark, {"players": clean(raw, SPECS["players"], as_of=AS_OF)}, run_ts=RUN_TS
    )


SCD2 = """
    , source as (
        select player_id, player_full_name, current_club_id, current_club_name, is_active,
               contract_expiration_date, current_market_value_in_eur
        from stg_players),
    old as (select *, '2024-07-01 00:00:00' as loaded_at, '2024-07-01 00:00:00' as valid_from
            from source where player_id % 25 <> 11),
    new as (select * replace (case when player_id % 10 = 0 then current_club_id + 1
                              else current_club_id end as current_club_id,
                              case when player_id % 15 = 0 then null
                              else current_market_value_in_eur end as current_market_value_in_eur),
            '2024-08-01 00:00:00' as loaded_at, '2024-08-01 00:00:00' as valid_from
            from source where player_id % 20 <> 7),
    changed as (
        select o.player_id from old o join new n on o.player_id = n.player_id
        where o.current_club_id is distinct from n.current_club_id
           or o.current_market_value_in_eur is distinct from n.current_market_value_in_eur
           or o.is_active is distinct from n.is_active),
    versions as (
        select o.*, case when c.player_id is not null then '2024-08-01 00:00:00' end as valid_to,
               case when c.player_id is not null then '2024-08-01 00:00:00'
                    else '2024-07-01 00:00:00' end as updated_at
        from old o left join changed c on o.player_id = c.player_id
        union all
        select n.*, null, '2024-08-01 00:00:00' from new n
        where n.player_id in (select player_id from changed)
           or n.player_id not in (select player_id from old))
    select * replace (cast(contract_expiration_date as varchar) as contract_expiration_date),
           md5(cast(player_id as varchar) || '-' || valid_from) as scd_id
    from versions"""


@check("q_scd2", "INC-3 TBL-34", with_ctes(["stg_players"], SCD2.lstrip()))
def _(ctx):
    before = history.next_player_history(None, first_season(ctx), RUN_TS)
    return history.next_player_history(before, second_season(ctx), RUN_TS.replace(month=8))


@check("q_snapshot_stored", "INC-3 TBL-34 INC-6", with_ctes(["stg_players"], SCD2.lstrip()))
def _(ctx):
    """The same history kept in a table, with the second run repeated."""
    path = work_path(ctx.spark, "snap_dim_player")
    history.snap_dim_player(first_season(ctx), path, RUN_TS)
    for _ in range(2):
        out = history.snap_dim_player(second_season(ctx), path, RUN_TS.replace(month=8))
    return out


@check(
    "q_valuation_history", "INC-4",
    with_ctes(
        ["stg_player_valuations"],
        """select player_id, cast(valuation_date as varchar) as valuation_date,
                  market_value_in_eur, current_club_id, '2024-07-01 00:00:00' as loaded_at,
                  '2024-07-01 00:00:00' as valid_from, cast(null as varchar) as valid_to,
                  '2024-07-01 00:00:00' as updated_at,
                  md5(cast(player_id as varchar) || '-2024-07-01 00:00:00') as scd_id
           from stg_player_valuations where is_latest_valuation""",
    ),
)
def _(ctx):
    path = work_path(ctx.spark, "snap_player_valuations")
    return history.snap_player_valuations(ctx.warehouse, path, RUN_TS)


# --- model tests ---------------------------------------------------------------------------------


def tests_sql(models, tests) -> str:
    """One count per test, as plain SQL."""
    parts, needs = [], []
    for name in models:
        needs.append(name)
        for c in tests[name]:
            if c.kind == "not_null":
                n = f"select count(*) from {name} where {c.column} is null"
            elif c.kind == "unique":
                n = (f"select count(*) from (select {c.column} from {name} where {c.column} is not "
                     f"null group by {c.column} having count(*) > 1)")
            elif c.kind == "relationship":
                needs.append(c.parent)
                n = (f"select count(*) from {name} where {c.column} is not null and {c.column} "
                     f"not in (select {c.parent_column} from {c.parent})")
            elif c.kind == "values":
                listed = ", ".join(repr(v) if isinstance(v, str) else str(v).lower() for v in c.values)
                n = f"select count(*) from {name} where {c.column} not in ({listed})"
            else:
                low = f"{c.column} < {c.low}" if c.low is not None else "false"
                high = f"{c.column} > {c.high}" if c.high is not None else "false"
                n = f"select count(*) from {name} where {low} or {high}"
            parts.append(
                f"select '{name}' as model, '{c.kind}_{c.column}' as test, "
                f"'{c.severity}' as severity, ({n}) as violations"
            )
    union = " union all ".join(parts)
    return with_ctes(
        needs,
        f"""select *, case when violations = 0 then 'pass' when severity = 'warn' then 'warn'
                      else 'error' end as status from ({union})""",
    )


GROUPS = {
    "staging": [m for m in model_tests.TESTS if m.startswith("stg_")],
    "dimensions": [m for m in model_tests.TESTS if m.startswith("dim_")],
    "fact_appearances": ["fact_appearances"],
    "fact_matches": ["fact_matches"],
    "fact_transfers": ["fact_transfers"],
    "fact_player_valuations": ["fact_player_valuations"],
    "fact_game_events": ["fact_game_events"],
    "marts": [m for m in model_tests.TESTS if m.startswith("mart_")],
}
for _group, _models in GROUPS.items():
    check(
        f"q_quality_{_group}", "QLT-1 QLT-2 QLT-3 QLT-4 QLT-6 JON-7",
        tests_sql(_models, model_tests.TESTS),
    )(lambda ctx, models=_models: model_tests.report(ctx.warehouse, models))

_OPTIONAL = ["fact_matches", "fact_transfers", "fact_game_events", "dim_player", "dim_competitions"]
check("q_quality_optional", "QLT-4 QLT-5", tests_sql(_OPTIONAL, model_tests.OPTIONAL_TESTS))(
    lambda ctx: model_tests.report(ctx.warehouse, _OPTIONAL, model_tests.OPTIONAL_TESTS)
)
