"""The twelve cleaned tables."""

from __future__ import annotations

from checks.registry import check, cte, table_sql


def t(*names: str) -> str:
    return ", ".join(f"trim({n}) as {n}" for n in names)


def i(*names: str, kind: str = "integer") -> str:
    return ", ".join(f"try_cast(trim({n}) as {kind}) as {n}" for n in names)


def filled(default: str, *names: str) -> str:
    return ", ".join(f"coalesce(trim({n}), '{default}') as {n}" for n in names)


def first_per_key(body: str, key: str, columns: str) -> str:
    """One row per key, the first by all columns."""
    order = ", ".join(f"{c} asc nulls first" for c in columns.split())
    return f"""select * from ({body}) as cleaned
        qualify row_number() over (partition by {key} order by {order}) = 1"""


COLUMNS = {
    "appearances": "appearance_id game_id player_id player_club_id player_current_club_id date "
    "player_name competition_id yellow_cards red_cards goals assists minutes_played",
    "club_games": "game_id club_id own_goals own_manager_name opponent_id opponent_goals "
    "opponent_manager_name hosting is_win is_draw is_loss",
    "clubs": "club_id name domestic_competition_id squad_size average_age foreigners_number "
    "foreigners_percentage national_team_players stadium_name stadium_seats last_season "
    "net_transfer_record_eur",
    "competitions": "competition_id name sub_type type country_id country_name "
    "domestic_league_code confederation total_clubs",
    "countries": "country_id country_name country_code confederation total_clubs total_players "
    "average_age",
    "game_events": "game_event_id date game_id minute type club_id club_name player_id description",
    "game_lineups": "game_lineups_id date game_id player_id club_id player_name type position "
    "number team_captain",
    "games": "game_id competition_id season round date home_club_id away_club_id home_club_goals "
    "away_club_goals home_club_position away_club_position home_club_manager_name "
    "away_club_manager_name home_club_formation away_club_formation home_club_name "
    "away_club_name aggregate competition_type",
    "national_teams": "national_team_id name country_id country_name country_code confederation "
    "squad_size average_age foreigners_number foreigners_percentage total_market_value "
    "fifa_ranking",
    "player_valuations": "player_id date market_value_in_eur current_club_name current_club_id "
    "player_club_domestic_competition_id",
    "transfers": "player_id transfer_date transfer_season from_club_id to_club_id from_club_name "
    "to_club_name transfer_fee market_value_in_eur player_name",
}
KEYS = {
    "appearances": "appearance_id",
    "club_games": "game_id, club_id",
    "clubs": "club_id",
    "competitions": "competition_id",
    "countries": "country_id",
    "game_events": "game_event_id",
    "game_lineups": "game_lineups_id",
    "games": "game_id",
    "national_teams": "national_team_id",
    "player_valuations": "player_id, date",
    "transfers": "player_id, transfer_date, from_club_id, to_club_id",
}
BODIES = {
    "appearances": f"""
        select * from (
            select {t('appearance_id', 'competition_id')},
                   {i('game_id', 'player_id', 'player_club_id', 'player_current_club_id')},
                   {i('date', kind='date')}, {filled('Unknown', 'player_name')},
                   {i('yellow_cards', 'red_cards', 'goals', 'assists', 'minutes_played')}
            from raw_appearances)
        where minutes_played between 1 and 135""",
    "club_games": f"""
        select game_id, club_id, own_goals, own_manager_name, opponent_id, opponent_goals,
               opponent_manager_name, hosting,
               cast(own_goals > opponent_goals as integer) as is_win,
               cast(own_goals = opponent_goals as integer) as is_draw,
               cast(own_goals < opponent_goals as integer) as is_loss
        from (select {i('game_id', 'club_id', 'own_goals', 'opponent_id', 'opponent_goals')},
                     {filled('Unknown', 'own_manager_name', 'opponent_manager_name')},
                     {t('hosting')}
              from raw_club_games)""",
    "clubs": f"""
        select club_id, name, domestic_competition_id,
               case when squad_size > 0 then squad_size end as squad_size, average_age,
               foreigners_number, foreigners_percentage, national_team_players, stadium_name,
               case when stadium_seats > 0 then stadium_seats end as stadium_seats, last_season,
               try_cast(
                   try_cast(regexp_replace(money, '[^0-9.]', '', 'g') as decimal(20,4))
                   * case when money like '%bn' then 1000000000 when money like '%m' then 1000000
                          when money like '%k' then 1000 else 1 end
                   * case when money like '%-%' then -1 else 1 end as bigint)
                   as net_transfer_record_eur
        from (select {i('club_id', 'squad_size', 'foreigners_number', 'national_team_players')},
                     {i('stadium_seats', 'last_season')},
                     {i('average_age', 'foreigners_percentage', kind='double')},
                     {t('name', 'domestic_competition_id', 'stadium_name')},
                     nullif(trim(net_transfer_record), '') as money
              from raw_clubs)""",
    "competitions": f"""
        select {t('competition_id', 'name', 'sub_type', 'type', 'confederation')},
               try_cast(nullif(trim(country_id), '-1') as integer) as country_id,
               {filled('International', 'country_name')}, {filled('N/A', 'domestic_league_code')},
               {i('total_clubs')}
        from raw_competitions""",
    "countries": f"""
        select {i('country_id', 'total_clubs', 'total_players')},
               {t('country_name', 'country_code', 'confederation')},
               {i('average_age', kind='double')}
        from raw_countries""",
    "game_events": f"""
        select {t('game_event_id', 'club_name')}, {i('date', kind='date')},
               {i('game_id', 'minute', 'club_id', 'player_id')}, lower(trim(type)) as type,
               {filled('Unknown', 'description')}
        from raw_game_events""",
    "game_lineups": f"""
        select * replace (case lower(position) when 'midfield' then 'Central Midfield'
                          when 'attack' then 'Forward' else position end as position)
        from (select {t('game_lineups_id', 'player_name', 'type', 'position')},
                     {i('date', kind='date')},
                     {i('game_id', 'player_id', 'club_id', 'number', 'team_captain')}
              from raw_game_lineups)
        where (number is null or number between 1 and 99) and position <> ''""",
    "games": f"""
        select {i('game_id', 'season', 'home_club_id', 'away_club_id', 'home_club_goals')},
               {i('away_club_goals', 'home_club_position', 'away_club_position')},
               {i('date', kind='date')},
               {t('competition_id', 'round', 'aggregate', 'competition_type')},
               {filled('Unknown', 'home_club_manager_name', 'away_club_manager_name')},
               {filled('Unknown', 'home_club_formation', 'away_club_formation')},
               {filled('Unknown', 'home_club_name', 'away_club_name')}
        from raw_games""",
    "national_teams": f"""
        select {i('national_team_id', 'country_id', 'squad_size', 'foreigners_number')},
               {i('fifa_ranking')}, {i('total_market_value', kind='bigint')},
               {i('average_age', 'foreigners_percentage', kind='double')},
               {t('name', 'country_name', 'country_code')}, {filled('Unknown', 'confederation')}
        from raw_national_teams""",
    "player_valuations": f"""
        select {i('player_id', 'current_club_id')}, {i('date', kind='date')},
               case when try_cast(trim(market_value_in_eur) as bigint) > 0
                    then try_cast(trim(market_value_in_eur) as bigint) end as market_value_in_eur,
               {t('current_club_name')},
               {filled('Unknown', 'player_club_domestic_competition_id')}
        from raw_player_valuations""",
    "transfers": f"""
        select {i('player_id', 'from_club_id', 'to_club_id')}, {i('transfer_date', kind='date')},
               case when trim(transfer_season) = '' or transfer_season is null then 'Unknown'
                    else trim(transfer_season) end as transfer_season,
               {filled('Unknown Club', 'from_club_name', 'to_club_name')},
               coalesce(cast(trunc(try_cast(trim(transfer_fee) as double)) as bigint), 0)
                   as transfer_fee,
               cast(trunc(try_cast(trim(market_value_in_eur) as double)) as bigint)
                   as market_value_in_eur,
               {filled('Unknown Player', 'player_name')}
        from raw_transfers""",
}
for _name, _body in BODIES.items():
    cte(_name, [f"raw_{_name}"], first_per_key(_body, KEYS[_name], COLUMNS[_name]))

# Players: raw ids are unique, so the first row per key is the row itself.
cte(
    "players",
    ["raw_players"],
    """
    select player_id, trim(first_name) as first_name, trim(last_name) as last_name,
           trim(name) as name, last_season, current_club_id,
           coalesce(trim(country_of_birth), 'Unknown') as country_of_birth,
           coalesce(trim(country_of_citizenship), 'Unknown') as country_of_citizenship,
           cast(date_of_birth as date) as date_of_birth,
           coalesce(trim(sub_position), 'Unknown') as sub_position,
           case when trim(position) = 'Missing' then 'Unknown' else trim(position) end as position,
           coalesce(trim(foot), 'Unknown') as foot,
           case when height_in_cm between 140 and 220 then height_in_cm end as height_in_cm,
           cast(contract_expiration_date as date) as contract_expiration_date,
           coalesce(international_caps, 0) as international_caps,
           coalesce(international_goals, 0) as international_goals,
           coalesce(trim(current_club_domestic_competition_id), 'Unknown')
               as current_club_domestic_competition_id,
           coalesce(trim(current_club_name), 'Unknown Club') as current_club_name,
           market_value_in_eur, highest_market_value_in_eur,
           cast(year(date '2024-06-30') - year(date_of_birth)
                - case when month(date_of_birth) * 100 + day(date_of_birth) > 630
                       then 1 else 0 end as integer) as age,
           coalesce(international_caps, 0) > 0 as is_international,
           last_season = (select max(last_season) from raw_players) as is_active
    from raw_players""",
)

DAYS = {
    "appearances": ("date",), "game_events": ("date",), "game_lineups": ("date",),
    "games": ("date",), "player_valuations": ("date",), "transfers": ("transfer_date",),
    "players": ("date_of_birth", "contract_expiration_date"),
}
COVERS = {
    "appearances": "TBL-1 PRJ-3 CST-1 CST-6 FLT-1 NUL-1 AGG-18 WIN-4",
    "club_games": "TBL-2 PRJ-1 CST-1 CST-11 SCL-8 NUL-1 AGG-18",
    "clubs": "TBL-3 PRJ-1 CST-1 CST-2 CST-8 NUL-6 SCL-12",
    "competitions": "TBL-4 PRJ-1 NUL-5 NUL-1",
    "countries": "TBL-5 PRJ-1 CST-1 CST-2",
    "game_events": "TBL-6 PRJ-1 CST-6 SCL-1 NUL-1",
    "game_lineups": "TBL-7 FLT-2 NUL-7 FLT-3",
    "games": "TBL-8 PRJ-1 CST-6 CST-1 NUL-1",
    "national_teams": "TBL-9 PRJ-1 CST-1 CST-2 CST-4 NUL-1",
    "player_valuations": "TBL-10 CST-6 CST-4 NUL-6 NUL-1",
    "players": "TBL-11 CST-7 NUL-7 NUL-1 NUL-2 NUL-6 JON-8 AGG-20 SCL-5 SCL-6 SCL-18",
    "transfers": "TBL-12 CST-5 CST-6 NUL-8 NUL-1 NUL-2",
}
for _name, _covers in COVERS.items():
    check(f"silver_{_name}", _covers, table_sql(_name, DAYS.get(_name, ())))(
        lambda ctx, name=_name: ctx.silver(name)
    )

