"""Raw football tables derived from the test tables, row by row, with defects mixed in.

Orders play matches, line items play appearances, line-ups and transfers, customers play players,
suppliers play clubs, nations play competitions, countries and national teams, and the event
table plays match events and valuations. Each text is plain SQL that Spark and DuckDB both read;
it only prepares input, the operators under test are not part of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)

RAW_SQL = {
    "games": """
        select case when o_orderkey % 50 = 0 then '  ' || cast(o_orderkey as string) || ' '
                    else cast(o_orderkey as string) end as game_id,
               'L' || cast(o_custkey % 27 as string) as competition_id,
               case when o_orderkey % 211 = 0 then 'x'
                    else cast(year(o_orderdate)
                              - case when month(o_orderdate) >= 7 then 0 else 1 end as string)
               end as season,
               o_orderpriority as round,
               case when o_orderkey % 173 = 0 then 'no date' when o_orderkey % 179 = 0 then null
                    else cast(cast(o_orderdate as date) as string) end as date,
               cast(o_custkey % 120 as string) as home_club_id,
               cast((o_orderkey * 7 + 3) % 120 as string) as away_club_id,
               case when o_orderkey % 97 = 0 then '' when o_orderkey % 101 = 0 then 'x'
                    else cast(o_orderkey % 5 as string) end as home_club_goals,
               case when o_orderkey % 103 = 0 then null
                    else cast((o_orderkey + o_custkey) % 4 as string) end as away_club_goals,
               case when o_orderkey % 3 = 0 then null else cast(o_custkey % 20 + 1 as string)
               end as home_club_position,
               case when o_orderkey % 3 = 0 then null else cast(o_orderkey % 20 + 1 as string)
               end as away_club_position,
               case when o_orderkey % 90 = 0 then null
                    else 'Manager ' || cast(o_custkey % 30 as string) end as home_club_manager_name,
               case when o_orderkey % 91 = 0 then null
                    else 'Manager ' || cast(o_orderkey % 30 as string) end as away_club_manager_name,
               'Stadium ' || cast(o_custkey % 120 as string) as stadium,
               cast(o_custkey * 10 as string) as attendance,
               'Referee ' || cast(o_orderkey % 17 as string) as referee,
               'u/' || cast(o_orderkey as string) as url,
               case when o_orderkey % 11 = 0 then null else ' 4-3-3' end as home_club_formation,
               case when o_orderkey % 13 = 0 then null else '4-4-2 ' end as away_club_formation,
               case when o_orderkey % 301 = 0 then null
                    else 'Club ' || cast(o_custkey % 120 as string) end as home_club_name,
               case when o_orderkey % 303 = 0 then null
                    else 'Club ' || cast((o_orderkey * 7 + 3) % 120 as string) end as away_club_name,
               case when o_orderkey % 77 = 0 then 'n.v.'
                    else cast(o_orderkey % 5 as string) || ':'
                         || cast((o_orderkey + o_custkey) % 4 as string) end as aggregate,
               case o_orderstatus when 'F' then 'domestic_league' when 'O' then 'domestic_cup'
                    else 'other' end as competition_type
        from {orders}""",
    "appearances": """
        select cast(l_orderkey as string) || '_' || cast(l_linenumber as string) as appearance_id,
               cast(l_orderkey as string) as game_id,
               case when l_partkey % 997 = 0 then 'p?' else cast(l_partkey as string)
               end as player_id,
               cast(l_suppkey as string) as player_club_id,
               cast((l_suppkey + 1) % 120 as string) as player_current_club_id,
               cast(cast(l_shipdate as date) as string) as date,
               case when l_partkey % 400 = 0 then null
                    else '  Player ' || cast(l_partkey as string) end as player_name,
               'L' || cast(l_orderkey % 26 as string) as competition_id,
               cast(l_linenumber % 4 as string) as yellow_cards,
               case when l_partkey % 50 = 0 then '1' else '0' end as red_cards,
               case when l_quantity = 13 then '' when l_quantity = 17 then 'two'
                    else cast(cast(l_quantity as int) % 4 as string) end as goals,
               case when l_partkey % 61 = 0 then null else cast(l_suppkey % 3 as string)
               end as assists,
               cast(cast(l_quantity as int) * 3 - 5 as string) as minutes_played
        from {lineitem}""",
    "club_games": """
        select cast(o_orderkey as string) as game_id, cast(o_custkey % 120 as string) as club_id,
               case when o_orderkey % 97 = 0 then '' else cast(o_orderkey % 5 as string)
               end as own_goals,
               cast(o_custkey % 20 + 1 as string) as own_position,
               case when o_orderkey % 90 = 0 then null
                    else 'Manager ' || cast(o_custkey % 30 as string) end as own_manager_name,
               cast((o_orderkey * 7 + 3) % 120 as string) as opponent_id,
               cast((o_orderkey + o_custkey) % 4 as string) as opponent_goals,
               cast(o_orderkey % 20 + 1 as string) as opponent_position,
               case when o_orderkey % 91 = 0 then null
                    else 'Manager ' || cast(o_orderkey % 30 as string) end as opponent_manager_name,
               'Home' as hosting, '0' as is_win
        from {orders}
        union all
        select cast(o_orderkey as string), cast((o_orderkey * 7 + 3) % 120 as string),
               cast((o_orderkey + o_custkey) % 4 as string),
               cast(o_orderkey % 20 + 1 as string),
               case when o_orderkey % 91 = 0 then null
                    else 'Manager ' || cast(o_orderkey % 30 as string) end,
               cast(o_custkey % 120 as string),
               case when o_orderkey % 97 = 0 then '' else cast(o_orderkey % 5 as string) end,
               cast(o_custkey % 20 + 1 as string),
               case when o_orderkey % 90 = 0 then null
                    else 'Manager ' || cast(o_custkey % 30 as string) end,
               ' Away ', '1'
        from {orders}""",
    "clubs": """
        select cast(s_suppkey as string) as club_id, lower(s_name) as club_code,
               case when s_suppkey % 10 = 9 then 'Twin City' else ' ' || s_name end as name,
               'L' || cast(s_nationkey as string) as domestic_competition_id,
               cast(null as string) as total_market_value,
               cast(s_suppkey % 31 as string) as squad_size,
               '2' || cast(s_suppkey % 10 as string) || '.5' as average_age,
               case when s_suppkey % 8 = 0 then '-' else cast(s_suppkey % 15 as string)
               end as foreigners_number,
               cast(s_suppkey % 90 as string) || '.25' as foreigners_percentage,
               cast(s_suppkey % 12 as string) as national_team_players,
               'Ground ' || cast(s_suppkey as string) as stadium_name,
               cast(s_suppkey % 40 * 1000 as string) as stadium_seats,
               case s_suppkey % 8
                    when 0 then '+€' || cast(s_suppkey % 70 as string) || '.25m'
                    when 1 then '€-' || cast(s_suppkey % 70 as string) || '.06m'
                    when 2 then '+€' || cast(s_suppkey % 900 as string) || 'k'
                    when 3 then '€-' || cast(s_suppkey % 900 as string) || 'k'
                    when 4 then '+-0' when 5 then null when 6 then ' '
                    else '+€' || cast(s_suppkey % 5 as string) || '.5bn' end
               as net_transfer_record,
               cast(null as string) as coach_name,
               cast(2015 + s_suppkey % 10 as string) as last_season,
               'f' as filename, 'u' as url
        from {supplier}""",
    "competitions": """
        select 'L' || cast(n_nationkey as string) as competition_id,
               lower(n_name) as competition_code, n_name || ' ' as name,
               case when n_nationkey % 3 = 0 then 'first_tier' else 'second_tier' end as sub_type,
               case when n_nationkey % 4 = 0 then 'international_cup' else 'domestic_league'
               end as type,
               case when n_nationkey % 5 = 0 then '-1' else cast(n_nationkey as string)
               end as country_id,
               case when n_nationkey % 5 = 0 then null else n_name end as country_name,
               case when n_nationkey % 4 = 0 then null when n_nationkey % 7 = 0 then 'L0'
                    else 'L' || cast(n_nationkey as string) end as domestic_league_code,
               lower(r_name) as confederation,
               case when n_nationkey % 6 = 0 then 'n/a' else cast(n_nationkey % 20 as string)
               end as total_clubs,
               'u' as url
        from {nation} join {region} on n_regionkey = r_regionkey""",
    "countries": """
        select cast(n_nationkey as string) as country_id, n_name as country_name,
               'C' || cast(n_nationkey as string) as country_code, r_name as confederation,
               cast(n_nationkey % 20 as string) as total_clubs,
               case when n_nationkey % 6 = 0 then '?' else cast(n_nationkey * 31 as string)
               end as total_players,
               case when n_nationkey % 8 = 0 then 'young'
                    else '2' || cast(n_nationkey % 10 as string) || '.75' end as average_age,
               'u' as url
        from {nation} join {region} on n_regionkey = r_regionkey""",
    "game_events": """
        select md5(cast(case when event_id % 50 = 49 then event_id - 1 else event_id end as string))
                   as game_event_id,
               case when event_id % 301 = 0 then '31.12.2023'
                    else cast(cast(ts as date) as string) end as date,
               cast(cast((event_id - event_id % 20) / 20 as bigint) as string) as game_id,
               case when event_id % 37 = 0 then '90+2' else cast(event_id % 140 as string)
               end as minute,
               case event_type when 'purchase' then ' Goals ' when 'click' then 'Cards'
                    when 'view' then 'SUBSTITUTIONS' when 'signup' then 'Shootout' end as type,
               cast(cast((event_id - event_id % 20) / 20 as bigint) % 110 + user_id % 3 as string)
                   as club_id,
               case when event_id % 41 = 0 then null
                    else 'Club ' || cast(cast((event_id - event_id % 20) / 20 as bigint) % 110
                                         + user_id % 3 as string) end as club_name,
               cast(user_id as string) as player_id,
               case event_type
                    when 'purchase' then cast(event_id % 9 as string) || '. Goal, Header'
                    when 'click' then case event_id % 3 when 0 then 'Yellow card, Foul'
                         when 1 then 'Second yellow , Argument' else 'Red card, Handball' end
                    when 'signup' then case when event_id % 2 = 0 then 'Scored' else 'Missed' end
                    when 'error' then 'Tactical' end as description,
               case when event_id % 2 = 0 then null else cast(user_id + 1 as string)
               end as player_in_id,
               case when event_id % 7 = 0 then cast(user_id + 2 as string) end as player_assist_id
        from {events}""",
    "game_lineups": """
        select md5(cast(l_orderkey as string) || '-' || cast(l_linenumber as string))
                   as game_lineups_id,
               cast(cast(l_shipdate as date) as string) as date,
               cast(l_orderkey as string) as game_id, cast(l_partkey as string) as player_id,
               cast(l_suppkey as string) as club_id,
               'Player ' || cast(l_partkey as string) as player_name,
               case when l_linenumber % 2 = 0 then 'substitutes' else 'starting_lineup' end as type,
               case l_suppkey % 7 when 0 then 'midfield' when 1 then 'Attack'
                    when 2 then 'Centre-Back' when 3 then ' MIDFIELD' when 4 then '  '
                    when 5 then null else 'Goalkeeper' end as position,
               case when l_quantity = 7 then null when l_quantity = 8 then 'C'
                    else cast(cast(l_quantity as int) * 3 - 20 as string) end as number,
               case when l_linenumber = 1 then '1' when l_linenumber = 7 then '2' else '0'
               end as team_captain
        from {lineitem}""",
    "national_teams": """
        select cast(n_nationkey as string) as national_team_id, 'The ' || n_name as name,
               case when n_nationkey % 3 = 0 then 'the-' || lower(n_name) else lower(n_name)
               end as team_code,
               cast(n_nationkey as string) as country_id, n_name as country_name,
               'C' || cast(n_nationkey as string) as country_code,
               case when n_nationkey % 9 = 0 then null else r_name end as confederation,
               'i' as team_image_url, cast(20 + n_nationkey % 6 as string) as squad_size,
               '2' || cast(n_nationkey % 10 as string) || '.5' as average_age,
               cast(n_nationkey % 23 as string) as foreigners_number,
               cast(n_nationkey as string) || '.5' as foreigners_percentage,
               case when n_nationkey % 7 = 0 then '0'
                    else cast(cast(n_nationkey as bigint) * 1000000007 as string)
               end as total_market_value,
               cast(null as string) as coach_name, cast(n_nationkey % 22 + 1 as string)
                   as fifa_ranking,
               '2025' as last_season, 'u' as url
        from {nation} join {region} on n_regionkey = r_regionkey""",
    "player_valuations": """
        select cast(user_id as string) as player_id, cast(cast(ts as date) as string) as date,
               case when event_id % 67 = 0 then 'abc'
                    else cast(cast(floor(value) as bigint) * 1000 as string)
               end as market_value_in_eur,
               case when event_id % 19 = 0 then 'Unknown'
                    else 'Club ' || cast(user_id % 120 as string) end as current_club_name,
               cast(user_id % 120 as string) as current_club_id,
               case when event_id % 6 = 0 then null else 'L' || cast(user_id % 25 as string)
               end as player_club_domestic_competition_id
        from {events}""",
    "players": """
        select try_cast(c_custkey as int) as player_id, 'First ' as first_name, c_name as last_name,
               ' ' || c_name as name,
               case when c_custkey % 100 = 3 then null
                    else try_cast(2015 + c_custkey % 10 as int) end as last_season,
               try_cast(c_custkey % 120 as int) as current_club_id, 'code' as player_code,
               case when c_custkey % 13 = 0 then null
                    else 'NATION_' || cast(c_nationkey as string) end as country_of_birth,
               'city' as city_of_birth,
               case when c_custkey % 17 = 0 then null
                    else 'NATION_' || cast(c_custkey % 25 as string) end as country_of_citizenship,
               case when c_custkey % 29 = 0 then null
                    else cast(date '1984-02-29' + try_cast(c_custkey % 9000 as int) as timestamp)
               end as date_of_birth,
               case when c_custkey % 19 = 0 then null else 'Centre-Back' end as sub_position,
               case c_custkey % 5 when 0 then 'Missing' when 1 then 'Attack' when 2 then 'Midfield'
                    when 3 then ' Defender ' else 'Goalkeeper' end as position,
               case c_custkey % 4 when 0 then null when 1 then 'Left' when 2 then ' right'
                    else 'both' end as foot,
               try_cast(130 + c_custkey % 100 as int) as height_in_cm,
               case when c_custkey % 3 = 0 then null
                    else cast(date '2025-06-30' + try_cast(c_custkey % 1500 as int) as timestamp)
               end as contract_expiration_date,
               'agent' as agent_name, 'image' as image_url,
               case when c_custkey % 7 = 0 then null else try_cast(c_custkey % 120 as int)
               end as international_caps,
               case when c_custkey % 7 = 0 then null else try_cast(c_custkey % 30 as int)
               end as international_goals,
               try_cast(c_nationkey as int) as current_national_team_id, 'u' as url,
               case when c_custkey % 14 = 0 then null
                    else 'L' || cast(c_custkey % 25 as string)
               end as current_club_domestic_competition_id,
               case when c_custkey % 23 = 0 then null
                    else 'Club ' || cast(c_custkey % 120 as string) end as current_club_name,
               try_cast(cast(floor(abs(c_acctbal)) as bigint) * 1000 as int)
                   as market_value_in_eur,
               try_cast(cast(floor(abs(c_acctbal)) as bigint) * 1500 as int)
                   as highest_market_value_in_eur
        from {customer}""",
    "transfers": """
        select cast(l_partkey as string) as player_id,
               cast(cast(l_shipdate as date) as string) as transfer_date,
               case when l_linenumber = 6 then null when l_linenumber = 7 then ' '
                    else substr(cast(year(l_shipdate) as string), 3, 2) || '/'
                         || substr(cast(year(l_shipdate) + 1 as string), 3, 2)
               end as transfer_season,
               cast(l_suppkey as string) as from_club_id,
               case when l_partkey % 53 = 0 then 'retired'
                    else cast((l_suppkey + l_linenumber) % 120 as string) end as to_club_id,
               'Club ' || cast(l_suppkey as string) as from_club_name,
               case when l_partkey % 53 = 0 then null
                    else 'Club ' || cast((l_suppkey + l_linenumber) % 120 as string)
               end as to_club_name,
               case when l_quantity = 1 then '0' when l_quantity = 2 then null
                    when l_quantity = 3 then 'loan'
                    else cast(cast(l_extendedprice as decimal(12,2)) as string)
               end as transfer_fee,
               case when l_quantity > 45 then null
                    else cast(cast(l_extendedprice as decimal(12,2)) as string)
               end as market_value_in_eur,
               case when l_partkey % 101 = 0 then null
                    else 'Player ' || cast(l_partkey as string) end as player_name
        from {lineitem}""",
}


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_table(
    spark: SparkSession, name: str, base_table: Callable[[str], DataFrame]
) -> DataFrame:
    text = RAW_SQL[name]
    used = {t: base_table(t) for t in BASE_TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def raw_oracle(name: str) -> str:
    return RAW_SQL[name].format(**{t: t for t in BASE_TABLES})
