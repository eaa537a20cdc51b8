"""The twelve cleaned tables.

Fixed values: column names, their order in the raw files, keys, default texts and limits.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.functions import rules
from pitchlake.functions.calendar import age
from pitchlake.functions.casting import parse_money
from pitchlake.functions.football import result_flags
from pitchlake.operators.clean import Col, TableSpec
from pitchlake.operators.joins import with_global


def text(*names: str, **options) -> tuple[Col, ...]:
    return tuple(Col(n, **options) for n in names)


def ints(*names: str, **options) -> tuple[Col, ...]:
    return tuple(Col(n, "int", **options) for n in names)


def unused(*names: str) -> tuple[Col, ...]:
    return tuple(Col(n, drop=True) for n in names)


APPEARANCES = TableSpec(
    "appearances",
    (
        *text("appearance_id"),
        *ints("game_id", "player_id", "player_club_id", "player_current_club_id"),
        Col("date", "date"),
        Col("player_name", fill="Unknown"),
        *text("competition_id"),
        *ints("yellow_cards", "red_cards", "goals", "assists", "minutes_played"),
    ),
    key=("appearance_id",),
    keep=(lambda: rules.between("minutes_played", 1, 135),),
)

_CLUB_GAME_FLAGS = {
    name: (lambda name=name: result_flags(F.col("own_goals"), F.col("opponent_goals"))[name])
    for name in ("is_draw", "is_loss", "is_win")
}

CLUB_GAMES = TableSpec(
    "club_games",
    (
        *ints("game_id", "club_id", "own_goals"),
        *unused("own_position"),
        Col("own_manager_name", fill="Unknown"),
        *ints("opponent_id", "opponent_goals"),
        *unused("opponent_position"),
        Col("opponent_manager_name", fill="Unknown"),
        *text("hosting"),
        *ints("is_win"),
    ),
    key=("game_id", "club_id"),
    derive=_CLUB_GAME_FLAGS,
)

CLUBS = TableSpec(
    "clubs",
    (
        *ints("club_id"),
        *unused("club_code"),
        *text("name", "domestic_competition_id"),
        *unused("total_market_value"),
        *ints("squad_size", low=1),
        Col("average_age", "double"),
        *ints("foreigners_number"),
        Col("foreigners_percentage", "double"),
        *ints("national_team_players"),
        *text("stadium_name"),
        *ints("stadium_seats", low=1),
        *unused("net_transfer_record", "coach_name"),
        *ints("last_season"),
        *unused("filename", "url"),
    ),
    key=("club_id",),
    derive={"net_transfer_record_eur": lambda: parse_money(F.col("_raw_net_transfer_record"))},
)

COMPETITIONS = TableSpec(
    "competitions",
    (
        *text("competition_id"),
        *unused("competition_code"),
        *text("name", "sub_type", "type"),
        *ints("country_id", sentinel="-1"),
        Col("country_name", fill="International"),
        Col("domestic_league_code", fill="N/A"),
        *text("confederation"),
        *ints("total_clubs"),
        *unused("url"),
    ),
    key=("competition_id",),
)

COUNTRIES = TableSpec(
    "countries",
    (
        *ints("country_id"),
        *text("country_name", "country_code", "confederation"),
        *ints("total_clubs", "total_players"),
        Col("average_age", "double"),
        *unused("url"),
    ),
    key=("country_id",),
)

GAME_EVENTS = TableSpec(
    "game_events",
    (
        *text("game_event_id"),
        Col("date", "date"),
        *ints("game_id", "minute"),
        Col("type", lower=True),
        *ints("club_id"),
        *text("club_name"),
        *ints("player_id"),
        Col("description", fill="Unknown"),
        *unused("player_in_id", "player_assist_id"),
    ),
    key=("game_event_id",),
)

GAME_LINEUPS = TableSpec(
    "game_lineups",
    (
        *text("game_lineups_id"),
        Col("date", "date"),
        *ints("game_id", "player_id", "club_id"),
        *text("player_name", "type"),
        Col(
            "position",
            remap={"midfield": "Central Midfield", "attack": "Forward"},
            remap_ignore_case=True,
        ),
        *ints("number", "team_captain"),
    ),
    key=("game_lineups_id",),
    keep=(
        lambda: rules.between("number", 1, 99, keep_null=True),
        lambda: rules.nonblank("position"),
    ),
)

GAMES = TableSpec(
    "games",
    (
        *ints("game_id"),
        *text("competition_id"),
        *ints("season"),
        *text("round"),
        Col("date", "date"),
        *ints("home_club_id", "away_club_id", "home_club_goals", "away_club_goals"),
        *ints("home_club_position", "away_club_position"),
        *text("home_club_manager_name", "away_club_manager_name", fill="Unknown"),
        *unused("stadium", "attendance", "referee", "url"),
        *text("home_club_formation", "away_club_formation", fill="Unknown"),
        *text("home_club_name", "away_club_name", fill="Unknown"),
        *text("aggregate", "competition_type"),
    ),
    key=("game_id",),
)

NATIONAL_TEAMS = TableSpec(
    "national_teams",
    (
        *ints("national_team_id"),
        *text("name"),
        *unused("team_code"),
        *ints("country_id"),
        *text("country_name", "country_code"),
        Col("confederation", fill="Unknown"),
        *unused("team_image_url"),
        *ints("squad_size"),
        Col("average_age", "double"),
        *ints("foreigners_number"),
        Col("foreigners_percentage", "double"),
        Col("total_market_value", "long"),
        *unused("coach_name"),
        *ints("fifa_ranking"),
        *unused("last_season", "url"),
    ),
    key=("national_team_id",),
)

PLAYER_VALUATIONS = TableSpec(
    "player_valuations",
    (
        *ints("player_id"),
        Col("date", "date"),
        Col("market_value_in_eur", "long", low=1),
        *text("current_club_name"),
        *ints("current_club_id"),
        Col("player_club_domestic_competition_id", fill="Unknown"),
    ),
    key=("player_id", "date"),
)


def finish_players(players: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Age, caps flag, and whether a player's last season is the newest one in the table."""
    return (
        with_global(players, _newest=F.max("last_season"))
        .withColumns(
            {
                "age": age(F.col("date_of_birth"), as_of),
                "is_international": F.col("international_caps") > 0,
                "is_active": F.col("last_season") == F.col("_newest"),
            }
        )
        .drop("_newest")
    )


PLAYERS = TableSpec(
    "players",
    (
        Col("player_id", raw="int"),
        *text("first_name", "last_name", "name"),
        Col("last_season", raw="int"),
        Col("current_club_id", raw="int"),
        *unused("player_code"),
        Col("country_of_birth", fill="Unknown"),
        *unused("city_of_birth"),
        Col("country_of_citizenship", fill="Unknown"),
        Col("date_of_birth", "day", raw="timestamp"),
        Col("sub_position", fill="Unknown"),
        Col("position", remap={"Missing": "Unknown"}),
        Col("foot", fill="Unknown"),
        Col("height_in_cm", raw="int", low=140, high=220),
        Col("contract_expiration_date", "day", raw="timestamp"),
        *unused("agent_name", "image_url"),
        Col("international_caps", raw="int", fill=0),
        Col("international_goals", raw="int", fill=0),
        Col("current_national_team_id", raw="int", drop=True),
        *unused("url"),
        Col("current_club_domestic_competition_id", fill="Unknown"),
        Col("current_club_name", fill="Unknown Club"),
        Col("market_value_in_eur", raw="int"),
        Col("highest_market_value_in_eur", raw="int"),
    ),
    key=("player_id",),
    finish=finish_players,
)

TRANSFERS = TableSpec(
    "transfers",
    (
        *ints("player_id"),
        Col("transfer_date", "date"),
        Col("transfer_season", blank="Unknown"),
        *ints("from_club_id", "to_club_id"),
        *text("from_club_name", "to_club_name", fill="Unknown Club"),
        Col("transfer_fee", "long_via_double", fill=0),
        Col("market_value_in_eur", "long_via_double"),
        Col("player_name", fill="Unknown Player"),
    ),
    key=("player_id", "transfer_date", "from_club_id", "to_club_id"),
    rarely_repeated=True,
)

SPECS: dict[str, TableSpec] = {
    s.name: s
    for s in (
        APPEARANCES, CLUB_GAMES, CLUBS, COMPETITIONS, COUNTRIES, GAME_EVENTS, GAME_LINEUPS,
        GAMES, NATIONAL_TEAMS, PLAYER_VALUATIONS, PLAYERS, TRANSFERS,
    )
}
