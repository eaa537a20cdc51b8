"""Schemas of the live path; streams never infer them."""

from __future__ import annotations

from pyspark.sql import types as T

# The fields of a live event, in message order. Numbers travel as text, because an
# empty text would make a numeric field fail; ``minute`` is read as text as well, since a sender
# may write 45 or 45.0.
EVENT_FIELDS = (
    "game_event_id", "game_id", "game_date", "minute", "event_type", "description",
    "player_in_id", "player_assist_id", "player_id", "player_name", "player_position",
    "player_sub_position", "player_foot", "player_nationality", "player_height_cm",
    "player_market_value", "club_id", "club_name", "coach_name", "lineup_type",
    "lineup_position", "shirt_number", "team_captain", "club_goals_scored",
    "club_goals_conceded", "club_league_position", "opponent_league_position", "hosting",
    "is_win", "competition_name", "competition_type", "country_name", "confederation", "season",
    "round", "stadium", "attendance", "referee", "home_club_id", "away_club_id",
    "home_club_name", "away_club_name", "home_club_goals", "away_club_goals",
    "home_club_formation", "away_club_formation",
)
EVENT_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in EVENT_FIELDS])

INT_FIELDS = (
    "game_id", "club_id", "player_id", "home_club_goals", "away_club_goals", "team_captain",
    "season", "club_goals_scored", "club_goals_conceded", "is_win", "shirt_number",
)
FLOAT_FIELDS = (
    "player_height_cm", "player_market_value", "attendance", "club_league_position",
    "opponent_league_position",
)
DERIVED = {"season_count": T.IntegerType(), "penalty_result": T.StringType()}

BRONZE_FIELDS = {
    "raw_json": T.StringType(),
    "_bronze_ingested_at": T.TimestampType(),
    "_source_topic": T.StringType(),
    "_pipeline": T.StringType(),
}
BRONZE_SCHEMA = T.StructType([T.StructField(n, t) for n, t in BRONZE_FIELDS.items()])


def _silver_type(name: str) -> T.DataType:
    if name in INT_FIELDS or name == "minute":
        return T.IntegerType()
    if name in FLOAT_FIELDS:
        return T.FloatType()
    return T.DateType() if name == "game_date" else T.StringType()


SILVER_SCHEMA = T.StructType(
    [T.StructField(f, _silver_type(f)) for f in EVENT_FIELDS]
    + [T.StructField(n, t) for n, t in DERIVED.items()]
    + [T.StructField(n, t) for n, t in BRONZE_FIELDS.items() if n != "raw_json"]
    + [T.StructField("_silver_processed_at", T.TimestampType())]
)
