"""Events joined with everything known about their match, player, club, line-up and competition."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.operators.clean import safe_columns
from pitchlake.operators.joins import enrich, enrich_within, keep_keys
from pitchlake.operators.limits import sample_keys

# Output names and order of the enriched event table.
ENRICHED_COLUMNS = (
    "game_event_id", "game_id", "event_date", "game_date", "minute", "event_type", "description",
    "player_in_id", "player_assist_id",
    "player_id", "player_name", "player_position", "player_sub_position", "player_foot",
    "player_nationality", "player_height_cm", "player_market_value",
    "club_id", "club_name", "coach_name", "club_total_market_value",
    "lineup_type", "lineup_position", "shirt_number", "team_captain",
    "club_goals_scored", "club_goals_conceded", "club_league_position",
    "opponent_league_position", "hosting", "is_win",
    "competition_id", "competition_name", "competition_type", "country_name", "confederation",
    "season", "round", "stadium", "attendance", "referee",
    "home_club_id", "away_club_id", "home_club_name", "away_club_name",
    "home_club_goals", "away_club_goals", "home_club_formation", "away_club_formation",
)
# The earlier layout, without club results and with other names.
ENRICHED_COLUMNS_V1 = (
    "game_event_id", "game_id", "event_date", "minute", "type", "description",
    "player_id", "player_name", "player_position", "sub_position", "player_foot",
    "player_nationality", "player_height_cm", "player_market_value",
    "club_id", "club_name", "coach_name", "club_market_value",
    "lineup_type", "lineup_position", "shirt_number", "team_captain",
    "competition_id", "competition_name", "competition_country", "confederation",
    "competition_type", "season", "round", "stadium", "attendance", "referee",
    "home_club_id", "away_club_id", "home_club_goals", "away_club_goals",
    "home_club_formation", "away_club_formation",
)
NOT_STREAMED = ("event_date", "club_total_market_value", "competition_id")

# Which raw column of each table becomes which output column.
SELECTIONS: Mapping[str, Mapping[str, str]] = {
    "game_events": {
        "game_event_id": "game_event_id", "game_id": "game_id", "minute": "minute",
        "type": "event_type", "club_id": "club_id", "player_id": "player_id",
        "description": "description", "player_in_id": "player_in_id",
        "player_assist_id": "player_assist_id", "date": "event_date",
    },
    "games": {
        **{
            c: c
            for c in (
                "game_id", "competition_id", "season", "round", "home_club_id", "away_club_id",
                "home_club_goals", "away_club_goals", "home_club_formation",
                "away_club_formation", "home_club_name", "away_club_name", "stadium",
                "attendance", "referee",
            )
        },
        "date": "game_date",
    },
    "competitions": {
        "competition_id": "competition_id", "name": "competition_name",
        "type": "competition_type", "country_name": "country_name",
        "confederation": "confederation",
    },
    "players": {
        "player_id": "player_id", "name": "player_name", "position": "player_position",
        "sub_position": "player_sub_position", "foot": "player_foot",
        "country_of_citizenship": "player_nationality", "height_in_cm": "player_height_cm",
        "market_value_in_eur": "player_market_value",
    },
    "clubs": {
        "club_id": "club_id", "name": "club_name", "coach_name": "coach_name",
        "total_market_value": "club_total_market_value",
    },
    "game_lineups": {
        "game_id": "game_id", "player_id": "player_id", "type": "lineup_type",
        "position": "lineup_position", "team_captain": "team_captain", "number": "shirt_number",
    },
    "club_games": {
        "game_id": "game_id", "club_id": "club_id", "own_goals": "club_goals_scored",
        "own_position": "club_league_position", "opponent_goals": "club_goals_conceded",
        "opponent_position": "opponent_league_position", "hosting": "hosting", "is_win": "is_win",
    },
}
# In the order of the joins: first those that don't need the match, while events have few columns.
JOIN_KEYS: Mapping[str, tuple[str, ...]] = {
    "players": ("player_id",),
    "clubs": ("club_id",),
    "game_lineups": ("game_id", "player_id"),
    "club_games": ("game_id", "club_id"),
    "games": ("game_id",),
    "competitions": ("competition_id",),
}
PER_GAME = ("game_events", "games", "game_lineups", "club_games")


IDS = {key for keys in JOIN_KEYS.values() for key in keys}


def _selected(raw: Mapping[str, DataFrame], sample: DataFrame | None) -> dict[str, DataFrame]:
    """The wanted columns of every table; ids as trimmed text, whatever type a table was read with."""
    out = {}
    for table, names in SELECTIONS.items():
        df = raw[table].select(
            *[
                (F.trim(F.col(old).cast("string")) if new in IDS else F.col(old)).alias(new)
                for old, new in names.items()
            ]
        )
        if sample is not None and table in PER_GAME:
            df = keep_keys(df, sample, "game_id")
        out[table] = df
    return out


def game_sample(raw: Mapping[str, DataFrame], n: int | None, seed: int) -> DataFrame | None:
    """``n`` match ids for a demo feed; the limit bounds the broadcast. None keeps every match."""
    if n is None:
        return None
    events = raw["game_events"].select(F.trim(F.col("game_id").cast("string")).alias("game_id"))
    return F.broadcast(sample_keys(events, "game_id", n, seed))


def enriched_events(
    raw: Mapping[str, DataFrame],
    sample_games: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """Raw events with six left joins; NULL ids match nothing. ``sample_games`` keeps that many matches."""
    t = _selected(raw, game_sample(raw, sample_games, seed))
    sides = {name: (t[name], on) for name, on in JOIN_KEYS.items()}
    known = enrich(t["game_events"], sides["players"], sides["clubs"])
    in_match = enrich_within(
        known, "game_id", sides["game_lineups"], sides["club_games"], sides["games"])
    joined = enrich(in_match, sides["competitions"])
    captain = F.coalesce(F.col("team_captain").try_cast("int"), F.lit(0))
    return safe_columns(joined.withColumn("team_captain", captain), ENRICHED_COLUMNS)


def enriched_events_v1(raw: Mapping[str, DataFrame], **options) -> DataFrame:
    """The earlier layout: no club results, and the match date where an event has none."""
    renamed = {
        "event_type": "type", "player_sub_position": "sub_position",
        "club_total_market_value": "club_market_value", "country_name": "competition_country",
    }
    joined = enriched_events(raw, **options).withColumn(
        "event_date", F.coalesce("event_date", "game_date")
    )
    return safe_columns(joined.withColumnsRenamed(renamed), ENRICHED_COLUMNS_V1)


def streamed_events(raw: Mapping[str, DataFrame], **options) -> DataFrame:
    """The 46 columns that are sent as live events."""
    return enriched_events(raw, **options).drop(*NOT_STREAMED)
