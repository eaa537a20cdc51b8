"""The data tests of every model, by severity."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from pitchlake.operators.quality import (
    Check, accepted_range, accepted_values, not_null, relationship, run_checks, unique, with_status,
)
from pitchlake.plans.warehouse import Warehouse


def key(column: str) -> tuple[Check, ...]:
    return unique(column), not_null(column)


def reference(column: str, parent: str, parent_column: str, severity: str) -> tuple[Check, ...]:
    """A foreign key: known (at this severity) and present in its dimension."""
    return not_null(column, severity), relationship(column, parent, parent_column)


def warn_null(*columns: str) -> tuple[Check, ...]:
    return tuple(not_null(c, "warn") for c in columns)


TESTS: Mapping[str, tuple[Check, ...]] = {
    "stg_players": key("player_id"),
    "stg_clubs": key("club_id"),
    "stg_competitions": key("competition_id"),
    "stg_games": (*key("game_id"), *warn_null("home_club_id", "away_club_id")),
    "stg_appearances": (*key("appearance_id"), *warn_null("player_id", "game_id")),
    "stg_game_events": key("game_event_id"),
    "stg_player_valuations": (
        *warn_null("player_id", "valuation_date", "market_value_in_eur"),
        accepted_range("market_value_in_eur", 0),
    ),
    "stg_transfers": warn_null("player_id"),
    "dim_player": (*key("sk_player"), *warn_null("player_id")),
    "dim_club": (not_null("sk_club"), *warn_null("club_id")),
    "dim_competitions": key("sk_competition"),
    "dim_date": (*key("sk_date"), *warn_null("date_id", "year", "month")),
    "fact_appearances": (
        *key("appearance_id"),
        *reference("sk_player", "dim_player", "sk_player", "warn"),
        *reference("sk_club", "dim_club", "sk_club", "warn"),
        *reference("sk_competition", "dim_competitions", "sk_competition", "error"),
        *reference("sk_date", "dim_date", "sk_date", "error"),
        not_null("goals"),
        accepted_range("goals", 0),
    ),
    "fact_matches": (
        *key("game_id"),
        *reference("home_club_key", "dim_club", "sk_club", "warn"),
        *reference("away_club_key", "dim_club", "sk_club", "warn"),
        *reference("competition_key", "dim_competitions", "sk_competition", "error"),
        *reference("date_key", "dim_date", "sk_date", "error"),
    ),
    "fact_transfers": (
        *reference("sk_player", "dim_player", "sk_player", "error"),
        *reference("sk_from_club", "dim_club", "sk_club", "warn"),
        *reference("sk_to_club", "dim_club", "sk_club", "warn"),
        *reference("sk_date", "dim_date", "sk_date", "warn"),
    ),
    "fact_player_valuations": (
        *reference("sk_player", "dim_player", "sk_player", "error"),
        *reference("sk_club", "dim_club", "sk_club", "warn"),
        *reference("sk_date", "dim_date", "sk_date", "error"),
    ),
    "fact_game_events": (
        *key("game_event_id"),
        *reference("sk_club", "dim_club", "sk_club", "warn"),
        *reference("sk_date", "dim_date", "sk_date", "warn"),
    ),
    "mart_player_performance": (
        *warn_null("player_full_name", "total_goals", "total_appearances"),
        accepted_range("total_goals", 0),
        accepted_range("total_appearances", 0),
    ),
    "mart_club_transfer_spending": (
        *warn_null("buying_club"),
        accepted_range("total_spent_that_season", 0),
        accepted_range("total_received_that_season", 0),
    ),
    "mart_club_match_stats": (
        *warn_null("club_name", "total_matches"),
        accepted_range("win_rate_pct", 0, 100),
        accepted_range("total_matches", 0),
    ),
}

# Stricter tests that are off by default.
OPTIONAL_TESTS: Mapping[str, tuple[Check, ...]] = {
    "fact_appearances": (accepted_range("minutes_played", 1, 135),),
    "fact_matches": (
        not_null("home_goals"), accepted_range("home_goals", 0, 30),
        not_null("away_goals"), accepted_range("away_goals", 0, 30),
    ),
    "fact_transfers": (not_null("transfer_fee_eur"), accepted_range("transfer_fee_eur", 0)),
    "fact_player_valuations": (
        not_null("market_value_eur"), accepted_range("market_value_eur", 0),
        accepted_values("is_latest_valuation", [True, False]),
    ),
    "fact_game_events": (
        accepted_values("event_type", ["goals", "cards", "substitutions", "shootout"]),
        not_null("source_type"), accepted_values("source_type", ["batch", "stream"]),
    ),
    "dim_player": (
        not_null("player_full_name"),
        accepted_values("position", ["Attack", "Midfield", "Defender", "Goalkeeper"]),
        accepted_values("is_active", [True, False]),
    ),
    "dim_club": (not_null("club_name"),),
    "dim_competitions": (*key("competition_id"), not_null("competition_name")),
    "mart_match_events_live": (
        not_null("event_type"),
        accepted_values("event_type", ["goals", "cards", "substitutions", "shootout"]),
        accepted_values("source_type", ["batch", "stream"]),
    ),
    "stg_game_events": (accepted_values("source_type", ["batch", "stream"]),),
}


def report(
    wh: Warehouse,
    models: Sequence[str] | None = None,
    tests: Mapping[str, Sequence[Check]] = TESTS,
) -> DataFrame:
    """(model, test, severity, violations, status) of the given models, or of all."""
    parts = []
    for name in models or list(tests):
        parents = {c.parent: wh.ref(c.parent) for c in tests[name] if c.parent}
        parts.append(run_checks(name, wh.ref(name), tests[name], parents))
    return with_status(functools.reduce(DataFrame.unionByName, parts))
