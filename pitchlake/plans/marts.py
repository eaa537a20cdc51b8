"""Marts: the tables reports read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.functions.football import result_label
from pitchlake.functions.rules import ratio
from pitchlake.operators.aggregates import sum_if, totals_then_names
from pitchlake.operators.joins import known_id, lookup, role, star_inner
from pitchlake.operators.reshape import views
from pitchlake.operators.scale import with_totals
from pitchlake.operators.windows import partition_totals
from pitchlake.plans.warehouse import Warehouse, model

PLAYER_ATTRIBUTES = (
    "player_full_name", "position", "nationality", "current_club_name", "age", "is_active",
    "is_international", "latest_market_value_eur",
)


@model
def mart_player_performance(wh: Warehouse) -> DataFrame:
    """Appearances per player, season and club; rows without one of the three keys drop out."""
    played = star_inner(
        wh.ref("fact_appearances").select(
            known_id("sk_player", "player_id").alias("player"),
            known_id("sk_club", "player_club_id").alias("club"),
            known_id("sk_date", "appearance_date").alias("day"),
            "goals", "assists", "minutes_played", "yellow_cards", "red_cards",
        ),
        (
            role(
                wh.ref("dim_date"),
                {"date_id": "d_key", "season_label": "season",
                 "season_start_year": "season_start_year"},
            ),
            {"day": "d_key"},
        ),
    )

    def attach(totals: DataFrame) -> DataFrame:
        return star_inner(
            totals,
            (wh.ref("dim_player").select("player_id", *PLAYER_ATTRIBUTES), {"player": "player_id"}),
            (
                role(wh.ref("dim_club"), {"club_id": "c_key", "club_name": "club_at_time"}),
                {"club": "c_key"},
            ),
        )

    n, goals, minutes = F.sum("n"), F.sum("goals"), F.sum("minutes_played")
    return totals_then_names(
        played,
        ["player", "club", "season", "season_start_year"],
        {
            "n": F.count(F.lit(1)),
            **{c: F.sum(c) for c in ("goals", "assists", "minutes_played", "yellow_cards", "red_cards")},
        },
        attach,
        [*PLAYER_ATTRIBUTES, "season", "season_start_year", "club_at_time"],
        {
            "total_appearances": n,
            "total_goals": goals,
            "total_assists": F.sum("assists"),
            "total_minutes": minutes,
            "total_yellow_cards": F.sum("yellow_cards"),
            "total_red_cards": F.sum("red_cards"),
            "avg_goals_per_match": ratio(goals, n),
            "avg_assists_per_match": ratio(F.sum("assists"), n),
            "avg_minutes_per_match": ratio(minutes, n, digits=0),
            "goals_per_90_min": ratio(goals, minutes, 90),
        },
    )


def _side(hosting: str, club: str, win: str, own: str, other: str) -> dict[str, Column]:
    return {
        "game_id": F.col("game_id"),
        "club_key": F.col(f"{club}_club_key"),
        "club_id": F.col(f"{club}_club_id"),
        "competition_key": F.col("competition_key"),
        "competition_id": F.col("competition_id"),
        "date_key": F.col("date_key"),
        "hosting": F.lit(hosting),
        "is_win": F.col(win),
        "result": result_label(F.col(win), F.col("is_draw")),
        "goals_scored": F.col(own),
        "goals_conceded": F.col(other),
        "goal_difference": F.col(own) - F.col(other),
    }


def club_view(matches: DataFrame) -> DataFrame:
    """Every match once from the home side and once from the away side."""
    return views(
        matches,
        [
            _side("Home", "home", "home_win", "home_goals", "away_goals"),
            _side("Away", "away", "away_win", "away_goals", "home_goals"),
        ],
    )


@model
def mart_club_match_stats(wh: Warehouse) -> DataFrame:
    """Results per club, competition, season and side."""
    dated = lookup(
        club_view(wh.ref("fact_matches")),
        role(wh.ref("dim_date"), {"sk_date": "d_key", "season_label": "season"}),
        {"date_key": "d_key"},
    )

    def attach(totals: DataFrame) -> DataFrame:
        clubs = wh.ref("dim_club").select("club_id", "club_name")
        competitions = wh.ref("dim_competitions").select(
            "competition_id", "competition_name", "competition_type"
        )
        with_club = lookup(totals, clubs, {"club_id": "club_id"})
        return lookup(with_club, competitions, {"competition_id": "competition_id"})

    return totals_then_names(
        dated,
        ["club_id", "competition_id", "season", "hosting"],
        {
            "rows": F.count(F.lit(1)),
            "games": F.count("game_id"),
            "wins": sum_if(F.col("is_win")),
            "draws": sum_if(F.col("result") == "DRAW"),
            "losses": sum_if(F.col("result") == "LOSS"),
            "scored": F.sum("goals_scored"),
            "scored_n": F.count("goals_scored"),
            "conceded": F.sum("goals_conceded"),
            "conceded_n": F.count("goals_conceded"),
            "difference": F.sum("goal_difference"),
        },
        attach,
        ["club_name", "competition_name", "competition_type", "season", "hosting"],
        {
            "total_matches": F.sum("games"),
            "wins": F.sum("wins"),
            "draws": F.sum("draws"),
            "losses": F.sum("losses"),
            "win_rate_pct": ratio(F.sum("wins"), F.sum("rows"), 100, 1),
            "total_goals_scored": F.sum("scored"),
            "total_goals_conceded": F.sum("conceded"),
            "avg_goals_scored": ratio(F.sum("scored"), F.sum("scored_n")),
            "avg_goals_conceded": ratio(F.sum("conceded"), F.sum("conceded_n")),
            "total_goal_difference": F.sum("difference"),
        },
    )


@model
def mart_club_transfer_spending(wh: Warehouse) -> DataFrame:
    """Every transfer with the season totals of its buyer and its seller."""
    dated = lookup(
        wh.ref("fact_transfers").select(
            known_id("sk_player", "player_id").alias("player"),
            known_id("sk_to_club", "to_club_id").alias("buyer"),
            known_id("sk_from_club", "from_club_id").alias("seller"),
            known_id("sk_date", "transfer_date").alias("day"),
            "transfer_fee_eur", "player_value_at_transfer_eur", "transfer_fee_type",
            "transfer_date",
        ),
        role(wh.ref("dim_date"), {"date_id": "d_key", "season_label": "transfer_season"}),
        {"day": "d_key"},
    ).drop("day")
    moves = dated.groupBy("buyer", "seller", "transfer_season").agg(
        F.sum("transfer_fee_eur").alias("fee")
    )
    fee = F.sum("fee")
    both = with_totals(
        dated,
        [
            (["buyer", "transfer_season"], {"total_spent_that_season": fee}),
            (["seller", "transfer_season"], {"total_received_that_season": fee}),
        ],
        source=moves,
    )
    named = lookup(
        lookup(
            both,
            role(wh.ref("dim_club"), {"club_id": "b_key", "club_name": "buying_club"}),
            {"buyer": "b_key"},
        ),
        role(wh.ref("dim_club"), {"club_id": "s_key", "club_name": "selling_club"}),
        {"seller": "s_key"},
    )
    players = role(
        wh.ref("dim_player"),
        {"player_id": "p_key", "player_full_name": "player_full_name", "position": "position"},
    )
    return lookup(named, players, {"player": "p_key"}).select(
        "buying_club", "selling_club", "player_full_name", "position", "transfer_season",
        "transfer_fee_eur", "player_value_at_transfer_eur", "transfer_fee_type", "transfer_date",
        "total_spent_that_season", "total_received_that_season",
    )


EVENT_TOTALS = {
    "goals_in_match": "goals", "cards_in_match": "cards", "subs_in_match": "substitutions",
}


@model
def mart_match_events_live(wh: Warehouse) -> DataFrame:
    """Events with the totals of their club in their match."""
    events = partition_totals(
        wh.ref("fact_game_events").drop("club_name", "event_date"),
        ["game_id", "club_id"],
        {name: F.count_if(F.col("event_type") == kind) for name, kind in EVENT_TOTALS.items()},
    )
    clubs = role(wh.ref("dim_club"), {"sk_club": "c_key", "club_name": "club_name"})
    dates = role(wh.ref("dim_date"), {"sk_date": "d_key", "full_date": "event_date"})
    return lookup(lookup(events, clubs, {"sk_club": "c_key"}), dates, {"sk_date": "d_key"}).select(
        "game_id", "club_name", "event_date", "minute", "event_type", "description", "player_id",
        "source_type", *EVENT_TOTALS,
    )
