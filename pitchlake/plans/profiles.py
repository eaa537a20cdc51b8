"""What to profile in each raw table."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitchlake.functions.football import slug
from pitchlake.operators.profile import ProfileSpec


def number(name: str, type_name: str = "int"):
    return F.trim(name).try_cast(type_name)


def all_of(names: str, type_name: str = "int") -> dict[str, str]:
    return dict.fromkeys(names.split(), type_name)


# Formats and limits that flag a value for inspection.
MONEY_ALPHABET = r"^[+\-€0-9.,mbn\s]+$"
EVENT_ID = r"^[a-f0-9]{32}$"
APPEARANCE_ID = r"^\d+_\d+$"
SCORE = r"^\d+:\d+$"
DIGITS = r"^[0-9.]+$"

PROFILES: dict[str, ProfileSpec] = {
    p.table: p
    for p in (
        ProfileSpec(
            "appearances", ("appearance_id",),
            casts=all_of(
                "game_id player_id player_club_id player_current_club_id yellow_cards red_cards "
                "goals assists minutes_played"
            ),
            numeric=all_of("yellow_cards red_cards goals assists minutes_played"),
            dates=("date",),
            patterns={"appearance_id": APPEARANCE_ID},
            rules={
                "yellow_cards_above_2": lambda: number("yellow_cards") > 2,
                "red_cards_above_1": lambda: number("red_cards") > 1,
                "negative_goals_or_assists": lambda: (number("goals") < 0) | (number("assists") < 0),
                "minutes_outside_1_120": lambda: ~number("minutes_played").between(1, 120),
            },
            categories=("competition_id", "goals", "assists"),
        ),
        ProfileSpec(
            "club_games", ("game_id", "club_id"),
            numeric=all_of("own_goals opponent_goals own_position opponent_position is_win"),
            rules={
                "negative_goals": lambda: (number("own_goals") < 0) | (number("opponent_goals") < 0)
            },
            categories=("is_win", "hosting"),
        ),
        ProfileSpec(
            "clubs", ("club_id",),
            numeric={
                **all_of("squad_size foreigners_number national_team_players stadium_seats last_season"),
                **all_of("average_age foreigners_percentage", "double"),
            },
            patterns={"total_market_value": MONEY_ALPHABET, "net_transfer_record": MONEY_ALPHABET},
            categories=("domestic_competition_id", "last_season"),
        ),
        ProfileSpec(
            "competitions", ("competition_id",),
            casts=all_of("country_id total_clubs"),
            numeric=all_of("total_clubs"),
            rules={
                "country_sentinel": lambda: F.col("country_id") == "-1",
                "league_code_mismatch": lambda: (F.col("type") == "domestic_league")
                & (F.col("domestic_league_code") != F.col("competition_id")),
            },
            categories=("type", "sub_type", "confederation", "country_id"),
        ),
        ProfileSpec(
            "countries", ("country_id",),
            casts={**all_of("country_id total_clubs total_players"), **all_of("average_age", "double")},
            numeric={**all_of("country_id total_clubs total_players"), **all_of("average_age", "double")},
        ),
        ProfileSpec(
            "game_events", ("game_event_id",),
            casts=all_of("game_id club_id player_id player_in_id player_assist_id minute"),
            dates=("date",),
            patterns={"game_event_id": EVENT_ID},
            rules={
                "minute_below_1": lambda: number("minute") < 1,
                "minute_above_120": lambda: number("minute") > 120,
            },
            categories=("type",),
            numeric=all_of("minute"),
            lengths=("description",),
        ),
        ProfileSpec(
            "game_lineups", ("game_lineups_id",),
            casts=all_of("game_id player_id club_id number team_captain"),
            numeric=all_of("number team_captain"),
            dates=("date",),
            rules={"captain_not_0_or_1": lambda: ~number("team_captain").isin(0, 1)},
            categories=("type", "position"),
        ),
        ProfileSpec(
            "games", ("game_id",),
            casts=all_of(
                "game_id season home_club_id away_club_id home_club_goals away_club_goals "
                "home_club_position away_club_position attendance"
            ),
            numeric=all_of(
                "season home_club_goals away_club_goals home_club_position away_club_position "
                "attendance"
            ),
            dates=("date",),
            patterns={"aggregate": SCORE},
            rules={
                "goals_above_20": lambda: (number("home_club_goals") > 20)
                | (number("away_club_goals") > 20),
                "negative_goals": lambda: (number("home_club_goals") < 0)
                | (number("away_club_goals") < 0),
            },
            categories=("competition_type", "round", "home_club_formation", "season"),
        ),
        ProfileSpec(
            "national_teams", ("national_team_id",),
            numeric={
                **all_of("squad_size foreigners_number fifa_ranking last_season"),
                **all_of("average_age foreigners_percentage", "double"),
                **all_of("total_market_value", "bigint"),
            },
            rules={
                "market_value_not_positive": lambda: number("total_market_value", "bigint") <= 0,
                "team_code_is_not_slug": lambda: F.col("team_code") != slug(F.col("name")),
            },
            categories=("confederation", "last_season"),
        ),
        ProfileSpec(
            "player_valuations", ("player_id", "date"),
            casts=all_of("player_id market_value_in_eur current_club_id", "bigint"),
            numeric=all_of("market_value_in_eur", "bigint"),
            dates=("date",),
            rules={
                "market_value_not_positive": lambda: number("market_value_in_eur", "bigint") <= 0,
                "unknown_club": lambda: F.col("current_club_name") == "Unknown",
            },
            categories=("current_club_name", "player_club_domestic_competition_id"),
        ),
        ProfileSpec(
            "players", ("player_id",),
            numeric=all_of(
                "last_season height_in_cm international_caps international_goals "
                "market_value_in_eur highest_market_value_in_eur"
            ),
            categories=("foot", "position"),
        ),
        ProfileSpec(
            "transfers", ("player_id", "transfer_date", "from_club_id", "to_club_id"),
            numeric=all_of("transfer_fee market_value_in_eur", "double"),
            dates=("transfer_date",),
            patterns={"market_value_in_eur": DIGITS},
        ),
    )
}
