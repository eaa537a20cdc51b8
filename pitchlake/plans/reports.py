"""Report queries over the marts and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.functions.rules import ratio
from pitchlake.operators.aggregates import value_counts
from pitchlake.operators.joins import lookup, merge_dims
from pitchlake.operators.limits import top_k


def top_players(mart: DataFrame, measure: str, k: int = 10) -> DataFrame:
    """Players with the largest sum of ``measure`` over all seasons and clubs."""
    totals = mart.groupBy("player_full_name").agg(F.sum(measure).alias(measure))
    return top_k(totals, measure, k, ["player_full_name"])


def top_values(players: DataFrame, k: int = 10) -> DataFrame:
    """Most valuable players by latest valuation."""
    rows = players.select("player_id", "player_full_name", "latest_market_value_eur")
    return top_k(rows, "latest_market_value_eur", k, ["player_id"])


def nationalities(players: DataFrame) -> DataFrame:
    return value_counts(players, "nationality")


def player_totals(mart: DataFrame, players: DataFrame) -> DataFrame:
    """Players, goals, assists and cards of the mart, and the value of all players."""
    sums = mart.agg(
        *[F.sum(c).alias(c) for c in ("total_goals", "total_assists", "total_yellow_cards")]
    )
    people = players.agg(F.count(F.lit(1))).scalar()
    value = players.agg(F.sum("latest_market_value_eur")).scalar()
    return sums.withColumns({"players": people, "total_market_value_eur": value})


def club_rates(mart: DataFrame) -> DataFrame:
    """Win and loss rate per club over all seasons, from counts and not from rates."""
    counts = mart.groupBy("club_name").agg(
        *[F.sum(c).alias(c) for c in ("total_matches", "wins", "draws", "losses")]
    )
    n = F.col("total_matches")
    return counts.withColumns(
        {
            "win_rate_pct": ratio(F.col("wins"), n, 100, 1),
            "loss_rate_pct": ratio(F.col("losses"), n, 100, 1),
        }
    )


def squad_profile(clubs: DataFrame) -> DataFrame:
    """Size, foreigners, national-team players and seats over all clubs; ages as they come."""
    return clubs.agg(
        F.count(F.lit(1)).alias("clubs"),
        ratio(F.sum("squad_size"), F.count("squad_size")).alias("avg_squad_size"),
        F.min("average_age").alias("lowest_average_age"),
        F.max("average_age").alias("highest_average_age"),
        F.sum("foreigners_number").alias("foreigners"),
        F.sum("national_team_players").alias("national_team_players"),
        F.max("stadium_seats").alias("largest_stadium"),
    )


def top_spenders(transfers: DataFrame, clubs: DataFrame, k: int = 10) -> DataFrame:
    """Clubs by money spent; summed on the fact, because the mart repeats season totals."""
    spent = transfers.groupBy("to_club_id").agg(F.sum("transfer_fee_eur").alias("spent_eur"))
    names = clubs.select("club_id", "club_name")
    return top_k(lookup(spent, names, {"to_club_id": "club_id"}), "spent_eur", k, ["to_club_id"])


def goals_balance(mart: DataFrame) -> DataFrame:
    return mart.groupBy("club_name").agg(
        F.sum("total_goals_scored").alias("scored"), F.sum("total_goals_conceded").alias("conceded")
    )


def transfer_totals(transfers: DataFrame) -> DataFrame:
    """Number, sum and largest fee; the smallest player id settles equal fees."""
    biggest = F.max_by("player_id", F.struct("transfer_fee_eur", -F.col("player_id")))
    return transfers.agg(
        F.count(F.lit(1)).alias("transfers"),
        F.sum("transfer_fee_eur").alias("total_fee_eur"),
        F.max("transfer_fee_eur").alias("largest_fee_eur"),
        biggest.alias("player_id"),
    )


def net_spend(transfers: DataFrame) -> DataFrame:
    """Received minus spent per club."""
    spent = transfers.filter(F.col("to_club_id").isNotNull()).groupBy(
        F.col("to_club_id").alias("club_id")
    ).agg(F.sum("transfer_fee_eur").alias("spent_eur"))
    received = transfers.filter(F.col("from_club_id").isNotNull()).groupBy(
        F.col("from_club_id").alias("club_id")
    ).agg(F.sum("transfer_fee_eur").alias("received_eur"))
    both = merge_dims(spent, received, "club_id", []).fillna(0, ["spent_eur", "received_eur"])
    return both.withColumn("net_eur", F.col("received_eur") - F.col("spent_eur"))


def volume_by_season(transfers: DataFrame, dates: DataFrame) -> DataFrame:
    """Transfers and fees per season; days are summed up before the calendar join."""
    daily = transfers.groupBy("sk_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("transfer_fee_eur").alias("fee")
    )
    seasons = dates.select(F.col("sk_date").alias("d_key"), F.col("season_label").alias("season"))
    return lookup(daily, seasons, {"sk_date": "d_key"}).groupBy("season").agg(
        F.sum("n").alias("transfers"), F.sum("fee").alias("total_fee_eur")
    )


def spend_by_league(transfers: DataFrame, clubs: DataFrame, competitions: DataFrame) -> DataFrame:
    """Fees by the domestic competition of the buying club."""
    spent = transfers.groupBy("sk_to_club").agg(
        F.count(F.lit(1)).alias("n"), F.sum("transfer_fee_eur").alias("fee")
    )
    buyers = clubs.select(F.col("sk_club").alias("c_key"), F.col("domestic_competition_id").alias("league"))
    leagues = competitions.select(F.col("competition_id").alias("l_id"), "competition_name")
    named = lookup(lookup(spent, buyers, {"sk_to_club": "c_key"}), leagues, {"league": "l_id"})
    return named.groupBy("competition_name").agg(
        F.sum("n").alias("transfers"), F.sum("fee").alias("total_fee_eur")
    )
