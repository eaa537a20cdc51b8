"""Dimensions with surrogate keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.functions.calendar import date_parts, season_of, season_start
from pitchlake.functions.keys import surrogate_key
from pitchlake.operators.joins import distinct_union, extend_dimension, lookup
from pitchlake.operators.scale import first_rows
from pitchlake.plans.staging import latest_valuations
from pitchlake.plans.warehouse import Warehouse, model


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day from ``start`` up to, not including, ``end``."""
    days = max((end - start).days, 0)
    return spark.range(days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("full_date"))


@model
def dim_date(wh: Warehouse) -> DataFrame:
    start, end = wh.calendar
    day = F.col("full_date")
    return date_spine(wh.spark, start, end).select(
        surrogate_key("full_date").alias("sk_date"),
        day.alias("date_id"),
        day,
        *[c.alias(name) for name, c in date_parts(day).items()],
        season_of(day).alias("season_label"),
        season_start(day).alias("season_start_year"),
    )


@model
def dim_club(wh: Warehouse) -> DataFrame:
    clubs = wh.ref("stg_clubs").drop("loaded_at")
    return wh.loaded(clubs.select(surrogate_key("club_id").alias("sk_club"), "*"), "updated_at")


@model
def dim_club_extended(wh: Warehouse) -> DataFrame:
    """Clubs of the club table and clubs that only occur in transfers."""
    moves = wh.ref("stg_transfers")
    seen = distinct_union(
        moves.select(F.col("from_club_id").alias("club_id"), F.col("from_club_name").alias("club_name")),
        moves.select(F.col("to_club_id").alias("club_id"), F.col("to_club_name").alias("club_name")),
    ).filter(F.col("club_id").isNotNull())
    # One name per club, so that the full join cannot multiply rows.
    seen = first_rows(seen, ["club_id"], ["club_name"])
    clubs = wh.ref("stg_clubs").drop("loaded_at")
    merged = extend_dimension(clubs, seen, "club_id", ["club_name"], ["club_name"])
    return wh.loaded(merged.select(surrogate_key("club_id").alias("sk_club"), "*"), "updated_at")


@model
def dim_competitions(wh: Warehouse) -> DataFrame:
    rows = wh.ref("stg_competitions").drop("loaded_at")
    return wh.loaded(
        rows.select(surrogate_key("competition_id").alias("sk_competition"), "*"), "updated_at"
    )


@model
def dim_player(wh: Warehouse) -> DataFrame:
    """Players with their latest valuation."""
    # The rows of stg_player_valuations with is_latest_valuation, without ranking all the others.
    latest = latest_valuations(wh).select(
        "player_id",
        F.col("market_value_in_eur").alias("latest_market_value_eur"),
        F.col("valuation_date").alias("latest_valuation_date"),
    )
    players = wh.ref("stg_players").drop("loaded_at")
    rows = lookup(players, latest, {"player_id": "player_id"}).select(
        surrogate_key(players["player_id"]).alias("sk_player"),
        "player_id", "player_full_name", "first_name", "last_name", "position", "sub_position",
        "preferred_foot", "nationality", "country_of_birth", "date_of_birth", "age",
        "height_in_cm", "current_club_id", "current_club_name",
        "current_club_domestic_competition_id", "last_season", "international_caps",
        "international_goals", "contract_expiration_date", "current_market_value_in_eur",
        "highest_market_value_in_eur", "latest_market_value_eur", "latest_valuation_date",
        "is_international", "is_active",
    )
    return wh.loaded(rows, "updated_at")
