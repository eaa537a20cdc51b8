"""Staging views: warehouse names, defaults, key gates and load times. All stay lazy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.functions.calendar import season_label
from pitchlake.functions.football import fee_type, known
from pitchlake.functions.rules import coalesce_zero
from pitchlake.operators.clean import require
from pitchlake.operators.scale import first_rows
from pitchlake.operators.windows import latest_per_key
from pitchlake.plans.warehouse import Warehouse, model


@model
def stg_appearances(wh: Warehouse) -> DataFrame:
    rows = require(wh.source("appearances"), "appearance_id", "game_id", "player_id")
    measures = ("goals", "assists", "minutes_played", "yellow_cards", "red_cards")
    named = rows.withColumnRenamed("date", "appearance_date").withColumns(
        {
            **{c: coalesce_zero(F.col(c)) for c in measures},
            "scored": known(F.col("goals") > 0),
            "assisted": known(F.col("assists") > 0),
        }
    )
    return wh.loaded(named)


@model
def stg_clubs(wh: Warehouse) -> DataFrame:
    return wh.loaded(require(wh.source("clubs"), "club_id").withColumnRenamed("name", "club_name"))


@model
def stg_competitions(wh: Warehouse) -> DataFrame:
    names = {"name": "competition_name", "type": "competition_type"}
    return wh.loaded(require(wh.source("competitions"), "competition_id").withColumnsRenamed(names))


@model
def stg_game_events(wh: Warehouse) -> DataFrame:
    names = {"date": "event_date", "type": "event_type"}
    rows = require(wh.source("game_events"), "game_event_id").withColumnsRenamed(names)
    if "source_type" not in rows.columns:
        rows = rows.withColumn("source_type", F.lit("batch"))
    return wh.loaded(rows)


@model
def stg_games(wh: Warehouse) -> DataFrame:
    rows = require(wh.source("games"), "game_id").withColumnRenamed("date", "game_date")
    return wh.loaded(rows.withColumn("season_label", season_label(F.col("season"))))


def known_valuations(wh: Warehouse) -> DataFrame:
    rows = require(wh.source("player_valuations"), "market_value_in_eur")
    return wh.loaded(rows.withColumnRenamed("date", "valuation_date"))


def latest_valuations(wh: Warehouse) -> DataFrame:
    """One row per player; map tasks already drop all but their newest row."""
    return first_rows(known_valuations(wh), ["player_id"], [F.desc_nulls_last("valuation_date")])


@model
def stg_player_valuations(wh: Warehouse) -> DataFrame:
    """All valuations with their rank and a flag on the newest."""
    return latest_per_key(
        known_valuations(wh), ["player_id"], [F.desc_nulls_last("valuation_date")], "rn",
        "is_latest_valuation",
    )


@model
def stg_players(wh: Warehouse) -> DataFrame:
    names = {
        "name": "player_full_name",
        "country_of_citizenship": "nationality",
        "foot": "preferred_foot",
        "market_value_in_eur": "current_market_value_in_eur",
    }
    return wh.loaded(require(wh.source("players"), "player_id").withColumnsRenamed(names))


@model
def stg_transfers(wh: Warehouse) -> DataFrame:
    rows = require(wh.source("transfers"), "player_id").withColumnsRenamed(
        {"transfer_fee": "transfer_fee_eur", "market_value_in_eur": "player_value_at_transfer_eur"}
    )
    return wh.loaded(
        rows.withColumns(
            {
                "transfer_fee_type": fee_type(F.col("transfer_fee_eur")),
                "transfer_fee_eur": coalesce_zero(F.col("transfer_fee_eur")),
            }
        )
    )
