"""Fact tables: staging rows with the surrogate keys of their dimensions."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.functions.football import match_measures
from pitchlake.functions.keys import surrogate_key
from pitchlake.operators.joins import KeyLookup, with_keys
from pitchlake.operators.state import VersionedTable
from pitchlake.operators.stored import KeyedTable
from pitchlake.plans.warehouse import Warehouse, model

# Fact tables that grow by merge, with their keys.
INCREMENTAL: Mapping[str, str] = {
    "fact_appearances": "appearance_id",
    "fact_matches": "game_id",
    "fact_game_events": "game_event_id",
}


def player(wh: Warehouse, foreign: str = "player_id") -> KeyLookup:
    return KeyLookup(wh.ref("dim_player"), "player_id", foreign, "sk_player")


def club(wh: Warehouse, foreign: str, sk: str = "sk_club") -> KeyLookup:
    return KeyLookup(wh.ref("dim_club"), "club_id", foreign, sk)


def competition(wh: Warehouse, foreign: str = "competition_id", sk: str = "sk_competition"):
    return KeyLookup(wh.ref("dim_competitions"), "competition_id", foreign, sk)


def date(wh: Warehouse, foreign: str, sk: str = "sk_date") -> KeyLookup:
    return KeyLookup(wh.ref("dim_date"), "date_id", foreign, sk)


@model
def fact_appearances(wh: Warehouse) -> DataFrame:
    """Grain: one player in one match."""
    return with_keys(
        wh.ref("stg_appearances").drop("player_name"),
        [player(wh), club(wh, "player_club_id"), competition(wh), date(wh, "appearance_date")],
    )


@model
def fact_game_events(wh: Warehouse) -> DataFrame:
    """Grain: one match event."""
    return event_keys(wh, wh.ref("stg_game_events"))


def event_keys(wh: Warehouse, events: DataFrame) -> DataFrame:
    """Staged events, of batches or streams, with the keys of their dimensions."""
    return with_keys(events, [club(wh, "club_id"), date(wh, "event_date")])


@model
def fact_matches(wh: Warehouse) -> DataFrame:
    """Grain: one match; the club dimension plays both the home and the away role."""
    keyed = with_keys(
        wh.ref("stg_games"),
        [
            club(wh, "home_club_id", "home_club_key"),
            club(wh, "away_club_id", "away_club_key"),
            competition(wh, sk="competition_key"),
            date(wh, "game_date", "date_key"),
        ],
    ).withColumnsRenamed({"home_club_goals": "home_goals", "away_club_goals": "away_goals"})
    return keyed.withColumns(match_measures(F.col("home_goals"), F.col("away_goals")))


@model
def fact_player_valuations(wh: Warehouse) -> DataFrame:
    """Grain: one valuation of one player; rebuilt in full."""
    return with_keys(
        wh.ref("stg_player_valuations").drop("rn"),
        [player(wh), club(wh, "current_club_id"), date(wh, "valuation_date")],
    ).withColumnRenamed("market_value_in_eur", "market_value_eur")


@model
def fact_transfers(wh: Warehouse) -> DataFrame:
    """Grain: one transfer."""
    keyed = with_keys(
        wh.ref("stg_transfers"),
        [
            player(wh),
            club(wh, "from_club_id", "sk_from_club"),
            club(wh, "to_club_id", "sk_to_club"),
            date(wh, "transfer_date"),
        ],
    )
    key = surrogate_key("player_id", "from_club_id", "to_club_id", "transfer_date")
    return keyed.select(key.alias("transfer_key"), "*")


def build_fact(wh: Warehouse, name: str, path: str, run: str | None = None) -> DataFrame:
    """Build or extend a stored fact table: whole on the first run, by merge afterwards.

    A merge writes only rows that are new or differ from the stored ones, found by fingerprints, so
    ``loaded_at`` tells when a row was first seen as it is. ``run`` names the run; repeating a name
    goes on with a broken run and leaves a completed one as it is.
    """
    if name in INCREMENTAL:
        table = KeyedTable(wh.spark, path, [INCREMENTAL[name]])
        return table.upsert(wh.ref(name), run or uuid.uuid4().hex)
    return VersionedTable(wh.spark, path).write(wh.ref(name))
