"""Event messages: encoding, raw ingest, parsing. All functions work on batches and streams."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.functions import casting, football, rules
from pitchlake.operators.clean import flatten, stamp, with_literals
from pitchlake.streaming.schemas import EVENT_SCHEMA, FLOAT_FIELDS, INT_FIELDS

# Minutes a live event may carry; extra time plus stoppage ends before 130.
FIRST_MINUTE, LAST_MINUTE = 0, 130


def to_event_json(
    df: DataFrame,
    int_columns: Sequence[str] = ("minute", "game_id", "club_id", "home_club_id", "away_club_id"),
    source: str = "replay",
    pipeline: str = "match_events",
    now: dt.datetime | None = None,
) -> DataFrame:
    """Rows as JSON messages in a ``value`` column, NULLs kept as null, with sender metadata."""
    typed = df.withColumns(
        {c: casting.safe_int(F.col(c).cast("string"), via_double=True)
         for c in int_columns if c in df.columns}
    )
    marked = with_literals(stamp(typed, "_ingested_at", now), _source=source, _pipeline=pipeline)
    return marked.select(
        F.to_json(F.struct(*marked.columns), {"ignoreNullFields": "false"}).alias("value")
    )


def in_match_order(df: DataFrame, game: str = "game_id", minute: str = "minute") -> DataFrame:
    """Rows of a match together and by minute, in partitions of similar size."""
    return df.repartitionByRange(game, minute).sortWithinPartitions(game, minute)


def raw_ingest(
    messages: DataFrame,
    topic: str = "real_match_events",
    pipeline: str = "match_events_bronze",
    now: dt.datetime | None = None,
) -> DataFrame:
    """Message text and three metadata columns; nothing else is changed."""
    text = messages.select(casting.value_as_string(F.col("value")).alias("raw_json"))
    return with_literals(
        stamp(text, "_bronze_ingested_at", now), _source_topic=topic, _pipeline=pipeline
    )


def parse_json(raw: DataFrame, column: str = "raw_json") -> DataFrame:
    """The 46 event fields as text; a malformed message gives NULLs."""
    kept = [c for c in raw.columns if c != column]
    parsed = raw.withColumn("_event", F.from_json(column, EVENT_SCHEMA))
    return flatten(parsed, "_event", *kept)


def valid_minute(c: Column) -> Column:
    return rules.null_unless(casting.safe_int(c, via_double=True), FIRST_MINUTE, LAST_MINUTE)


def typed_event(ids_via_double: bool = False) -> dict[str, Column]:
    """Typed and derived columns of a parsed event."""
    number = {c: casting.safe_int(F.col(c), via_double=ids_via_double) for c in INT_FIELDS}
    return {
        **number,
        **{c: casting.safe_float(F.col(c)) for c in FLOAT_FIELDS},
        "game_date": casting.safe_date(F.col("game_date")),
        "minute": valid_minute(F.col("minute")),
        "event_type": F.lower(F.trim("event_type")),
        "season_count": football.season_counter(F.col("description")),
        "penalty_result": football.penalty_result(F.col("description")),
        "description": rules.fallback(F.col("description"), F.lit("Unknown")),
        "player_name": rules.fallback(F.col("player_name"), F.lit("Unknown")),
    }


def parse_events(
    raw: DataFrame, now: dt.datetime | None = None, ids_via_double: bool = False
) -> DataFrame:
    """Parse, type, validate and gate raw messages.

    Rows without event id, match id or a valid minute are dropped, so malformed messages never
    reach later state as NULL keys. ``ids_via_double`` also accepts ids written as ``7.0``.
    """

    def valid(event: Column) -> Column:
        return (
            event["game_event_id"].isNotNull()
            & casting.safe_int(event["game_id"], ids_via_double).isNotNull()
            & valid_minute(event["minute"]).isNotNull()
        )

    # The gate sits inside the generator: a filter above it would be pushed below the parsing
    # and parse the text again for each gated field.
    parsed = F.array(F.from_json("raw_json", EVENT_SCHEMA))
    kept = [c for c in raw.columns if c != "raw_json"]
    events = raw.select(F.inline(F.filter(parsed, valid)), *kept)
    return stamp(events.withColumns(typed_event(ids_via_double)), "_silver_processed_at", now)


def event_time() -> Column:
    """Match day plus minute; events without a day fall back to their arrival."""
    kick_off = F.col("game_date").cast("timestamp")
    return F.coalesce(
        kick_off + F.make_dt_interval(mins=F.col("minute")), F.col("_bronze_ingested_at")
    )


def staged_events(events: DataFrame) -> DataFrame:
    """Parsed events under the names of the staged batch events, marked as streamed."""
    return events.select(
        "game_event_id", F.col("game_date").alias("event_date"), "game_id", "minute", "event_type",
        "club_id", "club_name", "player_id", "description", F.lit("stream").alias("source_type"),
        F.col("_silver_processed_at").alias("loaded_at"))
