"""Stream sinks, triggers and monitoring."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from pitchlake.functions.rules import falsy_default
from pitchlake.operators.stored import KeyedTable

# How often each stage runs.
TRIGGERS = {"bronze": "30 seconds", "silver": "30 seconds", "points": "10 seconds"}

TAGS = ("game_id", "club_name", "event_type", "competition_name")
# Point fields, their source columns and the value that stands for 'missing'.
FIELDS = {
    "minute": ("minute", 0),
    "player_id": ("player_id", 0),
    "player_name": ("player_name", "Unknown"),
    "description": ("description", ""),
    "game_event_id": ("game_event_id", ""),
    "home_club_goals": ("home_club_goals", 0),
    "away_club_goals": ("away_club_goals", 0),
    "stadium": ("stadium", ""),
    "season_count": ("season_count", 0),
    "player_nationality": ("player_nationality", ""),
    "sub_position": ("player_sub_position", ""),
    "referee": ("referee", ""),
    "attendance": ("attendance", 0.0),
    "round": ("round", ""),
    "coach_name": ("coach_name", ""),
    "country_name": ("country_name", ""),
    "season": ("season", 0),
    "game_date": ("game_date", ""),
    "penalty_result": ("penalty_result", ""),
}


def with_trigger(
    writer: DataStreamWriter, checkpoint: str, every: str | None
) -> DataStreamWriter:
    """``every`` such as '30 seconds'; None processes what is there and stops."""
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def sink_parquet(
    stream: DataFrame, path: str, checkpoint: str, every: str | None = TRIGGERS["bronze"]
) -> StreamingQuery:
    """Append to a Parquet folder. A restart with the same checkpoint continues, exactly once."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    return with_trigger(writer, checkpoint, every).start()


def points(events: DataFrame, time: str = "_silver_processed_at") -> DataFrame:
    """Events as time-series points: measurement, four tags, nineteen fields, time.

    A point is identified by its event id, so a replayed event can be recognised.
    """
    kind = F.when(F.col("event_type") != "", F.col("event_type"))
    measurement = falsy_default(kind, "other")
    tags = {
        "game_id": F.col("game_id").cast("string"),
        "club_name": falsy_default(F.col("club_name"), ""),
        "event_type": measurement,
        "competition_name": falsy_default(F.col("competition_name"), ""),
    }
    values = {
        name: F.col(source) if not isinstance(default, str) else F.col(source).cast("string")
        for name, (source, default) in FIELDS.items()
    }
    blank_is_missing = F.when(F.col("player_name") != "", F.col("player_name"))
    values["player_name"] = blank_is_missing
    return events.select(
        measurement.alias("measurement"),
        *[c.alias(t) for t, c in tags.items()],
        *[falsy_default(values[n], default).alias(n) for n, (_, default) in FIELDS.items()],
        F.col(time).alias("time"),
    )


def write_points(path: str, time: str = "_silver_processed_at"):
    """``foreachBatch`` writer: a batch owns a folder in each of its days, so repeating it replaces it.

    The write stays on the executors. Days are on top, so time-range queries skip whole days;
    ``PointStore`` merges the many small folders of past days.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = points(batch, time).withColumns(
            {"point_date": F.to_date("time"), "batch_id": F.lit(batch_id).cast("long")})
        rows.hint("rebalance", "point_date").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("point_date", "batch_id").parquet(path)

    return write


def points_sink(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = TRIGGERS["points"],
    time: str = "_silver_processed_at",
) -> StreamingQuery:
    writer = stream.writeStream.outputMode("append").foreachBatch(write_points(path, time))
    return with_trigger(writer, checkpoint, every).start()


def keyed_sink(
    stream: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    every: str | None,
    mode: str = "append",
    rows: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    name: str = "stream",
) -> StreamingQuery:
    """Every batch is merged by key, under its own number, which is marked beside the data.

    A batch that is replayed after a failure goes on where it broke off, or changes nothing if it
    had been merged. ``rows`` turns a batch into rows of the table. Updates of a key that arrive in
    later batches replace it, so ``update`` output keeps one row per key.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        table.upsert(rows(batch), f"{name}-{batch_id}", few=True)
        table.forget_runs([f"{name}-{batch_id - 2}"])  # a checkpoint replays its last batch only

    return with_trigger(
        stream.writeStream.outputMode(mode).foreachBatch(write), checkpoint, every).start()


def progress(query: StreamingQuery) -> dict:
    """Activity, status, last progress and error of one query."""
    return {
        "active": query.isActive,
        "status": query.status,
        "last_progress": query.lastProgress,
        "error": query.exception(),
    }


def stop_all(spark: SparkSession) -> int:
    """Stop every active query of the session; returns how many there were."""
    active = list(spark.streams.active)
    for query in active:
        query.stop()
    return len(active)


def verify_output(spark: SparkSession, path: str) -> DataFrame:
    """Rows and columns of a written folder."""
    written = spark.read.parquet(path)
    return written.agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "columns", F.lit(len(written.columns))
    )


