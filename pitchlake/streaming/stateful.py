"""De-duplication, windows and running totals on streams."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def dedup_stream(stream: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """One row per key among events within ``delay`` of each other; state is bounded by it."""
    return (
        stream.filter(F.col(key).isNotNull())
        .withWatermark(ts, delay)
        .dropDuplicatesWithinWatermark([key])
    )


def window_counts(
    events: DataFrame, ts: str, size: str, delay: str | None, by: Sequence[str] = ()
) -> DataFrame:
    """Tumbling-window counts. With ``delay`` late rows are dropped and old state is released."""
    if delay is not None:
        events = events.withWatermark(ts, delay)
    return (
        events.groupBy(F.window(ts, size).alias("w"), *by)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "n")
    )


def running_totals(
    events: DataFrame, keys: Sequence[str], conditions: Mapping[str, Column]
) -> DataFrame:
    """Totals so far per key, for ``update`` or ``complete`` output."""
    return events.groupBy(*keys).agg(*[F.count_if(p).alias(n) for n, p in conditions.items()])


def match_totals(
    events: DataFrame, ts: str, keys: Sequence[str], conditions: Mapping[str, Column], delay: str,
    size: str = "1 day", counted: Column | None = None,
) -> DataFrame:
    """Running totals per key and match day, whose state ends with the day.

    For ``update`` output into a keyed sink: each batch brings the totals that changed. A day's
    state is dropped once the watermark, ``delay`` behind the newest event, has passed its end, so
    the state holds the matches in play and not all that ever were. Events that are not ``counted``
    still move the watermark. Session windows would close a match sooner, but allow no updates.
    """
    timed = events.withWatermark(ts, delay)
    if counted is not None:
        # A condition that doesn't touch the event time would be moved below the watermark, and
        # events that it drops would no longer move it.
        timed = timed.where(counted | (F.col(ts) < F.lit("0001-01-01").cast("timestamp")))
    return (
        timed.groupBy(F.window(ts, size).alias("day"), *keys)
        .agg(*[F.count_if(p).alias(n) for n, p in conditions.items()])
        .select(F.col("day.start").alias("day"), *keys, *conditions)
    )


def recent_counts(
    points: DataFrame, ts: str, by: Sequence[str], keep: str, size: str = "1 minute"
) -> DataFrame:
    """Counts per ``by`` and minute, of which the state holds those of the last ``keep``.

    For ``update`` output. Live totals are read from the state itself (``state_counts``), so no
    reader has to scan the points again.
    """
    return (
        points.withWatermark(ts, keep)
        .groupBy(F.window(ts, size).alias("minute"), *by).agg(F.count(F.lit(1)).alias("n")))


def state_counts(spark: SparkSession, checkpoint: str, by: Sequence[str]) -> DataFrame:
    """(start, end, by, n): what the state of ``recent_counts`` holds after its last batch."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(
        F.col("key.window.start").alias("start"), F.col("key.window.end").alias("end"),
        *[F.col(f"key.{c}").alias(c) for c in by], F.col("value.count").alias("n"))
