"""Message topics and streamed folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def topic_options(servers: str, topic: str, **extra) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        **{k: str(v) for k, v in extra.items()},
    }


def snapshot_options(servers: str, topic: str) -> dict[str, str]:
    """Everything the topic holds now."""
    return topic_options(servers, topic, startingOffsets="earliest", endingOffsets="latest")


def live_options(servers: str, topic: str, max_per_trigger: int | None = None) -> dict[str, str]:
    """New messages only; expired offsets do not stop the query. A rate limit is opt-in."""
    limit = {} if max_per_trigger is None else {"maxOffsetsPerTrigger": max_per_trigger}
    return topic_options(servers, topic, startingOffsets="latest", failOnDataLoss="false", **limit)


def read_topic(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Bounded topic read. Needs the Kafka connector on the class path."""
    options = snapshot_options(servers, topic)
    return (
        spark.read.format("kafka").options(**options).load()
        .selectExpr("CAST(value AS STRING) AS value", "timestamp")
    )


def stream_topic(spark: SparkSession, servers: str, topic: str, max_per_trigger: int | None = None):
    options = live_options(servers, topic, max_per_trigger)
    return spark.readStream.format("kafka").options(**options).load()


def send_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """Write a ``value`` column to a topic. Needs the Kafka connector on the class path."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    messages.select("value").write.format("kafka").options(**options).save()


def stream_text(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A folder of line-separated messages as a stream with a ``value`` column."""
    reader = spark.readStream.format("text")
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).load(path)


def stream_parquet(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """Follow a Parquet folder; streams need the schema up front."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(path)
