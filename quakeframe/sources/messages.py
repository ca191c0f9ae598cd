"""Message streams: Kafka topics, and folders of message files with the same columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quakeframe.defaults import STREAM_BATCH_MESSAGES, STREAM_BATCH_WAIT_SECONDS

MESSAGE_DDL = "key string, value string"
ARRIVAL = "arrival"
STARTING_POINTS = ("earliest", "latest")


def message_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting: str = "latest",
    min_messages: int = STREAM_BATCH_MESSAGES,
    max_wait_seconds: int = STREAM_BATCH_WAIT_SECONDS,
    max_messages: int = 5_000_000,
) -> DataFrame:
    """A topic as a stream: a batch starts at ``min_messages``, or after the wait.

    ``max_messages`` bounds one micro-batch when the job starts far behind. ``arrival`` is the place in
    the topic; messages with one key are in one partition, so it orders those of an event.
    """
    if starting not in STARTING_POINTS:
        raise ValueError(f"starting must be one of {STARTING_POINTS}")
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("minOffsetsPerTrigger", min_messages)
        .option("maxTriggerDelay", f"{max_wait_seconds}s")
        .option("maxOffsetsPerTrigger", max_messages)
        .load()
        .select("key", "value", F.struct("partition", "offset").alias(ARRIVAL))
    )


def file_message_stream(spark: SparkSession, path: str, max_files: int = 1_000) -> DataFrame:
    """JSON message files as a stream with the columns of a topic.

    ``arrival`` orders messages by the time of their file and the part of it; ``in_arrival_order`` does so by
    their place in the part as well.
    """
    stream = spark.readStream.schema(MESSAGE_DDL).option("maxFilesPerTrigger", max_files).json(path)
    place = [F.col(f"_metadata.{name}").alias(name) for name in ("file_modification_time", "file_path", "file_block_start")]
    return stream.select("*", F.struct(*place).alias(ARRIVAL))


def in_arrival_order(batch: DataFrame) -> DataFrame:
    """A micro-batch, as it was read, whose ``arrival`` is different for each message.

    Messages of one part of a file are read one after another, and are numbered so.
    """
    if ARRIVAL not in batch.columns:
        return batch
    return batch.withColumn(ARRIVAL, F.struct(f"{ARRIVAL}.*", F.monotonically_increasing_id().alias("row")))


def decode_value(value: str | Column = "value") -> Column:
    """UTF-8 bytes to text; text passes unchanged."""
    return (F.col(value) if isinstance(value, str) else value).cast("string")
