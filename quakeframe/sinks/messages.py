"""Publishing messages and bulk payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from quakeframe.operators.documents import REQUEST_BYTES, REQUEST_ROWS, bulk_lines, bulk_requests


def publish_topic(messages: DataFrame, bootstrap_servers: str, topic: str) -> None:
    """Send a batch of ``key, value`` rows to a topic."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .save()
    )


def publish_topic_stream(
    messages: DataFrame, bootstrap_servers: str, topic: str, checkpoint: str
) -> StreamingQuery:
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def publish_files(messages: DataFrame, path: str, mode: str = "append") -> None:
    """The same rows as JSON files, which ``file_message_stream`` reads."""
    messages.write.mode(mode).json(path)


def write_bulk_requests(
    documents: DataFrame, path: str, max_rows: int = REQUEST_ROWS, max_bytes: int = REQUEST_BYTES
) -> None:
    """Whole requests of bounded size, one as a JSON line each; a file holds those of one task."""
    bulk_requests(documents, max_rows, max_bytes).write.mode("overwrite").json(path)


def write_bulk_payload(documents: DataFrame, path: str, batch_rows: int | None = None) -> None:
    """Bulk request bodies as text files; ``batch_rows`` documents per file at most."""
    writer = bulk_lines(documents).write.mode("overwrite")
    if batch_rows is not None:
        writer = writer.option("maxRecordsPerFile", batch_rows)
    writer.text(path)
