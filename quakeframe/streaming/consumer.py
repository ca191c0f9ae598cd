"""Messages to facts and snapshot, one micro-batch at a time."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from quakeframe.operators.flatten import flatten_lenient
from quakeframe.sinks.snapshot import compact, upsert_latest
from quakeframe.sinks.runs import append_run, compact_runs
from quakeframe.sources.messages import ARRIVAL, decode_value, in_arrival_order


@dataclass(frozen=True)
class BatchReport:
    batch_id: int
    consumed_count: int
    written_count: int
    affected_count: int | None


def batch_writer(
    facts_path: str,
    latest_path: str,
    name: str = "stream",
    generation: int = 0,
    compact_every: int = 0,
    on_batch: Callable[[BatchReport], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: flatten, append the facts, merge the snapshot.

    Of rows of an event that tie in all times the first to arrive stays, if the messages tell when they
    did. Both writes are keyed by the batch id. A batch that failed half-way is repeated from
    the same offsets and replaces what it had written. Every ``compact_every`` batches the
    runs of facts are folded and the snapshot is compacted. Raise ``generation`` when the
    stream starts over with a new checkpoint, so that its batches follow the stored ones.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        number = generation * 10**9 + batch_id
        consumed = Observation()
        arrival = [ARRIVAL] if ARRIVAL in batch.columns else []
        payloads = in_arrival_order(batch).select(decode_value("value").alias("payload_json"), *arrival).observe(
            consumed, F.count(F.lit(1)).alias("rows")
        )
        flat = flatten_lenient(payloads, keep=tuple(arrival)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            written = append_run(flat.drop(*arrival), facts_path, f"{name}-{number}")
            affected = upsert_latest(spark, latest_path, flat, number, *arrival)
        finally:
            flat.unpersist()
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact(spark, latest_path, number)
            compact_runs(spark, facts_path)
        if on_batch is not None:
            on_batch(BatchReport(batch_id, consumed.get["rows"], written, affected))

    return write


def consume(
    messages: DataFrame,
    writer: Callable[[DataFrame, int], None],
    checkpoint: str,
    drain: bool = False,
    interval_seconds: int | None = None,
) -> StreamingQuery:
    """Start the stream; ``drain`` reads what is there, flushes it and stops.

    Offsets are committed after the batch function returns.
    """
    stream = messages.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint)
    if drain:
        stream = stream.trigger(availableNow=True)
    elif interval_seconds is not None:
        stream = stream.trigger(processingTime=f"{interval_seconds} seconds")
    return stream.start()
