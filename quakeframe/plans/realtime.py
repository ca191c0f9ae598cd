"""Fetched documents to messages, and messages to tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quakeframe.defaults import RAW_TOPIC, SUPPRESS_TTL_SECONDS
from quakeframe.functions.times import epoch_ms_expr
from quakeframe.operators.dedup import unique_features
from quakeframe.operators.envelope import build_event_envelope, encode_envelope
from quakeframe.operators.suppress import suppress_recent
from quakeframe.session import materialize
from quakeframe.sources.landed import explode_features
from quakeframe.streaming.consumer import BatchReport, batch_writer, consume
from quakeframe.streaming.suppress import GENERATION, suppressing_writer


def realtime_messages(
    fetches: DataFrame,
    source_feed: str | Column,
    topic: str = RAW_TOPIC,
    ttl_seconds: float = SUPPRESS_TTL_SECONDS,
    key: tuple[str, ...] = ("event_id",),
) -> DataFrame:
    """Messages of fetched collections; ``observed_at`` tells the fetches apart.

    The last copy of an id counts inside a fetch. Between fetches an id stays silent for
    ``ttl_seconds`` after it was published, also when its content changed; a longer
    ``key`` publishes changed content at once.
    """
    published = suppress_recent(folded_fetches(fetches), key, "observed_at", ttl_seconds, ("position",))
    return encoded(published, source_feed, topic)


def folded_fetches(fetches: DataFrame) -> DataFrame:
    """One row per id and fetch, with the feature as text; written, since it is read more than once."""
    # Variants cannot be compared, so the copies are folded as text.
    text = explode_features(fetches).withColumn("feature", F.to_json("feature"))
    return materialize(unique_features(text, ["observed_at"]), "features")


def encoded(published: DataFrame, source_feed: str | Column, topic: str) -> DataFrame:
    typed = published.withColumn("feature", F.parse_json("feature"))
    feed = F.lit(source_feed) if isinstance(source_feed, str) else source_feed
    envelopes = build_event_envelope(
        typed, F.coalesce("source_url", feed), "realtime", topic, "observed_at"
    )
    return encode_envelope(envelopes)


def fetch_counts(batch: DataFrame, unique: DataFrame, published: DataFrame) -> DataFrame:
    """One row for each fetch, told apart by ``observed_at``: what its documents say, and what became of them.

    Whatever is not published is a duplicate, so published and duplicate add up to fetched.
    """
    fetched = batch.groupBy("observed_at").agg(
        F.max("metadata.title").alias("title"),
        epoch_ms_expr(F.max("metadata.generated")).alias("generated_at"),
        F.max("metadata.status").alias("status"),
        F.sum(F.coalesce(F.size("features"), F.lit(0))).alias("fetched_count"),
    )
    for name, rows in (("unique_count", unique), ("published_count", published)):
        fetched = fetched.join(rows.groupBy("observed_at").agg(F.count(F.lit(1)).alias(name)), "observed_at", "left")
        fetched = fetched.withColumn(name, F.coalesce(name, F.lit(0)))
    return fetched.withColumn("duplicate_count", F.col("fetched_count") - F.col("published_count"))


def realtime_writer(
    publish: Callable[[DataFrame, int], None],
    memory_path: str,
    source_feed: str,
    topic: str = RAW_TOPIC,
    ttl_seconds: float = SUPPRESS_TTL_SECONDS,
    key: tuple[str, ...] = ("event_id",),
    generation: int = 0,
    counts_path: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """``realtime_messages`` as a ``foreachBatch`` function over a stream of fetched collections.

    What was published is remembered from batch to batch, so an id stays silent for its time to
    live also across batches. ``publish`` gets the messages and the batch id, and must replace
    its own output when a batch is repeated. A summary of every fetch, however many a micro-batch
    holds, goes to ``counts_path``; a repeated batch replaces its own.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        started = datetime.now(UTC)
        unique = folded_fetches(batch)

        def send(passed: DataFrame, number: int) -> None:
            publish(encoded(passed, source_feed, topic), number)
            if counts_path is not None:
                about = {
                    "source_feed": F.lit(source_feed), "source_mode": F.lit("realtime"), "topic": F.lit(topic),
                    "started_at": F.lit(started), "finished_at": F.lit(datetime.now(UTC)),
                }
                counts = fetch_counts(batch, unique, passed).withColumns(about)
                counts.write.mode("overwrite").parquet(f"{counts_path}/batch_id={generation * GENERATION + number}")

        suppressing_writer(send, memory_path, key, "observed_at", ttl_seconds, ("position",), generation)(
            unique, batch_id
        )

    return write


def run_consumer(
    messages: DataFrame,
    facts_path: str,
    latest_path: str,
    checkpoint: str,
    drain: bool = False,
    compact_every: int = 60,
    on_batch: Callable[[BatchReport], None] | None = None,
) -> StreamingQuery:
    """Keep the fact table and the snapshot up to date from a message stream."""
    writer = batch_writer(facts_path, latest_path, compact_every=compact_every, on_batch=on_batch)
    return consume(messages, writer, checkpoint, drain)
