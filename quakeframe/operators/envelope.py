"""Envelopes around features: build, encode, decode."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakeframe.functions.places import as_column
from quakeframe.functions.times import iso_date_expr, iso_text_expr
from quakeframe.sources.messages import decode_value

SOURCE_MODES = ("realtime", "backfill")

ENVELOPE_COLUMNS = (
    "event_id",
    "source_feed",
    "source_mode",
    "ingest_time_utc",
    "published_topic",
    "feature",
    "request_window_start",
    "request_window_end",
)


def _window_text(value: str | Column | date | None) -> Column:
    if value is None:
        return F.lit(None).cast("string")
    return iso_date_expr(F.lit(value) if isinstance(value, date) else value)


def build_event_envelope(
    features: DataFrame,
    source_feed: str | Column,
    source_mode: str,
    topic: str,
    ingest_time: str | Column | None = None,
    request_window_start: str | Column | date | None = None,
    request_window_end: str | Column | date | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Wrap rows of ``event_id, feature``; a text ``source_feed`` is a literal address."""
    if source_mode not in SOURCE_MODES:
        raise ValueError(f"source_mode must be one of {SOURCE_MODES}")
    feed = F.lit(source_feed) if isinstance(source_feed, str) else source_feed
    observed = F.current_timestamp() if ingest_time is None else as_column(ingest_time)
    return features.select(
        "event_id",
        feed.alias("source_feed"),
        F.lit(source_mode).alias("source_mode"),
        iso_text_expr(observed).alias("ingest_time_utc"),
        F.lit(topic).alias("published_topic"),
        "feature",
        _window_text(request_window_start).alias("request_window_start"),
        _window_text(request_window_end).alias("request_window_end"),
        *keep,
    )


def encode_envelope(envelopes: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Messages: ``key`` is the event id, ``value`` the envelope as JSON with its nulls."""
    body = F.to_json(F.struct(*ENVELOPE_COLUMNS), {"ignoreNullFields": "false"})
    return envelopes.select(F.col("event_id").alias("key"), body.alias("value"), *keep)


def decode_envelope(messages: DataFrame, value: str = "value") -> DataFrame:
    """Message bodies as untyped variants; null where the text is not JSON."""
    return messages.withColumn("envelope", F.try_parse_json(decode_value(value)))
