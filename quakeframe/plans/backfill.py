"""Landed catalog documents to the fact table, or to messages."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quakeframe.defaults import BACKFILL_TOPIC, BACKFILL_WINDOW_DAYS
from quakeframe.functions.times import epoch_ms_expr
from quakeframe.operators.dedup import first_across_chunks, unique_features
from quakeframe.operators.envelope import build_event_envelope, encode_envelope
from quakeframe.operators.flatten import accepted, classify_typed
from quakeframe.schemas import FLAT_EVENT_COLUMNS, TYPED_COLLECTION_DDL
from quakeframe.sinks.runs import append_run, replace_runs
from quakeframe.sources.landed import explode_features, read_feature_collections
from quakeframe.sources.windows import check_window, in_date_range, with_chunk


def in_windows(
    features: DataFrame, time_ms: Column, start: date, end: date, window_days: int
) -> DataFrame:
    """Features of a date range with the window each falls into."""
    check_window(start, end, window_days)
    timed = features.withColumn("event_time_utc", epoch_ms_expr(time_ms))
    in_range = timed.filter(in_date_range("event_time_utc", start, end))
    return with_chunk(
        in_range, F.to_date("event_time_utc"), F.lit(start), F.lit(end), window_days
    )


def backfill_flat_rows(
    collections: DataFrame, start: date, end: date, window_days: int = BACKFILL_WINDOW_DAYS
) -> DataFrame:
    """Flat rows of typed documents; of each id the first copy of the earliest window.

    Inside a window features count in ascending time, as a catalog returns them.
    """
    features = collections.select(F.posexplode("features").alias("position", "feature"))
    time = F.col("feature.properties.time")
    chunked = in_windows(
        features.withColumn("event_id", F.col("feature.id")),
        F.try_variant_get(time, "$", "bigint"), start, end, window_days,
    )
    # The strict reader takes whole numbers only.
    whole = F.when(F.schema_of_variant(time) == "BIGINT", F.try_variant_get(time, "$", "bigint"))
    typed = chunked.withColumn("feature", F.col("feature").withField("properties.time", whole))
    ordered = typed.withColumn(
        "position", F.struct("event_time_utc", "position", F.xxhash64("feature"))
    )
    return accepted(classify_typed(first_across_chunks(ordered).drop("event_time_utc")))


def backfill_messages(
    collections: DataFrame,
    start: date,
    end: date,
    source_feed: str,
    window_days: int = BACKFILL_WINDOW_DAYS,
    topic: str = BACKFILL_TOPIC,
    ingest_time: str | Column | None = None,
) -> DataFrame:
    """Messages of documents with variant features.

    Inside a window the last copy of an id counts, and an id goes with the earliest window.
    """
    features = explode_features(collections)
    time_ms = F.try_variant_get("feature", "$.properties.time", "bigint")
    chunked = in_windows(features, time_ms, start, end, window_days)
    # Variants cannot be compared, so the copies are folded as text.
    text = chunked.withColumn("feature", F.to_json("feature"))
    ordered = text.withColumn(
        "position", F.struct("event_time_utc", "position", F.xxhash64("feature"))
    )
    unique = first_across_chunks(unique_features(ordered, ["chunk_start"]))
    envelopes = build_event_envelope(
        unique.withColumn("feature", F.parse_json("feature")),
        F.coalesce("source_url", F.lit(source_feed)),
        "backfill", topic, ingest_time, "chunk_start", "chunk_end",
    )
    return encode_envelope(envelopes)


def run_backfill(
    spark: SparkSession,
    collections_path: str,
    facts_path: str,
    start: date,
    end: date,
    window_days: int = BACKFILL_WINDOW_DAYS,
    mode: str = "append",
    run_id: str | None = None,
    one_per_line: bool = False,
) -> int:
    """Write all windows at once; returns the rows written.

    ``append`` adds the rows as a run of its own; with a ``run_id`` it replaces what an earlier
    run of that id has written.
    ``overwrite`` replaces the whole table, after all windows were read.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError("mode must be 'append' or 'overwrite'")
    collections = read_feature_collections(
        spark, collections_path, one_per_line, TYPED_COLLECTION_DDL
    )
    flat = backfill_flat_rows(collections, start, end, window_days)
    if mode == "append":
        return append_run(flat, facts_path, run_id)
    run = run_id or f"backfill-{start.isoformat()}-{end.isoformat()}"
    return replace_runs(flat.select(*FLAT_EVENT_COLUMNS), facts_path, run)
