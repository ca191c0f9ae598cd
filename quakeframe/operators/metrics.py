"""Counts per window, per run and per write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakeframe.operators.dedup import flag_first_chunk
from quakeframe.operators.suppress import suppress_recent
from quakeframe.session import materialize

CHUNK = ["chunk_start", "chunk_end"]
COUNTS = ["fetched_count", "unique_count", "published_count", "duplicate_count"]


def chunk_metrics(
    fetched: DataFrame,
    key: str = "event_id",
    across_chunks: bool = True,
    ttl_seconds: float | None = None,
    observed: str = "observed_at",
) -> DataFrame:
    """Fetched, unique, published and duplicate features of every window.

    ``across_chunks`` drops ids an earlier window already had, and ``ttl_seconds`` ids
    published too recently by the observed time. Whatever is not published is a duplicate,
    so published and duplicate always add up to fetched.

    Rows are first folded to one per window and id, which also gives the distinct count.
    """
    measures = [F.count(F.lit(1)).alias("copies")]
    if ttl_seconds is not None:
        measures.append(F.min(observed).alias(observed))
    per_key = fetched.groupBy(*CHUNK, key).agg(*measures)
    if across_chunks:
        flagged = flag_first_chunk(per_key, key)
    else:
        flagged = per_key.withColumn("is_new", F.lit(True))
    if ttl_seconds is not None:
        flagged = materialize(flagged, "chunk-keys")
        offered = flagged.filter("is_new").select("chunk_start", key, observed)
        passed = suppress_recent(offered, (key,), observed, ttl_seconds, ("chunk_start",))
        published = passed.select("chunk_start", key, F.lit(True).alias("published"))
        flagged = flagged.join(published, ["chunk_start", key], "left").withColumn(
            "is_new", F.coalesce("published", F.lit(False))
        )
    counted = flagged.groupBy(*CHUNK).agg(
        F.sum("copies").alias("fetched_count"),
        F.count(F.lit(1)).alias("unique_count"),
        F.count_if("is_new").alias("published_count"),
    )
    return counted.withColumn(
        "duplicate_count", F.col("fetched_count") - F.col("published_count")
    )


def run_metrics(chunks: DataFrame, by: list[str]) -> DataFrame:
    """Totals of the window counts per run, such as by mode and topic."""
    return chunks.groupBy(*by).agg(
        F.count(F.lit(1)).alias("chunk_count"), *[F.sum(name).alias(name) for name in COUNTS]
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))
