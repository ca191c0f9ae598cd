"""Copies of a feature inside one fetch, and across the windows of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quakeframe.operators.latest import newest_per_key


def unique_features(
    features: DataFrame,
    within: list[str],
    key: str = "event_id",
    position: str = "position",
    keep: str = "last",
) -> DataFrame:
    """One copy per key inside each fetch, at the position the key was first seen.

    An aggregate with partial results per task, so copies are folded before the shuffle.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    group = [*within, key]
    rest = [name for name in features.columns if name not in (*group, position)]
    pick = F.max_by if keep == "last" else F.min_by
    folded = features.groupBy(*group).agg(
        pick(F.struct(*rest), position).alias("_copy"),
        F.min(position).alias(position),
    )
    return folded.select(*group, position, "_copy.*").select(*features.columns)


def first_across_chunks(
    features: DataFrame,
    key: str = "event_id",
    chunk: str = "chunk_start",
    position: str = "position",
) -> DataFrame:
    """The copy of the earliest window; inside one window the earliest position.

    After ``unique_features`` this drops ids an earlier window already had. On raw
    features the first copy wins inside and across windows.
    """
    return newest_per_key(features, [key], [F.col(chunk).asc(), F.col(position).asc()])


def flag_first_chunk(per_chunk: DataFrame, key: str = "event_id", chunk: str = "chunk_start") -> DataFrame:
    """Mark whether a key is new in its window; expects one row per key and window."""
    earliest = F.min(chunk).over(Window.partitionBy(key))
    return per_chunk.withColumn("is_new", F.col(chunk) == earliest)
