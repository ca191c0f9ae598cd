"""The newest revision of every event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quakeframe.functions.times import with_calendar


def recency(tie_break: list[Column]) -> list[Column]:
    """Newest first: by update time, then event time; a missing time loses."""
    return [
        F.col("updated_time_utc").desc_nulls_last(),
        F.col("event_time_utc").desc_nulls_last(),
        *tie_break,
    ]


def newest_per_key(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key.

    Row number one of a window: Spark keeps one row per key and task before it shuffles
    (WindowGroupLimit), so a key that holds much of the table arrives as few rows.
    """
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def build_latest_event_df(flat_event_df: DataFrame) -> DataFrame:
    """One row per event id, with calendar columns of its own event time.

    Rows that tie on both times are told apart by a hash of the row, so a rebuild gives
    the same table whatever the order of the input files.
    """
    order = recency([F.xxhash64(*flat_event_df.columns).desc()])
    return with_calendar(newest_per_key(flat_event_df, ["event_id"], order))


def dedupe_latest_rows(flat_rows: DataFrame, arrival: str | None = None) -> DataFrame:
    """Newest row per id of one batch; blank ids are skipped.

    With an ``arrival`` column the earliest of fully tied rows stays.
    """
    tie_break = F.col(arrival).asc() if arrival else F.xxhash64(*flat_rows.columns).desc()
    named = flat_rows.filter(F.col("event_id") != "")
    return newest_per_key(named, ["event_id"], recency([tie_break]))
