"""Seismic event data on PySpark: facts, latest snapshot, hourly statistics, documents."""

from quakeframe.operators.hourly import build_region_hourly_stats_df
from quakeframe.operators.latest import build_latest_event_df, dedupe_latest_rows
from quakeframe.session import create_session, prepare_session

__all__ = [
    "build_latest_event_df",
    "build_region_hourly_stats_df",
    "create_session",
    "dedupe_latest_rows",
    "prepare_session",
]
