"""Rebuilding the snapshot and the hourly table, and refreshing what is served."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quakeframe.defaults import CALENDAR_PARTITIONS
from quakeframe.functions.places import region_text_expr
from quakeframe.functions.times import date_parts, hour_bucket_expr
from quakeframe.operators.documents import hourly_documents, latest_documents
from quakeframe.operators.hourly import build_region_hourly_stats_df
from quakeframe.operators.latest import build_latest_event_df
from quakeframe.schemas import FLAT_EVENT_COLUMNS, FLAT_EVENT_DDL, HOURLY_COLUMNS, HOURLY_DDL
from quakeframe.session import materialize
from quakeframe.sinks.messages import write_bulk_payload
from quakeframe.sinks.runs import has_runs, is_run_table, read_runs
from quakeframe.sinks.snapshot import changed_ids, read_changes, read_snapshot
from quakeframe.sinks.tables import write_partitioned
from quakeframe.sources.tables import drop_path, key_scan, table_exists, table_scan_if_exists

GROUP_DDL = "bucket_start_utc timestamp, region_text string"


def open_facts(spark: SparkSession, facts_path: str, fmt: str = "parquet") -> DataFrame | None:
    """The fact table, be it a plain one or one of runs; None where there are no rows."""
    if is_run_table(spark, facts_path):
        return read_runs(spark, facts_path) if has_runs(spark, facts_path) else None
    return table_scan_if_exists(spark, facts_path, fmt)


def rebuild_latest(
    spark: SparkSession, facts_path: str, latest_path: str, mode: str = "overwrite", fmt: str = "parquet"
) -> int | None:
    """Snapshot table from the fact table; None, and nothing written, without facts."""
    facts = open_facts(spark, facts_path, fmt)
    if facts is None:
        return None
    latest = build_latest_event_df(facts.select(*FLAT_EVENT_COLUMNS))
    return write_partitioned(latest, latest_path, mode, fmt)


def rebuild_hourly(latest: DataFrame, hourly_path: str, mode: str = "overwrite", fmt: str = "parquet") -> int:
    """Hourly table from the snapshot; returns its rows."""
    return write_partitioned(build_region_hourly_stats_df(latest), hourly_path, mode, fmt)


def open_latest(spark: SparkSession, latest_path: str) -> DataFrame | None:
    """The snapshot, be it a plain table or one kept by a stream; None where there is none."""
    if not table_exists(spark, latest_path):
        return None
    if table_exists(spark, f"{latest_path}/changes"):
        return read_snapshot(spark, latest_path)
    return spark.read.schema(FLAT_EVENT_DDL).parquet(latest_path)


def refresh_hourly(spark: SparkSession, latest_path: str, hourly_path: str, payload_path: str) -> int | None:
    """Rebuild the hourly table and its documents; None, and nothing done, without a snapshot."""
    latest = open_latest(spark, latest_path)
    if latest is None:
        return None
    written = rebuild_hourly(latest, hourly_path)
    hourly = spark.read.schema(HOURLY_DDL).parquet(hourly_path)
    write_bulk_payload(hourly_documents(hourly), payload_path)
    return written


def touched_groups(spark: SparkSession, latest_path: str, since: int) -> DataFrame:
    """(bucket_start_utc, region_text) of all rows that came or went with batches after ``since``."""
    changes = read_changes(spark, latest_path, since)
    if changes is None:
        return spark.createDataFrame([], GROUP_DDL)
    both = changes.select("event_time_utc", "place").unionByName(
        changes.select(F.col("before_time_utc").alias("event_time_utc"), F.col("before_place").alias("place"))
    )
    groups = both.filter("event_time_utc is not null").select(*group_columns())
    return groups.distinct()


def group_columns() -> list[Column]:
    return [hour_bucket_expr("event_time_utc").alias("bucket_start_utc"), region_text_expr("place").alias("region_text")]


def same_group(left: str, right: str) -> Column:
    """Null regions are one group."""
    hours = F.col(f"{left}.bucket_start_utc") == F.col(f"{right}.bucket_start_utc")
    return hours & F.col(f"{left}.region_text").eqNullSafe(F.col(f"{right}.region_text"))


def refresh_hourly_since(
    spark: SparkSession, latest_path: str, hourly_path: str, payload_path: str, since: int
) -> dict[str, int]:
    """Bring an hourly table that was built after batch ``since`` up to date, group by group.

    Events that changed take back their old group and go to their new one. Only those groups are
    computed again, from the events of their hours, and only the days they are on are rewritten.
    The documents of the computed groups are written as a payload. Returns the groups touched and the
    rows computed for them; groups without events have none.
    """
    groups = materialize(touched_groups(spark, latest_path, since), "groups")
    first, last, count = groups.agg(F.min("bucket_start_utc"), F.max("bucket_start_utc"), F.count("*")).first()
    if not count:
        return {"groups": 0, "rows": 0}
    in_hours = F.col("event_time_utc").between(F.lit(first), F.lit(last) + F.expr("interval 1 hour"))
    events = read_snapshot(spark, latest_path).filter(in_hours).select("*", *group_columns())
    of_groups = events.alias("event").join(groups.alias("group"), same_group("event", "group"), "left_semi")
    fresh = build_region_hourly_stats_df(of_groups.drop("bucket_start_utc", "region_text"))
    fresh = materialize(fresh, "hours")
    days = materialize(groups.select(*date_parts("bucket_start_utc")).distinct(), "days")
    stored = spark.read.schema(HOURLY_DDL).parquet(hourly_path).join(F.broadcast(days), list(CALENDAR_PARTITIONS), "left_semi")
    kept = stored.alias("row").join(groups.alias("group"), same_group("row", "group"), "left_anti")
    whole = materialize(kept.select(*HOURLY_COLUMNS).unionByName(fresh), "hourly-days")
    write_partitioned(whole, hourly_path, options={"partitionOverwriteMode": "dynamic"})
    # A day that lost its last group is not in what was written.
    for day in days.join(whole, list(CALENDAR_PARTITIONS), "left_anti").collect():
        drop_path(spark, "/".join([hourly_path, *[f"{name}={day[name]}" for name in CALENDAR_PARTITIONS]]))
    write_bulk_payload(hourly_documents(fresh), payload_path)
    return {"groups": count, "rows": fresh.count()}


def sync_latest(
    spark: SparkSession,
    latest_path: str,
    payload_path: str,
    event_ids: Sequence[str] | DataFrame | None = None,
    since: int | None = None,
) -> bool:
    """Write the documents of the snapshot, or only of the given ids, or of those changed after batch ``since``."""
    latest = open_latest(spark, latest_path)
    if latest is None:
        return False
    if since is not None:
        latest = key_scan(latest, changed_ids(spark, latest_path, since))
    documents = latest_documents(key_scan(latest, event_ids))
    write_bulk_payload(documents, payload_path)
    return True
