"""Merging newer revisions into a snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quakeframe.operators.latest import dedupe_latest_rows, newest_per_key

KEY = "event_id"
INSERT, UPDATE, KEEP = "insert", "update", "keep"


def replaces(source: str = "source", target: str = "target") -> Column:
    """Whether a matched source row replaces its target row.

    A target without an update time always gives way. A source without one replaces
    nothing else, since its comparisons are null.
    """
    s_updated, t_updated = F.col(f"{source}.updated_time_utc"), F.col(f"{target}.updated_time_utc")
    s_time, t_time = F.col(f"{source}.event_time_utc"), F.col(f"{target}.event_time_utc")
    return (
        t_updated.isNull()
        | (s_updated > t_updated)
        | ((s_updated == t_updated) & (s_time > t_time))
    )


def merge_actions(target: DataFrame, source: DataFrame) -> DataFrame:
    """Full outer join of two one-row-per-id tables: aliases target and source, and action."""
    joined = target.alias("target").join(
        source.alias("source"), F.col(f"target.{KEY}") == F.col(f"source.{KEY}"), "full_outer"
    )
    action = (
        F.when(F.col(f"target.{KEY}").isNull(), F.lit(INSERT))
        .when(F.col(f"source.{KEY}").isNotNull() & replaces(), F.lit(UPDATE))
        .otherwise(F.lit(KEEP))
    )
    return joined.withColumn("action", action)


def merge_latest(target: DataFrame, source: DataFrame) -> DataFrame:
    """The snapshot after the merge, with the columns of the target."""
    from_target = F.col("action") == KEEP
    return merge_actions(target, source).select(
        *[
            F.when(from_target, F.col(f"target.{name}")).otherwise(F.col(f"source.{name}")).alias(name)
            for name in target.columns
        ]
    )


def merge_counts(target: DataFrame, source: DataFrame) -> DataFrame:
    """One row: rows inserted, rows updated, and their sum."""
    narrow = [KEY, "updated_time_utc", "event_time_utc"]
    # Untouched target rows do not count, so a join from the source side is enough.
    joined = source.select(narrow).alias("source").join(
        target.select(narrow).alias("target"),
        F.col(f"target.{KEY}") == F.col(f"source.{KEY}"),
        "left",
    )
    unmatched = F.col(f"target.{KEY}").isNull()
    return joined.agg(
        F.count_if(unmatched).alias("inserted_count"),
        F.count_if(~unmatched & replaces()).alias("updated_count"),
    ).withColumn("affected_count", F.col("inserted_count") + F.col("updated_count"))


def merge_into_table(source: DataFrame, table: str, arrival: str | None = None) -> None:
    """MERGE INTO a catalog table whose format supports row-level changes."""
    newest = dedupe_latest_rows(source, arrival).select(
        *[name for name in source.columns if name != arrival]
    )
    (
        newest.alias("source")
        .mergeInto(table, F.col(f"{table}.{KEY}") == F.col(f"source.{KEY}"))
        .whenMatched(replaces("source", table))
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )


def merge_in_order(batches: DataFrame, batch: str) -> DataFrame:
    """What merging batch after batch would leave, in one pass and one shuffle.

    ``batches`` holds at most one row per id and batch. Merging one after another means:
    among rows with an update time the newest wins. Of rows equal in it the first to come gives
    way only to later event times, in the end to the latest, and of equal ones the earliest
    batch; if it has no event time it stays, since comparisons with it are null. An id that
    never had an update time keeps the row of its last batch.
    """
    dated = F.col("updated_time_utc").isNotNull()
    same_update = Window.partitionBy(KEY, "updated_time_utc")
    first = F.col(batch) == F.min(batch).over(same_update)
    marked = batches.withColumn("_stays", dated & first & F.col("event_time_utc").isNull())
    order = [
        F.col("updated_time_utc").desc_nulls_last(),
        F.col("_stays").desc(),
        F.when(dated, F.col("event_time_utc")).desc_nulls_last(),
        F.when(dated, F.col(batch)).asc_nulls_first(),
        F.col(batch).desc(),
    ]
    return newest_per_key(marked, [KEY], order).drop("_stays")
