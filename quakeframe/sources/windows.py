"""Date windows, and range reads over landed rows."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quakeframe.defaults import MAX_WINDOW_DAYS


def check_window(start: date, end: date, window_days: int) -> None:
    """Reject a reversed date range and a window outside 1 to 366 days."""
    if end < start:
        raise ValueError("the end date must not be before the start date")
    if not 1 <= window_days <= MAX_WINDOW_DAYS:
        raise ValueError(f"window_days must be from 1 to {MAX_WINDOW_DAYS}")


def date_chunks(bounds: DataFrame, window_days: int) -> DataFrame:
    """Inclusive windows without gaps between ``start_date`` and ``end_date`` of each row."""
    if window_days < 1:
        raise ValueError("window_days must be at least 1")
    starts = F.sequence("start_date", "end_date", F.make_interval(days=F.lit(window_days)))
    return bounds.select("end_date", F.explode(starts).alias("chunk_start")).select(
        "chunk_start",
        F.least(F.date_add("chunk_start", window_days - 1), "end_date").alias("chunk_end"),
    )


def chunk_date_range(spark: SparkSession, start: date, end: date, window_days: int) -> DataFrame:
    """``date_chunks`` for one literal range."""
    check_window(start, end, window_days)
    bounds = spark.range(1).select(
        F.lit(start).alias("start_date"), F.lit(end).alias("end_date")
    )
    return date_chunks(bounds, window_days)


def with_chunk(
    df: DataFrame, day: str | Column, start: str | Column, end: str | Column, window_days: int
) -> DataFrame:
    """Add the window a day falls into, by arithmetic instead of a range join.

    Days outside of the range have no window: both columns are null.
    """
    if window_days < 1:
        raise ValueError("window_days must be at least 1")
    offset = F.date_diff(day, start)
    inside = (offset >= 0) & (F.date_diff(end, day) >= 0)
    first = F.date_add(start, (offset - F.pmod(offset, F.lit(window_days))).cast("int"))
    chunk_start = F.when(inside, first)
    return df.withColumn("chunk_start", chunk_start).withColumn(
        "chunk_end", F.when(inside, F.least(F.date_add("chunk_start", window_days - 1), end))
    )


def in_date_range(time: str, start: date, end: date) -> Column:
    """From the first instant of ``start`` to the last of ``end``, as a pushable range."""
    first = F.lit(start).cast("timestamp")
    after = F.date_add(F.lit(end), 1).cast("timestamp")
    return (F.col(time) >= first) & (F.col(time) < after)


def catalog_range(
    df: DataFrame,
    start: date,
    end: date,
    time: str = "event_time_utc",
    tie_break: tuple[str, ...] = ("event_id",),
    limit: int | None = None,
) -> DataFrame:
    """All rows of a date range, ascending by time, or the earliest ``limit`` of them.

    ``range_truncated`` tells whether the range held more rows than a given limit, so a
    caller can read a shorter range instead of losing the rest unnoticed.
    """
    ordered = [F.col(time).asc(), *(F.col(name).asc() for name in tie_break)]
    inside = df.filter(in_date_range(time, start, end))
    if limit is None:
        return inside.withColumn("range_truncated", F.lit(False)).orderBy(*ordered)
    # A scalar, worked out once: whether there is a row after the limit.
    more = inside.orderBy(*ordered).offset(limit).limit(1).agg(F.count(F.lit(1)) > 0)
    head = inside.orderBy(*ordered).limit(limit)
    return head.withColumn("range_truncated", more.scalar()).orderBy(*ordered)


def bounded_windows(
    df: DataFrame, start: date, end: date, limit: int, time: str = "event_time_utc"
) -> DataFrame:
    """Windows of a date range that hold at most ``limit`` rows each, and all of its rows.

    (window_start, window_end, row_count, exceeds), both times inclusive. Times that begin in the same half
    of the limit go together; a time with more rows than a half has a window of its own. ``exceeds``
    marks a single time with more rows than the limit, which no window can cut.

    The rows are counted by time, and running counts are made in each minute, over the minutes of
    a day, and over the days, so no task sees more than a minute's times or a day's minutes.
    """
    if limit < 1:
        raise ValueError("limit must be at least 1")
    inside = df.filter(in_date_range(time, start, end))
    times = inside.groupBy(F.col(time).alias("time")).agg(F.count(F.lit(1)).alias("n"))
    times = times.select("*", F.date_trunc("minute", "time").alias("minute"), F.to_date("time").alias("day"))
    earlier = Window.unboundedPreceding, -1
    minutes = times.groupBy("day", "minute").agg(F.sum("n").alias("n"))
    days = minutes.groupBy("day").agg(F.sum("n").alias("n"))
    # One row for each day of the range.
    before_day = F.coalesce(F.sum("n").over(Window.orderBy("day").rowsBetween(*earlier)), F.lit(0))
    in_day = Window.partitionBy("day").orderBy("minute").rowsBetween(*earlier)
    placed = minutes.withColumn("in_day", F.coalesce(F.sum("n").over(in_day), F.lit(0))).join(
        days.select("day", before_day.alias("before_day")), "day"
    )
    offsets = placed.select("minute", (F.col("in_day") + F.col("before_day")).alias("before"))
    in_minute = Window.partitionBy("minute").orderBy("time").rowsBetween(*earlier)
    counted = times.withColumn("in_minute", F.coalesce(F.sum("n").over(in_minute), F.lit(0))).join(offsets, "minute")
    half = max(1, limit // 2)
    large = F.col("n") > half
    first = F.col("before") + F.col("in_minute")
    window = F.struct(
        F.floor(first / half).alias("part"),
        # After a large time another window begins in the same half; before it, the one that was.
        F.when(large, F.col("time")).alias("alone"),
    )
    return (
        counted.groupBy(window.alias("window"))
        .agg(F.min("time").alias("window_start"), F.max("time").alias("window_end"), F.sum("n").alias("row_count"))
        .select("window_start", "window_end", "row_count", (F.col("row_count") > limit).alias("exceeds"))
    )


def read_window(df: DataFrame, window_start: datetime, window_end: datetime, time: str = "event_time_utc") -> DataFrame:
    """The rows of one window, by a range that reaches the scan."""
    return df.filter((F.col(time) >= F.lit(window_start)) & (F.col(time) <= F.lit(window_end)))
