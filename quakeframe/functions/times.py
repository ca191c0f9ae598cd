"""Epoch times, buckets, calendar parts and ISO text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakeframe.functions.places import as_column

# Epoch milliseconds of the first and the last instant of years 1 to 9999.
FIRST_EPOCH_MS = -62_135_596_800_000
LAST_EPOCH_MS = 253_402_300_799_999


def epoch_ms_expr(value_ms: str | Column) -> Column:
    """Whole epoch milliseconds to a timestamp; null outside years 1 to 9999."""
    ms = as_column(value_ms)
    return F.when(ms.between(FIRST_EPOCH_MS, LAST_EPOCH_MS), F.timestamp_millis(ms))


def fractional_epoch_ms_expr(value_ms: str | Column) -> Column:
    """Epoch milliseconds as a double to a timestamp of microseconds."""
    ms = as_column(value_ms)
    micros = F.bround(ms * F.lit(1000.0)).cast("bigint")
    return F.when(ms.between(FIRST_EPOCH_MS, LAST_EPOCH_MS), F.timestamp_micros(micros))


def hour_bucket_expr(event_time: str | Column) -> Column:
    return F.date_trunc("hour", as_column(event_time))


def date_parts(event_time: str | Column) -> list[Column]:
    """year, month and day of a timestamp."""
    time = as_column(event_time)
    return [
        F.year(time).alias("year"),
        F.month(time).alias("month"),
        F.dayofmonth(time).alias("day"),
    ]


def calendar_columns(event_time: str | Column) -> list[Column]:
    """event_date plus its year, month and day."""
    return [F.to_date(as_column(event_time)).alias("event_date"), *date_parts(event_time)]


def with_calendar(df: DataFrame, event_time: str = "event_time_utc") -> DataFrame:
    names = ("event_date", "year", "month", "day")
    return df.withColumns(dict(zip(names, calendar_columns(event_time))))


def iso_text_expr(value: str | Column) -> Column:
    """ISO text of a UTC timestamp with a Z; microseconds appear only when not zero."""
    time = as_column(value)
    whole_second = F.unix_micros(time) % 1_000_000 == 0
    return F.when(
        whole_second, F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    ).otherwise(F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))


def iso_date_expr(value: str | Column) -> Column:
    return F.date_format(as_column(value), "yyyy-MM-dd")
