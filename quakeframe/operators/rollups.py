"""Dashboard measures over the hourly table and the snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakeframe.functions.places import SEVERITY_BOUNDS, SEVERITY_MISSING, SEVERITY_TOP
from quakeframe.functions.values import geo_point_expr

SEVERITY_COUNTS = [
    f"{name}_count"
    for name in (SEVERITY_MISSING, *(name for name, _ in SEVERITY_BOUNDS), SEVERITY_TOP)
]


def events_over_time(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("bucket_start_utc").agg(F.sum("event_count").alias("event_count"))


def severity_over_time(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("bucket_start_utc").agg(
        *[F.sum(name).alias(name) for name in SEVERITY_COUNTS]
    )


def magnitude_over_time(hourly: DataFrame) -> DataFrame:
    """Peak magnitude and the mean weighted by the number of magnitudes.

    The sums of an hour are added as decimals, so the mean does not depend on row order.
    """
    total = F.sum(F.col("mag_sum").cast("decimal(24,4)")).cast("double")
    return hourly.groupBy("bucket_start_utc").agg(
        F.max("max_mag").alias("max_mag"),
        F.try_divide(total, F.sum("mag_count")).alias("avg_mag"),
    )


def top_regions(hourly: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` regions with most events; equal counts are ordered by region text."""
    return (
        hourly.groupBy("region_text")
        .agg(F.sum("event_count").alias("event_count"))
        .orderBy(F.col("event_count").desc(), F.col("region_text").asc_nulls_first())
        .limit(n)
    )


def tsunami_by_region(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("region_text").agg(F.sum("tsunami_count").alias("tsunami_count"))


def map_points(latest: DataFrame) -> DataFrame:
    """Snapshot rows with a position, for a map."""
    return latest.withColumn("location", geo_point_expr("latitude", "longitude")).filter(
        F.col("location").isNotNull()
    )
