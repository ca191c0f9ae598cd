import json
import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quakeframe.operators.documents import bulk_lines, hourly_documents, latest_documents
from quakeframe.operators.hourly import build_region_hourly_stats_df
from quakeframe.operators.rollups import magnitude_over_time, map_points, severity_over_time, top_regions
from quakeframe.schemas import HOURLY_COLUMNS
from quakeframe.sinks.messages import write_bulk_payload
from tests.helpers import flat_frame


def events(spark, rows):
    """Rows of (second, place, mag, longitude, latitude, tsunami)."""
    base = flat_frame(spark, [(f"e{i}", 1, row[0], row[2]) for i, row in enumerate(rows)])
    more = spark.createDataFrame(
        [(f"e{i}", *row[1:]) for i, row in enumerate(rows)],
        "event_id string, place string, m double, longitude double, latitude double, tsunami int",
    )
    return base.drop("place", "longitude", "latitude", "tsunami").join(more.drop("m"), "event_id")


@pytest.fixture(scope="module")
def hourly(spark):
    return build_region_hourly_stats_df(
        events(
            spark,
            [
                (10, "1 km N of Foo, CA", 3.5, 10.0, 20.0, 1),
                (3599, "2 km S of Foo, CA", 6.00005, 11.0, 21.0, 0),
                (3600, "2 km S of Foo, CA", None, None, 21.0, None),
                (20, None, 1e9, 1.0, 2.0, 0),
                (30, "  ", math.nan, 1.0, 3.0, 1),
            ],
        )
    ).cache()


def test_measures(hourly):
    rows = {(row.bucket_start_utc.hour, row.region_text): row for row in hourly.collect()}
    assert hourly.columns == HOURLY_COLUMNS and len(rows) == 3
    foo = rows[0, "Foo, CA"]
    assert (foo.city, foo.state, foo.event_count, foo.tsunami_count) == ("Foo", "CA", 2, 1)
    assert (foo.mag_count, foo.mag_sum, foo.max_mag, foo.avg_mag) == (2, 9.5001, 6.00005, 4.75005)
    assert (foo.small_count, foo.severe_count, foo.unknown_count) == (1, 1, 0)
    assert (foo.avg_longitude, foo.avg_latitude, foo.day) == (10.5, 20.5, 1)
    later = rows[1, "Foo, CA"]
    assert (later.mag_count, later.mag_sum, later.avg_mag, later.unknown_count) == (0, None, None, 1)
    assert later.avg_longitude is None and later.tsunami_count == 0
    # A magnitude beyond the decimal, and NaN, have a severity and a maximum but no sum.
    unplaced = rows[0, None]
    assert (unplaced.event_count, unplaced.extreme_count, unplaced.mag_count) == (2, 2, 0)
    assert math.isnan(unplaced.max_mag) and unplaced.city is None


def test_rows_without_a_time_are_left_out(spark):
    df = events(spark, [(10, "x", 1.0, 1.0, 1.0, 0)]).withColumn("event_time_utc", F.lit(None).cast("timestamp"))
    assert build_region_hourly_stats_df(df).count() == 0


def test_rollups(hourly):
    severity = {row.bucket_start_utc.hour: row for row in severity_over_time(hourly).collect()}
    assert (severity[0].small_count, severity[0].extreme_count, severity[1].unknown_count) == (1, 2, 1)
    mags = {row.bucket_start_utc.hour: row for row in magnitude_over_time(hourly).collect()}
    assert mags[0].avg_mag == 9.5001 / 2 and mags[1].avg_mag is None
    assert [row.region_text for row in top_regions(hourly, 1).collect()] == ["Foo, CA"]


def test_documents(spark, hourly, tmp_path):
    rows = events(spark, [(10, "Ünï", 3.5, 10.0, 20.0, 1), (11, "b", None, None, 20.0, 0)])
    documents = latest_documents(rows, "idx").orderBy("document_id").collect()
    assert json.loads(documents[0].action_line) == {"index": {"_index": "idx", "_id": "e0"}}
    assert " " not in documents[0].action_line
    first, second = (json.loads(row.document_line) for row in documents)
    assert first["location"] == {"lat": 20.0, "lon": 10.0} and "location" not in second
    assert first["event_time_utc"] == "2024-01-01T00:00:10Z" and first["event_date"] == "2024-01-01"
    assert first["place"] == "Ünï" and second["mag"] is None and first["alert"] is None
    write_bulk_payload(hourly_documents(hourly), str(tmp_path / "bulk"), batch_rows=2)
    files = [file.read_text(encoding="utf-8") for file in (tmp_path / "bulk").glob("part-*")]
    lines = [line for text in files for line in text.splitlines()]
    assert len(lines) == 6 and all(len(text.splitlines()) <= 4 for text in files)
    pairs = [pair for text in files for pair in zip(text.splitlines()[::2], text.splitlines()[1::2])]
    for action, document in pairs:
        assert json.loads(action)["index"]["_id"] == json.loads(document)["document_id"]


def test_a_row_without_id_fails(spark):
    rows = events(spark, [(10, "a", 3.5, 10.0, 20.0, 1)]).withColumn("event_id", F.lit(""))
    with pytest.raises(Exception, match="no event_id"):
        latest_documents(rows).collect()


def test_map_points(spark):
    rows = events(spark, [(10, "a", 3.5, 10.0, 20.0, 1), (11, "b", 1.0, None, 20.0, 0)])
    assert [row.event_id for row in map_points(rows).collect()] == ["e0"]
