import hashlib
import math
from datetime import datetime, timezone
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quakeframe.functions.places import city_expr, region_text_expr, severity_expr, state_expr
from quakeframe.functions.times import (
    epoch_ms_expr,
    fractional_epoch_ms_expr,
    hour_bucket_expr,
    iso_text_expr,
)
from quakeframe.functions.values import (
    comma_delimited_to_array_expr,
    geo_point_expr,
    hash_key_expr,
    to_decimal_expr,
    to_float_expr,
    to_int_expr,
)

# place, region, city, state, city and state with blanks as null
PLACES = [
    ("10 km S of Foo, CA", "Foo, CA", "Foo", "CA", "Foo", "CA"),
    ("Foo,", "Foo,", "Foo", "", "Foo", None),
    (",CA", ",CA", "", "CA", None, "CA"),
    ("A of ,", ",", "", "", None, None),
    ("a of b of c, d, e", "c, d, e", "c", "e", "c", "e"),
    ("South of the Fiji Islands", "the Fiji Islands", "the Fiji Islands", None, "the Fiji Islands", None),
    (" of Q", "of Q", "of Q", None, "of Q", None),
    ("  ", None, None, None, None, None),
    ("", None, None, None, None, None),
    (None, None, None, None, None, None),
]


def test_places(spark):
    region = region_text_expr("place")
    rows = spark.createDataFrame([(p[0],) for p in PLACES], "place string").select(
        "place", region, city_expr(region), state_expr(region), city_expr(region, True), state_expr(region, True)
    ).collect()
    assert [tuple(row) for row in rows] == PLACES


def plain_place(place):
    text = place.strip(" ") if place is not None else ""
    if not text:
        return None, None, None
    region = text.rpartition(" of ")[2].strip(" ")
    if "," not in region:
        return region, region, None
    parts = region.split(",")
    return region, parts[0].strip(" "), parts[-1].strip(" ")


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from([" of ", ",", " ", "a", "of", "é", "Bay"]), max_size=7).map("".join), min_size=1, max_size=40))
def test_places_follow_the_plain_rule(spark, texts):
    region = region_text_expr("place")
    rows = spark.createDataFrame([(text,) for text in texts], "place string").select(
        "place", region.alias("r"), city_expr(region).alias("c"), state_expr(region).alias("s")
    ).collect()
    for row in rows:
        assert (row.r, row.c, row.s) == plain_place(row.place), repr(row.place)


def test_severity(spark):
    expected = [
        (None, "unknown"), (math.nan, "extreme"), (3.9999, "small"), (4.0, "moderate"), (4.9999, "moderate"),
        (5.0, "strong"), (6.0, "severe"), (7.0, "extreme"), (-1.0, "small"),
    ]
    rows = spark.createDataFrame([(m,) for m, _ in expected], "mag double").select(severity_expr("mag")).collect()
    assert [row[0] for row in rows] == [name for _, name in expected]


def test_decimals(spark):
    values = [1e9, math.nan, 1.23455, 2.00005, None, -1.5]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(to_decimal_expr("v", 10, 4)).collect()
    expected = [None, None, "1.2346", "2.0001", None, "-1.5000"]
    assert [row[0] for row in rows] == [e and Decimal(e) for e in expected]


def test_comma_lists(spark):
    cases = {",a,b,": ["a", "b"], None: [], "": [], ",,": [], "a,,b": ["a", "", "b"], ",,x": ["x"]}
    rows = spark.createDataFrame([(c,) for c in cases], "v string").select("v", comma_delimited_to_array_expr("v").alias("a")).collect()
    assert {row.v: row.a for row in rows} == cases


def test_epoch_times(spark):
    rows = spark.createDataFrame([(0,), (-1,), (253402300799999,), (253402300800000,), (-62135596800001,), (None,)], "v bigint").select(
        F.unix_millis(epoch_ms_expr("v"))
    ).collect()
    assert [row[0] for row in rows] == [0, -1, 253402300799999, None, None, None]
    rows = spark.createDataFrame([(1.5,), (1700000000123.4567,), (math.nan,), (1e300,)], "v double").select(
        F.unix_micros(fractional_epoch_ms_expr("v"))
    ).collect()
    assert [row[0] for row in rows] == [1500, 1700000000123457, None, None]


def test_iso_text_and_bucket(spark):
    times = [datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 120), None]
    rows = spark.createDataFrame([(t,) for t in times], "t timestamp").select(
        iso_text_expr("t").alias("iso"), hour_bucket_expr("t").alias("hour")
    ).collect()
    assert [row.iso for row in rows] == ["2024-01-02T03:04:05Z", "2024-01-02T03:04:05.000120Z", None]
    assert rows[0].hour == datetime(2024, 1, 2, 3)


def test_hash_key_and_point(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("a", "b", None)], "x string, y string, lat double")
    rows = df.select(hash_key_expr(["x", "y"]).alias("k"), geo_point_expr("lat", "lat").alias("p")).collect()
    assert rows[0].k == hashlib.sha256(b"a|__null__").hexdigest()
    assert rows[1].k == hashlib.sha256(b"a|b").hexdigest()
    assert (rows[0].p.lat, rows[0].p.lon) == (1.0, 1.0) and rows[1].p is None


def test_text_with_a_suffix_is_no_number(spark):
    texts = ['"3.2d"', '"5f"', '"7F "', '"1e3D"', '"3.2"', '" 4 "', "5.5", "true", '"nan"', '"inf"', "null"]
    leaf = F.parse_json("value")
    rows = spark.createDataFrame([(t,) for t in texts], "value string").select(
        to_float_expr(leaf).alias("d"), to_int_expr(leaf).alias("i")
    ).collect()
    assert [r.d for r in rows[:8]] == [None, None, None, None, 3.2, 4.0, 5.5, 1.0]
    assert math.isnan(rows[8].d) and math.isinf(rows[9].d) and rows[10].d is None
    assert [r.i for r in rows[:7]] == [None, None, None, None, None, 4, 5]
