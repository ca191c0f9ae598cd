from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from quakeframe.functions.values import to_float_expr, to_int_expr
from quakeframe.operators.flatten import (
    classify_lenient,
    classify_strict,
    flatten_lenient,
    flatten_strict,
    reject_counts,
)
from quakeframe.schemas import FLAT_EVENT_COLUMNS
from quakeframe.session import prepare_session
from tests.helpers import envelope

GOOD = datetime(2023, 11, 14, 22, 13, 20, 123000)
# label, payload, strict (event_id, time, mag, tsunami) or reason, lenient likewise
CASES = [
    ("broken", "{bad", "no_event_id", "not_json"),
    ("cut off", envelope("a")[:-1], "no_event_id", "not_json"),
    ("null", "null", "no_event_id", "no_feature"),
    ("list", "[]", "no_event_id", "no_feature"),
    ("no feature", '{"event_id":"a"}', "no_event_time", "no_feature"),
    ("feature text", '{"event_id":"a","feature":"x"}', "no_event_time", "no_feature"),
    ("no properties", '{"event_id":"a","feature":{"geometry":{}}}', "no_event_time", "no_properties"),
    ("good", envelope("a"), ("a", GOOD, 1.5, None), ("a", GOOD, 1.5, None)),
    ("mag text", envelope("a", {"mag": "3.2"}), ("a", GOOD, None, None), ("a", GOOD, 3.2, None)),
    ("mag junk", envelope("a", {"mag": "x"}), ("a", GOOD, None, None), ("a", GOOD, None, None)),
    ("mag list", envelope("a", {"mag": [1]}), ("a", GOOD, None, None), ("a", GOOD, None, None)),
    ("fraction", envelope("a", {"tsunami": 1.7}), ("a", GOOD, 1.5, None), ("a", GOOD, 1.5, 1)),
    ("int text", envelope("a", {"tsunami": "1"}), ("a", GOOD, 1.5, None), ("a", GOOD, 1.5, 1)),
    ("fraction text", envelope("a", {"tsunami": "1.7"}), ("a", GOOD, 1.5, None), ("a", GOOD, 1.5, None)),
    ("boolean", envelope("a", {"tsunami": True}), ("a", GOOD, 1.5, None), ("a", GOOD, 1.5, 1)),
    ("too large", envelope("a", {"tsunami": 10**12}), ("a", GOOD, 1.5, None), ("a", GOOD, 1.5, None)),
    ("time fraction", envelope("a", {"time": 1.5}), "no_event_time", ("a", datetime(1970, 1, 1, 0, 0, 0, 1500), 1.5, None)),
    ("time float", envelope("a", {"time": 1.7e12}), "no_event_time", ("a", datetime(2023, 11, 14, 22, 13, 20), 1.5, None)),
    ("time text", envelope("a", {"time": "1700000000123"}), "no_event_time", ("a", GOOD, 1.5, None)),
    ("time beyond", envelope("a", {"time": 10**17}), "no_event_time", "no_event_time"),
    ("time missing", envelope("a", {"time": None}), "no_event_time", "no_event_time"),
    ("number id", envelope(5), ("5", GOOD, 1.5, None), "no_event_id"),
    ("blank id", envelope(""), ("", GOOD, 1.5, None), "no_event_id"),
    ("null id", envelope(None), "no_event_id", "no_event_id"),
    ("blast", envelope("a", {"type": "quarry blast"}), "not_earthquake", "not_earthquake"),
    ("no type", envelope("a", {"type": None}), "not_earthquake", "not_earthquake"),
    ("polygon", envelope("a", None, {"type": "Polygon"}), "not_point", "not_point"),
    ("no geometry", envelope("a", None, None), "not_point", "no_geometry"),
    ("geometry list", envelope("a", None, [1]), "not_point", "no_geometry"),
]


@pytest.fixture(scope="module")
def payloads(spark):
    return spark.createDataFrame([case[:2] for case in CASES], "label string, payload_json string")


@pytest.mark.parametrize("classify, column", [(classify_strict, 2), (classify_lenient, 3)])
def test_edge_rows(payloads, classify, column):
    rows = {row.label: row for row in classify(payloads, keep=("label",)).collect()}
    for case in CASES:
        row, expected = rows[case[0]], case[column]
        if isinstance(expected, str):
            assert row.reject_reason == expected, case[0]
        else:
            assert row.reject_reason is None, case[0]
            assert (row.event_id, row.event_time_utc, row.mag, row.tsunami) == expected, case[0]


@pytest.mark.parametrize("flatten, classify", [(flatten_strict, classify_strict), (flatten_lenient, classify_lenient)])
def test_outcomes_add_up(payloads, flatten, classify):
    outcomes = {row.outcome: row.row_count for row in reject_counts(classify(payloads)).collect()}
    assert sum(outcomes.values()) == len(CASES)
    flat = flatten(payloads)
    assert flat.count() == outcomes["accepted"]
    assert flat.columns == FLAT_EVENT_COLUMNS


@pytest.mark.parametrize("flatten", [flatten_strict, flatten_lenient])
def test_short_coordinates_and_calendar(spark, flatten):
    texts = [
        envelope("one", None, {"type": "Point", "coordinates": [1.0]}),
        envelope("none", None, {"type": "Point"}),
        envelope("text", None, {"type": "Point", "coordinates": "x"}),
        envelope("full"),
    ]
    df = spark.createDataFrame([(text,) for text in texts], "payload_json string")
    rows = {row.event_id: row for row in flatten(df).collect()}
    assert (rows["one"].longitude, rows["one"].latitude, rows["one"].depth_km) == (1.0, None, None)
    assert rows["none"].longitude is None and rows["text"].longitude is None
    full = rows["full"]
    assert (full.longitude, full.latitude, full.depth_km) == (1.0, 2.5, 3.0)
    assert (full.event_date, full.year, full.month, full.day) == (date(2023, 11, 14), 2023, 11, 14)


@pytest.mark.parametrize("flatten", [flatten_strict, flatten_lenient])
def test_good_rows_are_parsed_once(payloads, flatten):
    plan = flatten(payloads)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1
    assert "Python" not in plan


def test_columns_can_be_carried_along(payloads):
    kept = flatten_strict(payloads.withColumn("n", F.lit(1)), keep=("n", "label"))
    assert kept.columns[:2] == ["n", "label"]


def test_long_generated_methods_are_not_run_by_the_interpreter(spark):
    # The JVM compiles no method of more than 8,000 bytes.
    prepare_session(spark)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8_000


def test_suffix_is_looked_for_in_text_only(spark):
    leaves = ['"3.2d"', '" 5F "', "3.25", "1.0E10", "7", '"7"', '"2.5"', "true", "null", '{"a": "5f"}', '["1d"]']
    df = spark.createDataFrame([(at, x) for at, x in enumerate(leaves)], "n int, v string").withColumn("v", F.parse_json("v"))
    got = df.orderBy("n").select(to_float_expr(F.col("v")).alias("f"), to_int_expr(F.col("v")).alias("i")).collect()
    assert [r.f for r in got] == [None, None, 3.25, 1e10, 7.0, 7.0, 2.5, 1.0, None, None, None]
    assert [r.i for r in got] == [None, None, 3, None, 7, 7, None, 1, None, None, None]
