from datetime import date

import pytest
from pyspark.sql import functions as F

from quakeframe.operators.dedup import first_across_chunks, unique_features
from quakeframe.operators.metrics import chunk_metrics, run_metrics
from tests.helpers import at, keys

D1, D2 = date(2024, 1, 1), date(2024, 1, 8)
# window, id, position, content
ROWS = [
    (D1, "a", 0, "a0"), (D1, "b", 1, "b1"), (D1, "a", 2, "a2"),
    (D2, "b", 0, "b0"), (D2, "c", 1, "c1"), (D2, "c", 2, "c2"), (D2, "a", 3, "a3"),
]


@pytest.fixture(scope="module")
def fetched(spark):
    return spark.createDataFrame(ROWS, "chunk_start date, event_id string, position int, body string").withColumn(
        "chunk_end", F.date_add("chunk_start", 6)
    )


def test_last_copy_at_the_first_position(fetched):
    got = keys(unique_features(fetched, ["chunk_start"]), "chunk_start", "position", "event_id", "body")
    assert got == [
        (D1, 0, "a", "a2"), (D1, 1, "b", "b1"), (D2, 0, "b", "b0"), (D2, 1, "c", "c2"), (D2, 3, "a", "a3"),
    ]


def test_first_copy(fetched):
    got = keys(unique_features(fetched, ["chunk_start"], keep="first"), "chunk_start", "event_id", "body")
    assert got[0] == (D1, "a", "a0") and (D2, "c", "c1") in got
    with pytest.raises(ValueError):
        unique_features(fetched, ["chunk_start"], keep="any")


def test_across_chunks(fetched):
    after_last = first_across_chunks(unique_features(fetched, ["chunk_start"]))
    assert keys(after_last, "event_id", "body") == [("a", "a2"), ("b", "b1"), ("c", "c2")]
    assert keys(first_across_chunks(fetched), "event_id", "body") == [("a", "a0"), ("b", "b1"), ("c", "c1")]


def test_counts_of_windows_and_runs(fetched):
    counts = ["fetched_count", "unique_count", "published_count", "duplicate_count"]
    chunks = chunk_metrics(fetched)
    assert keys(chunks, "chunk_start", *counts) == [(D1, 3, 2, 2, 1), (D2, 4, 3, 1, 3)]
    run = run_metrics(chunks.withColumn("mode", F.lit("backfill")), ["mode"])
    assert keys(run, "mode", "chunk_count", *counts) == [("backfill", 2, 7, 5, 3, 4)]


def test_counts_with_suppression(spark):
    rows = [(0, "a"), (0, "a"), (60, "a"), (60, "b"), (4000, "a")]
    fetched = spark.createDataFrame([(at(s), key) for s, key in rows], "observed_at timestamp, event_id string")
    fetched = fetched.withColumns({"chunk_start": F.col("observed_at"), "chunk_end": F.col("observed_at")})
    chunks = chunk_metrics(fetched, across_chunks=False, ttl_seconds=3600)
    assert keys(chunks, "chunk_start", "fetched_count", "unique_count", "published_count", "duplicate_count") == [
        (at(0), 2, 1, 1, 1), (at(60), 2, 2, 1, 1), (at(4000), 1, 1, 1, 0),
    ]
