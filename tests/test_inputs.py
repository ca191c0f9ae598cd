"""Queries over inputs that the smallest tables lack."""

from collections import Counter
from datetime import datetime

from registry import queries
from registry.queries import FETCH_SECONDS, QUERIES

EVENTS_DDL = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def events_folder(spark, tmp_path, rows):
    data = [(n, ts, user, "view", 1.0, "{}") for n, ts, user in rows]
    spark.createDataFrame(data, EVENTS_DDL).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    return str(tmp_path)


def test_fetches_are_landed_as_lines_in_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "scratch_path", lambda _, label: f"{tmp_path}/{label}")
    assert QUERIES["route_realtime_stream"](spark, "/root/testdata/sf0.01").count() == 2 * 2_500
    landed = list((tmp_path / "fetched").rglob("part-*"))
    assert {x.suffix for x in landed} == {".txt"}
    files = Counter(x.parent.name for x in landed)
    assert len(files) == len(FETCH_SECONDS) and len(set(files.values())) == 1 and min(files.values()) > 1


def test_live_fetches_count_events_before_the_run(spark, tmp_path):
    # The second revision is of an event one minute earlier, on the day before the run.
    rows = [(5, datetime(2024, 1, 1, 0, 0, 30), 1), (8, datetime(2024, 1, 1, 5), 1), (12, datetime(2024, 1, 9), 2)]
    got = {r["mode"]: r for r in QUERIES["a3_run_metrics"](spark, events_folder(spark, tmp_path, rows)).collect()}
    assert got["backfill"].fetched_count == 2
    assert (got["realtime"].fetched_count, got["realtime"].unique_count, got["realtime"].published_count) == (3, 2, 2)
