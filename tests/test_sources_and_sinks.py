import json
import random
from datetime import date, datetime

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quakeframe.operators.documents import REQUEST_DDL, bulk_requests, request_starts
from quakeframe.operators.envelope import build_event_envelope, decode_envelope, encode_envelope
from quakeframe.plans.backfill import run_backfill
from quakeframe.plans.rebuild import open_facts, rebuild_latest, refresh_hourly, sync_latest
from quakeframe.schemas import FLAT_EVENT_DDL
from quakeframe.session import scratch_path, shared_dir
from quakeframe.sinks import runs
from quakeframe.sinks.messages import write_bulk_requests
from quakeframe.sinks.runs import append_run, compact_runs, read_runs, run_folder
from quakeframe.sinks.tables import write_partitioned
from quakeframe.sources.landed import explode_features, parse_feature_collection, payload_rows
from quakeframe.sources.tables import MAX_IN_LIST, child_names, key_scan, table_scan_if_exists
from quakeframe.sources.windows import bounded_windows, catalog_range, chunk_date_range, read_window, with_chunk
from tests.helpers import at, flat_frame, keys


def feature(event_id, ms, mag=1.0, **properties):
    values = {"mag": mag, "time": ms, "type": "earthquake", "place": "1 km of Foo, CA", **properties}
    point = {"type": "Point", "coordinates": [1.0, 2.0, 3.0]}
    return {"type": "Feature", "id": event_id, "properties": values, "geometry": point}


def collection(*features, url="u"):
    return {"type": "FeatureCollection", "metadata": {"url": url}, "features": list(features)}


def test_windows(spark):
    got = keys(chunk_date_range(spark, date(2026, 1, 1), date(2026, 1, 31), 10), "chunk_start", "chunk_end")
    assert [(a.day, b.day) for a, b in got] == [(1, 10), (11, 20), (21, 30), (31, 31)]
    for start, end, days in ((date(2026, 1, 2), date(2026, 1, 1), 5), (date(2026, 1, 1), date(2026, 1, 2), 0)):
        with pytest.raises(ValueError):
            chunk_date_range(spark, start, end, days)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dates(date(1999, 1, 1), date(2001, 1, 1)), st.integers(0, 200), st.integers(1, 60))
def test_windows_cover_the_range_once(spark, start, length, days):
    end = date.fromordinal(start.toordinal() + length)
    windows = keys(chunk_date_range(spark, start, end, days), "chunk_start", "chunk_end")
    covered = [d for a, b in windows for d in range(a.toordinal(), b.toordinal() + 1)]
    assert covered == list(range(start.toordinal(), end.toordinal() + 1))
    days_df = spark.createDataFrame([(date.fromordinal(d),) for d in covered], "day date")
    tagged = with_chunk(days_df, "day", F.lit(start), F.lit(end), days)
    assert set(keys(tagged, "chunk_start", "chunk_end")) == set(windows)


def test_days_outside_of_a_run_have_no_window(spark):
    days = [date(2023, 12, 30), date(2024, 1, 1), date(2024, 1, 31), date(2024, 2, 20), None]
    df = spark.createDataFrame([(d,) for d in days], "day date")
    rows = with_chunk(df, "day", F.lit(date(2024, 1, 1)), F.lit(date(2024, 1, 31)), 7).collect()
    assert [(r.chunk_start, r.chunk_end) for r in rows] == [
        (None, None), (date(2024, 1, 1), date(2024, 1, 7)), (date(2024, 1, 29), date(2024, 1, 31)), (None, None), (None, None),
    ]


def test_catalog_range_tells_when_it_was_cut(spark):
    flat = flat_frame(spark, [(f"e{i}", 1, 86_400 + i, float(i)) for i in range(10)] + [("out", 1, 5, 0.0)])
    whole = catalog_range(flat, date(2024, 1, 2), date(2024, 1, 2)).collect()
    assert [row.event_id for row in whole] == [f"e{i}" for i in range(10)] and not whole[0].range_truncated
    cut = catalog_range(flat, date(2024, 1, 2), date(2024, 1, 2), limit=4).collect()
    assert [row.event_id for row in cut] == ["e0", "e1", "e2", "e3"] and all(row.range_truncated for row in cut)


def test_key_scan(spark):
    df = spark.createDataFrame([(f"e{i}", i) for i in range(2 * MAX_IN_LIST)], "event_id string, n int")
    assert key_scan(df, None).count() == 2 * MAX_IN_LIST
    assert key_scan(df, []).count() == key_scan(df, df.limit(0)).count() == 0
    assert keys(key_scan(df, ["e3", "e3", "none"]), "n") == [(3,)]
    many = [f"e{i}" for i in range(MAX_IN_LIST + 5)]
    assert key_scan(df, many).count() == len(many)
    assert key_scan(df, df.filter("n < 7")).count() == 7


def test_collections_and_envelopes(spark):
    text = json.dumps(collection(feature("a", 0, extra={"deep": [1]}), feature("b", 1)))
    parsed = parse_feature_collection(spark.createDataFrame([(1, text)], "doc int, value string"))
    rows = explode_features(parsed)
    assert keys(rows, "doc", "position", "event_id", "source_url") == [(1, 0, "a", "u"), (1, 1, "b", "u")]
    envelopes = build_event_envelope(
        rows.filter("event_id = 'a'"), "feed", "backfill", "topic", F.lit(datetime(2024, 1, 1, 0, 0, 1)),
        date(2024, 1, 1), date(2024, 1, 2),
    )
    message = encode_envelope(envelopes).first()
    body = json.loads(message.value)
    assert message.key == body["event_id"] == "a"
    assert body["feature"]["properties"]["extra"] == {"deep": [1]}
    assert (body["ingest_time_utc"], body["request_window_end"]) == ("2024-01-01T00:00:01Z", "2024-01-02")
    unbounded = encode_envelope(build_event_envelope(rows, "feed", "realtime", "topic")).first()
    assert json.loads(unbounded.value)["request_window_start"] is None
    decoded = decode_envelope(spark.createDataFrame([(message.value.encode(),), (b"{",)], "value binary"))
    assert [row.envelope is not None for row in decoded.collect()] == [True, False]
    with pytest.raises(ValueError):
        build_event_envelope(rows, "feed", "other", "topic")


def test_payload_lines(spark, tmp_path):
    (tmp_path / "p.txt").write_text('{"a":1}\n{bad\n')
    assert keys(payload_rows(spark, str(tmp_path)), "payload_json") == [('{"a":1}',), ("{bad",)]


def test_runs_replace_themselves(spark, tmp_path):
    path = str(tmp_path / "facts")
    one = flat_frame(spark, [("a", 1, 1, 1.0), ("b", 1, 90_000, 2.0)])
    two = flat_frame(spark, [("a", 2, 1, 3.0)])
    assert append_run(one, path, "r1") == 2
    assert append_run(two, path, "r2") == 1
    assert append_run(one, path, "r1") == 2
    assert append_run(one.limit(0), path, "r3") == 0
    assert keys(read_runs(spark, path), "event_id", "mag", "run_id") == [
        ("a", 1.0, "r1"), ("a", 3.0, "r2"), ("b", 2.0, "r1"),
    ]


def test_a_repeated_run_may_move_its_rows_to_other_days(spark, tmp_path):
    path = str(tmp_path / "facts")
    append_run(flat_frame(spark, [("a", 5, 1, 1.0), ("b", 5, 2, 1.0), ("c", 6, 3, 1.0)]), path, "r/1")
    append_run(flat_frame(spark, [("a", 6, 400_000, 2.0), ("b", 6, 3, 1.0)]), path, "r/1")
    append_run(flat_frame(spark, [("z", 1, 4, 1.0)]), path)
    assert keys(read_runs(spark, path), "event_id", "mag") == [("a", 2.0), ("b", 1.0), ("z", 1.0)]


ANY_TEXT = ["Jan run", "a+b", "é", "x&y", "", "a/b", "..", "%2F", "a=b", "'", "\\", "\n", "_x", "x" * 3_000]


def test_a_run_id_may_be_any_text(spark, tmp_path):
    path = str(tmp_path / "facts")
    every = "".join(chr(i) for i in range(32, 127))
    rows = flat_frame(spark, [("a", 5, 1, 1.0)])
    for _ in range(2):
        for run_id in [*ANY_TEXT, every]:
            append_run(rows, path, run_id)
    assert sorted(r.run_id for r in read_runs(spark, path).collect()) == sorted([*ANY_TEXT, every])


class Crash(Exception):
    pass


def crash(*_):
    raise Crash


@pytest.mark.parametrize(("step", "seen"), [("write_partitioned", "old"), ("rename_path", "old"), ("drop_path", "new")])
def test_readers_see_a_run_before_or_after(spark, tmp_path, monkeypatch, step, seen):
    path = str(tmp_path / "facts")
    old, new = flat_frame(spark, [("a", 5, 1, 1.0), ("b", 5, 90_000, 2.0)]), flat_frame(spark, [("c", 5, 1, 3.0)])
    append_run(old, path, "kept")
    append_run(old, path, "again")
    with monkeypatch.context() as broken:
        broken.setattr(runs, step, crash)
        with pytest.raises(Crash):
            append_run(new, path, "again")
    assert read_runs(spark, path).count() == (4 if seen == "old" else 3)
    append_run(new, path, "again")
    assert keys(read_runs(spark, path), "event_id", "run_id") == [("a", "kept"), ("b", "kept"), ("c", "again")]
    assert len(child_names(spark, run_folder(path, "again"))) == 1


def test_a_run_may_read_what_it_replaces(spark, tmp_path):
    path = str(tmp_path / "facts")
    append_run(flat_frame(spark, [("a", 5, 1, 1.0), ("b", 5, 2, 1.0)]), path, "r")
    append_run(read_runs(spark, path).filter("event_id = 'a'").drop("run_id"), path, "r")
    assert keys(read_runs(spark, path), "event_id") == [("a",)]
    append_run(flat_frame(spark, [("a", 5, 1, 1.0)]).limit(0), path, "r")
    assert read_runs(spark, path).count() == 0


def files_below(folder):
    return [f for f in folder.rglob("*.parquet") if "_runs" not in f.parts]


def test_compactions_bound_folders_and_replays_add_nothing(spark, tmp_path):
    path = str(tmp_path / "facts")
    batches = [flat_frame(spark, [(f"e{i}", 5, 1, 1.0), (f"f{i}", 5, 90_000 * (i % 3), 2.0)]).coalesce(1) for i in range(24)]
    for i, batch in enumerate(batches):
        append_run(batch, path, f"stream-{i}")
        if i % 2 == 1:
            compact_runs(spark, path)
    want = sorted((e, f"stream-{i}") for i in range(24) for e in (f"e{i}", f"f{i}"))
    assert keys(read_runs(spark, path), "event_id", "run_id") == want
    # Twelve compactions are two folds, of eight and four; three days in each.
    assert sorted(x.name for x in (tmp_path / "facts").iterdir()) == ["fold=0-7", "fold=8-11"]
    assert len(files_below(tmp_path / "facts")) <= 6
    for i in (0, 13, 23):
        append_run(batches[i], path, f"stream-{i}")
        assert keys(read_runs(spark, path), "event_id", "run_id") == want
    append_run(batches[1].filter("event_id = 'e1'"), path, "stream-1")
    want.remove(("f1", "stream-1"))
    assert keys(read_runs(spark, path), "event_id", "run_id") == want
    compact_runs(spark, path)
    assert keys(read_runs(spark, path), "event_id", "run_id") == want
    for _ in range(3):
        append_run(flat_frame(spark, [("z", 5, 1, 1.0)]), path, "last")
        compact_runs(spark, path)
    assert keys(read_runs(spark, path), "event_id", "run_id") == sorted([*want, ("z", "last")])
    assert compact_runs(spark, path) == 0


@pytest.mark.parametrize("step", ["write_partitioned", "rename_path", "drop_path"])
def test_compaction_and_replacement_survive_a_crash(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "facts")
    rows = flat_frame(spark, [("a", 5, 1, 1.0), ("b", 5, 90_000, 2.0)])
    append_run(rows, path, "one")
    compact_runs(spark, path)
    append_run(rows, path, "two")
    want = [(e, r) for e in "ab" for r in ("one", "two")]
    with monkeypatch.context() as broken:
        broken.setattr(runs, step, crash)
        with pytest.raises(Crash):
            compact_runs(spark, path)
    assert keys(read_runs(spark, path), "event_id", "run_id") == want
    # A replay after the crash, before anything is cleaned.
    append_run(rows, path, "two")
    assert keys(read_runs(spark, path), "event_id", "run_id") == want
    compact_runs(spark, path)
    assert keys(read_runs(spark, path), "event_id", "run_id") == want
    append_run(rows, path, "three")
    runs.replace_runs(rows.filter("event_id = 'a'"), path, "whole")
    assert keys(read_runs(spark, path), "event_id", "run_id") == [("a", "whole")]
    assert [x.name.split("=")[0] for x in (tmp_path / "facts").iterdir()] == ["fold"]


def test_partition_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "facts")
    write_partitioned(flat_frame(spark, [("a", 1, 1, 1.0), ("b", 1, 90_000, 2.0)]), path)
    plan = spark.read.schema(FLAT_EVENT_DDL).parquet(path).filter("day = 2 and mag > 1").select("event_id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in text and "GreaterThan(mag,1.0)" in text
    assert "ReadSchema: struct<event_id:string,mag:double>" in text


def test_empty_writes_count_as_missing(spark, tmp_path):
    path = str(tmp_path / "facts")
    assert table_scan_if_exists(spark, path) is None
    append_run(flat_frame(spark, [("a", 1, 1, 1.0)]).limit(0), path, "r")
    assert open_facts(spark, path) is None
    assert rebuild_latest(spark, path, str(tmp_path / "latest")) is None
    assert refresh_hourly(spark, str(tmp_path / "no"), str(tmp_path / "h"), str(tmp_path / "b")) is None
    assert sync_latest(spark, str(tmp_path / "no"), str(tmp_path / "b")) is False


def test_backfill_to_served_documents(spark, tmp_path):
    day = 86_400_000
    landed, facts = tmp_path / "landed", str(tmp_path / "facts")
    landed.mkdir()
    start = 1_704_067_200_000  # 2024-01-01
    (landed / "1.json").write_text(json.dumps(collection(
        feature("a", start + 5, 1.0), feature("a", start + 5, 2.0), feature("b", start + 9 * day), feature("late", start + 40 * day),
    ), indent=1))
    (landed / "2.json").write_text(json.dumps(collection(
        feature("a", start + 20 * day, 9.0), feature("q", start, type="quarry blast"), feature("c", start + day, "4.5"),
    )))
    run = dict(start=date(2024, 1, 1), end=date(2024, 1, 31), window_days=10)
    assert run_backfill(spark, str(landed), facts, run_id="january", **run) == 3
    assert run_backfill(spark, str(landed), facts, run_id="january", **run) == 3
    assert keys(read_runs(spark, facts), "event_id", "mag") == [("a", 1.0), ("b", 1.0), ("c", None)]
    assert run_backfill(spark, str(landed), facts, **run) == 3
    assert read_runs(spark, facts).count() == 6
    assert run_backfill(spark, str(landed), facts, mode="overwrite", **run) == 3
    latest, stats, bulk = (str(tmp_path / name) for name in ("latest", "hourly", "bulk"))
    assert rebuild_latest(spark, facts, latest) == 3
    assert refresh_hourly(spark, latest, stats, bulk) == 3
    assert sync_latest(spark, latest, bulk, ["a", "c"]) is True
    assert spark.read.text(bulk).count() == 4
    with pytest.raises(ValueError):
        run_backfill(spark, str(landed), facts, mode="replace", **run)


class FakeSession:
    """As much of a session as the choice of the shared folder looks at."""

    def __init__(self, setting, master):
        self.conf = self.sparkContext = self
        self.setting, self.master, self.folder = setting, master, None

    def get(self, name, default):
        return self.setting

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_scratch_folder_comes_from_the_session(spark):
    assert scratch_path(FakeSession("hdfs://x/shared/", "yarn"), "t").startswith("hdfs://x/shared/t-")
    local = FakeSession(None, "local[8]")
    assert shared_dir(local) == shared_dir(local) == local.folder
    with pytest.raises(RuntimeError):
        shared_dir(FakeSession(None, "yarn"))
    assert scratch_path(spark, "t") != scratch_path(spark, "t")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=1, max_size=60), st.integers(1, 7), st.integers(60, 130))
def test_requests_are_bounded(sizes, max_rows, max_bytes):
    starts = request_starts(np.array(sizes), max_rows, max_bytes)
    assert starts[0]
    parts = np.split(np.array(sizes), np.flatnonzero(starts)[1:])
    assert all(len(p) <= max_rows and p.sum() <= max_bytes for p in parts)
    # Not many more than are needed.
    assert len(parts) <= 1 + 4 * sum(sizes) // max_bytes + len(sizes) // max_rows + 2 * sum(s > max_bytes // 2 for s in sizes)


def test_requests_hold_all_documents(spark, tmp_path):
    rows = [(f"d{i}", f'{{"index":"{i}"}}', "é" * (i % 50)) for i in range(5_000)]
    documents = spark.createDataFrame(rows, "document_id string, action_line string, document_line string").repartition(2)
    path = str(tmp_path / "requests")
    write_bulk_requests(documents, path, 40, 2_000)
    got = spark.read.schema(REQUEST_DDL).json(path).collect()
    assert all(r.document_count <= 40 and r.byte_count == len(r.body.encode()) <= 2_000 and r.body.endswith("\n") for r in got)
    lines = [x for r in got for x in r.body[:-1].split("\n")]
    assert sorted(zip(lines[::2], lines[1::2])) == sorted((a, d) for _, a, d in rows)
    assert len([x for x in (tmp_path / "requests").iterdir() if x.name.endswith(".json")]) == 2 and len(got) > 100
    with pytest.raises(Exception, match="longer than a request"):
        bulk_requests(documents, 40, 50).count()
    assert bulk_requests(documents.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [1, 5, 40])
def test_bounded_windows_hold_every_row_once(spark, limit):
    rng = random.Random(limit)
    seconds = [rng.choice([5, 60, 86_399, 86_400, 200_000]) for _ in range(60)] + [rng.randrange(300_000) for _ in range(200)]
    rows = spark.createDataFrame([(i, at(s)) for i, s in enumerate(seconds)] + [(-1, None), (-2, at(9e6))], "n int, event_time_utc timestamp")
    found = bounded_windows(rows, date(2024, 1, 1), date(2024, 1, 4), limit).orderBy("window_start").collect()
    assert sum(r.row_count for r in found) == len(seconds)
    assert all(a.window_end < b.window_start for a, b in zip(found, found[1:]))
    for r in found:
        assert r.row_count == sum(r.window_start <= at(s) <= r.window_end for s in seconds)
        assert r.exceeds == (r.row_count > limit) and (not r.exceeds or r.window_start == r.window_end)
    some = found[len(found) // 2]
    assert read_window(rows, some.window_start, some.window_end).count() == some.row_count
    with pytest.raises(ValueError):
        bounded_windows(rows, date(2024, 1, 1), date(2024, 1, 4), 0)
