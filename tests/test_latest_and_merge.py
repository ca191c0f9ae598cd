import random
from functools import reduce

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quakeframe.operators.latest import build_latest_event_df, dedupe_latest_rows
from quakeframe.operators.merge import merge_counts, merge_in_order, merge_latest
from quakeframe.operators.hourly import build_region_hourly_stats_df
from quakeframe.plans.rebuild import refresh_hourly, refresh_hourly_since, sync_latest
from quakeframe.schemas import HOURLY_DDL
from quakeframe.sinks import snapshot
from quakeframe.sinks.snapshot import changed_ids, compact, read_snapshot, upsert_latest
from tests.helpers import at, flat_frame, keys

QUICK = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def newer(candidate, current):
    """Plain rule of one batch over (updated, event time); a missing update time loses."""
    (cu, ct), (u, t) = candidate, current
    if cu is not None and u is not None and cu != u:
        return cu > u
    if (cu is None) != (u is None):
        return cu is not None
    return ct > t


def replaces(source, target):
    (su, st_), (tu, tt) = source, target
    if tu is None:
        return True
    if su is None:
        return False
    return su > tu or (su == tu and st_ > tt)


# (case, target, source, row the window keeps, row the merge keeps)
CASES = [
    ("newer update", (10, 5), (20, 5), 2, 2),
    ("same update, later event", (10, 5), (10, 6), 2, 2),
    ("full tie", (10, 5), (10, 5), None, 1),
    ("source without update", (10, 5), (None, 9), 1, 1),
    ("both without update", (None, 9), (None, 5), 1, 2),
    ("target without update", (None, 9), (1, 5), 2, 2),
]


@pytest.mark.parametrize("label, target, source, windowed, merged", CASES)
def test_pairs(spark, label, target, source, windowed, merged):
    old = flat_frame(spark, [("a", *target, 1.0), ("only old", 1, 1, 7.0)])
    new = flat_frame(spark, [("a", *source, 2.0), ("only new", 1, 1, 8.0)])
    after = dict(keys(merge_latest(old, new), "event_id", "mag"))
    assert after == {"a": float(merged), "only old": 7.0, "only new": 8.0}
    counts = merge_counts(old, new).first()
    assert (counts.inserted_count, counts.updated_count) == (1, int(merged == 2))
    if windowed is not None:
        latest = dict(keys(build_latest_event_df(old.union(new)), "event_id", "mag"))
        assert latest["a"] == float(windowed)


def test_tied_rows_keep_the_first_arrival(spark):
    rows = flat_frame(spark, [("a", 1, 1, float(i)) for i in range(20)] + [("", 5, 5, 9.0), (None, 5, 5, 9.0)])
    numbered = rows.withColumn("arrival", F.col("mag"))
    assert keys(dedupe_latest_rows(numbered, "arrival"), "event_id", "mag") == [("a", 0.0)]


def test_ties_do_not_depend_on_row_order(spark):
    rows = [("a", 1, 1, float(i)) for i in range(30)]
    kept = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        kept.update(keys(build_latest_event_df(flat_frame(spark, rows).repartition(3)), "event_id", "mag"))
    assert len(kept) == 1


REVISION = st.tuples(
    st.sampled_from("abc"), st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 4)
)


@QUICK
@given(st.lists(REVISION, min_size=1, max_size=25))
def test_one_batch_follows_the_plain_rule(spark, revisions):
    rows = [(key, updated, time, float(i)) for i, (key, updated, time) in enumerate(revisions)]
    expected = {}
    for key, updated, time, number in rows:
        if key not in expected or newer((updated, time), expected[key][0]):
            expected[key] = ((updated, time), number)
    numbered = flat_frame(spark, rows).withColumn("arrival", F.col("mag"))
    got = dict(keys(dedupe_latest_rows(numbered, "arrival"), "event_id", "mag"))
    assert got == {key: number for key, (_, number) in expected.items()}


@QUICK
@given(st.lists(st.dictionaries(st.sampled_from("abc"), st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 3)), min_size=1), min_size=1, max_size=5))
def test_merging_at_once_equals_merging_in_turn(spark, batches):
    expected, rows = {}, []
    for batch, revisions in enumerate(batches):
        for key, times in revisions.items():
            rows.append((key, *times, float(batch)))
            if key not in expected or replaces(times, expected[key][0]):
                expected[key] = (times, float(batch))
    stacked = flat_frame(spark, rows).withColumn("batch_id", F.col("mag").cast("bigint"))
    got = dict(keys(merge_in_order(stacked, "batch_id"), "event_id", "mag"))
    assert got == {key: number for key, (_, number) in expected.items()}


def test_window_batch_and_merge_agree_without_ties(spark):
    rng = random.Random(3)
    rows = [(f"e{rng.randrange(6)}", i, rng.randrange(50), float(i)) for i in range(60)]
    rng.shuffle(rows)
    whole = flat_frame(spark, rows)
    batches = [dedupe_latest_rows(flat_frame(spark, rows[i : i + 20])) for i in (0, 20, 40)]
    merged = reduce(merge_latest, batches)
    expected = keys(build_latest_event_df(whole), "event_id", "mag")
    assert keys(dedupe_latest_rows(whole), "event_id", "mag") == expected
    assert keys(merged, "event_id", "mag") == expected


def test_stored_snapshot_equals_merging_in_turn(spark, tmp_path):
    rng = random.Random(11)
    path, current = str(tmp_path / "snapshot"), None
    for batch in range(6):
        rows = [
            (f"e{k}", rng.choice([None, rng.randrange(9)]), rng.randrange(9), batch * 100.0 + k)
            for k in rng.sample(range(12), 7)
        ]
        source = flat_frame(spark, rows)
        expected_count = 7 if current is None else merge_counts(current, source).first().affected_count
        assert upsert_latest(spark, path, source, batch) == expected_count
        if batch == 3:
            # A repeated batch changes nothing and counts the same.
            assert upsert_latest(spark, path, source, batch) == expected_count
        merged = source if current is None else merge_latest(current, source)
        current = spark.createDataFrame(merged.collect(), merged.schema)
        assert keys(read_snapshot(spark, path), "event_id", "mag") == keys(current, "event_id", "mag")
        if batch in (1, 2, 4):
            compact(spark, path, batch)
            assert keys(read_snapshot(spark, path), "event_id", "mag") == keys(current, "event_id", "mag")
    with pytest.raises(ValueError):
        upsert_latest(spark, path, source, 2)
    assert upsert_latest(spark, str(tmp_path / "other"), source, 0) == 7


def written_buckets(folder, version):
    return sorted(x.name for x in (folder / "base" / f"version={version}").iterdir() if x.name.startswith("bucket="))


def test_a_base_writes_only_buckets_with_changes(spark, tmp_path):
    path, folder = str(tmp_path / "snapshot"), tmp_path / "snapshot"
    ids = [f"e{i}" for i in range(600)]
    upsert_latest(spark, path, flat_frame(spark, [(x, 1, 1, 1.0) for x in ids]), 0)
    assert compact(spark, path, 0) == 64 and len(written_buckets(folder, 0)) == 64
    bucket = dict(spark.createDataFrame([(x,) for x in ids], "event_id string").select("event_id", snapshot.bucket_expr(64)).collect())
    three = sorted(set(bucket.values()))[:3]
    touched = [x for x in ids if bucket[x] in three]
    # Rows that replace nothing touch no bucket.
    upsert_latest(spark, path, flat_frame(spark, [(x, 2 if x in touched else 0, 5, 2.0) for x in ids]), 1)
    assert compact(spark, path, 1) == 3
    assert written_buckets(folder, 1) == sorted(f"bucket={b}" for b in three)
    assert keys(read_snapshot(spark, path), "event_id", "mag") == sorted((x, 2.0 if x in touched else 1.0) for x in ids)
    assert compact(spark, path, 1) == 0
    for number in (2, 3, 4):
        upsert_latest(spark, path, flat_frame(spark, [(touched[0], 3 + number, 5, 3.0 + number)]), number)
        assert compact(spark, path, number) == 1
    # Buckets that only older versions held are gone, others of the same version stay.
    assert len(written_buckets(folder, 0)) == 61 and len(written_buckets(folder, 1)) == 2
    assert sorted(x.name for x in (folder / "base").iterdir()) == [f"version={n}" for n in (0, 1, 3, 4)]
    assert dict(keys(read_snapshot(spark, path), "event_id", "mag"))[touched[0]] == 7.0
    assert read_snapshot(spark, path).count() == 600


@pytest.mark.parametrize("step", ["rename_path", "_clean"])
def test_a_base_that_crashed_is_written_again(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "snapshot")
    upsert_latest(spark, path, flat_frame(spark, [("a", 1, 1, 1.0), ("b", 1, 1, 1.0)]), 0)
    compact(spark, path, 0)
    upsert_latest(spark, path, flat_frame(spark, [("a", 2, 1, 2.0)]), 1)

    def crash(*_):
        raise OSError

    with monkeypatch.context() as broken:
        broken.setattr(snapshot, step, crash)
        with pytest.raises(OSError):
            compact(spark, path, 1)
    assert keys(read_snapshot(spark, path), "event_id", "mag") == [("a", 2.0), ("b", 1.0)]
    compact(spark, path, 1)
    assert keys(read_snapshot(spark, path), "event_id", "mag") == [("a", 2.0), ("b", 1.0)]
    assert not [x for x in (tmp_path / "snapshot" / "base").iterdir() if x.name.startswith("_")]


def test_changes_and_hours_follow_random_batches(spark, tmp_path):
    rng = random.Random(5)
    path, hourly, bulk = (str(tmp_path / n) for n in ("snapshot", "hourly", "bulk"))
    states = []
    for batch in range(6):
        rows = [
            (f"e{k}", rng.choice([None, rng.randrange(9)]), rng.choice([None, 100, 4_000, 90_000, 200_000]), float(rng.randrange(3)))
            for k in rng.sample(range(14), rng.choice([0, 2, 6]) if batch else 10)
        ]
        flat = flat_frame(spark, [r for r in rows if r[2] is not None])
        place = F.concat(F.lit("5 km of "), F.when(F.col("mag") > 0, F.concat("mag", F.lit(", X"))))
        upsert_latest(spark, path, flat.withColumn("place", place), batch)
        if batch == 3:
            compact(spark, path, 2)
        states.append({r.event_id: r for r in read_snapshot(spark, path).collect()})
        if batch == 0:
            refresh_hourly(spark, path, hourly, bulk)
        else:
            done = refresh_hourly_since(spark, path, hourly, bulk, batch - 1)
            assert done["rows"] <= done["groups"]
        want = build_region_hourly_stats_df(read_snapshot(spark, path))
        assert sorted(map(str, spark.read.schema(HOURLY_DDL).parquet(hourly).collect())) == sorted(map(str, want.collect()))
        for since in range(batch):
            differ = sorted(k for k, r in states[batch].items() if states[since].get(k) != r)
            assert keys(changed_ids(spark, path, since), "event_id") == [(k,) for k in differ]
    sync_latest(spark, path, bulk, since=4)
    lines = spark.read.text(bulk).count()
    assert lines == 2 * changed_ids(spark, path, 4).count()
    compact(spark, path, 4)
    compact(spark, path, 5)
    with pytest.raises(ValueError):
        changed_ids(spark, path, 0)


def test_missing_snapshot_is_empty(spark, tmp_path):
    assert read_snapshot(spark, str(tmp_path / "none")).count() == 0


@QUICK
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from([None, 1, 2]), st.sampled_from([None, 5, 6]), st.integers(0, 4)), min_size=1, max_size=14))
def test_one_pass_merge_equals_repeated_merges(spark, rows):
    one_each = {(row[0], row[3]): row for row in rows}.values()
    ddl = "event_id string, updated_time_utc timestamp, event_time_utc timestamp, batch int"
    frame = spark.createDataFrame([(k, at(u), at(t), b) for k, u, t, b in one_each], ddl)
    merged = frame.limit(0)
    for number in sorted({row[3] for row in one_each}):
        merged = merge_latest(merged, frame.filter(F.col("batch") == number))
    columns = ("event_id", "updated_time_utc", "event_time_utc", "batch")
    assert sorted(map(tuple, merge_in_order(frame, "batch").select(*columns).collect()), key=str) == sorted(
        map(tuple, merged.select(*columns).collect()), key=str
    )
