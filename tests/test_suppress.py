import os
import random
import subprocess
import sys
from datetime import timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quakeframe.operators import suppress
from quakeframe.operators.suppress import suppress_recent
from quakeframe.streaming.suppress import OrderedSuppression
from tests.helpers import T0, at


def plain_rule(rows, ttl):
    """Sequential rule over (key, seconds)."""
    kept, last = set(), {}
    for key, second in sorted(set(rows), key=lambda row: row[1]):
        if key not in last or second - last[key] > ttl:
            kept.add((key, second))
            last[key] = second
    return kept


def frame(spark, rows):
    return spark.createDataFrame([(k, at(s), i) for i, (k, s) in enumerate(rows)], "event_id string, observed_at timestamp, n int")


def run(spark, rows, ttl, **options):
    kept = suppress_recent(frame(spark, rows), ttl_seconds=ttl, order=("n",), **options).collect()
    pairs = [(row.event_id, (row.observed_at - T0) / timedelta(seconds=1)) for row in kept]
    assert len(pairs) == len(set(pairs))
    return set(pairs), kept


def test_gap_equal_to_the_ttl_is_a_duplicate(spark):
    rows = [("a", s) for s in (0, 1800, 3600, 3601, 7300)]
    assert run(spark, rows, 3600)[0] == {("a", 0), ("a", 3601), ("a", 7300)}


def test_first_of_equal_times_is_kept(spark):
    _, kept = run(spark, [("a", 5), ("a", 5), ("b", 5), ("a", 5)], 10)
    assert sorted((row.event_id, row.n) for row in kept) == [("a", 0), ("b", 2)]


def test_zero_ttl_only_drops_equal_times(spark):
    assert run(spark, [("a", 1), ("a", 1), ("a", 2)], 0)[0] == {("a", 1), ("a", 2)}
    with pytest.raises(ValueError):
        run(spark, [("a", 1)], -1)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(-500, 500)), min_size=1, max_size=80), st.integers(1, 90))
def test_ranges_follow_the_plain_rule(spark, rows, ttl):
    assert run(spark, rows, ttl)[0] == plain_rule(rows, ttl)


@pytest.mark.parametrize(
    "ttl, span, step, leaf",
    [(3600, 40_000, 60, 50), (60, 50_000, 1, 7), (1800, 400_000, 60, 1000), (61, 30_000, 1, 3), (30_000, 30_000, 1, 20)],
)
def test_pieces_follow_the_plain_rule(spark, monkeypatch, ttl, span, step, leaf):
    """Frequent keys over many ranges and pieces, next to rare keys."""
    monkeypatch.setattr(suppress, "LEAF_ROWS", leaf)
    rng = random.Random(ttl)
    rows = [("hot", rng.randrange(-span // 3, span) // step * step) for _ in range(1500)]
    rows += [("warm", rng.randrange(span)) for _ in range(150)]
    rows += [(f"rare{i}", rng.randrange(span)) for i in range(20) for _ in range(3)]
    assert run(spark, rows, ttl)[0] == plain_rule(rows, ttl)


def test_a_busy_day_of_one_key_is_spread(spark):
    """No piece holds more than its share of a million times of one key on one day."""
    times = spark.range(1_000_000).selectExpr("'k' as _key", "id * 86400 as _us")
    ranged = times.repartitionByRange(16, "_key", "_us").sortWithinPartitions("_key", "_us")
    pieces = ranged.mapInArrow(suppress._chain(3_600_000_000, suppress.LEAF_ROWS), suppress.CHAIN_DDL)
    sizes = [row["count"] for row in pieces.groupBy("_piece").count().collect()]
    assert sum(sizes) == 1_000_000 and len(sizes) >= 20 and max(sizes) <= suppress.LEAF_ROWS
    assert suppress.kept_times(times, 3_600_000_000).count() == 24


@pytest.mark.parametrize(
    "ttl, span, step, leaf",
    [(3600, 40_000, 60, 50), (60, 20_000, 1, 7), (9000, 30_000, 1, 20), (30_000, 30_000, 1, 20), (1800, 400_000, 60, 30)],
)
def test_doubling_follows_the_plain_rule(spark, monkeypatch, ttl, span, step, leaf):
    """Keys whose steps are too many for a walk, next to keys that are walked and rare ones."""
    monkeypatch.setattr(suppress, "LEAF_ROWS", leaf)
    monkeypatch.setattr(suppress, "WALK_STEPS", 60)
    rng = random.Random(span + ttl)
    rows = [(key, rng.randrange(-span // 3, span) // step * step) for key in ("hot", "hotter") for _ in range(900)]
    rows += [("gaps", 5 * span * i + rng.randrange(1000)) for i in range(4) for _ in range(200)]
    rows += [("warm", rng.randrange(span)) for _ in range(60)]
    rows += [(f"rare{i}", rng.randrange(span)) for i in range(20) for _ in range(3)]
    doubled = []
    plain = suppress._doubled
    monkeypatch.setattr(suppress, "_doubled", lambda *a: doubled.append(1) or plain(*a))
    assert run(spark, rows, ttl)[0] == plain_rule(rows, ttl)
    assert doubled


def test_a_million_times_in_one_time_to_live_are_spread(spark, monkeypatch):
    """No task links or marks more than its share of a key that no walk may read."""
    hour = 3_600_000_000
    # A third of a million in each of three times to live, shifted so that every step leads elsewhere.
    times = spark.range(1_000_000).selectExpr(
        "'k' as _key", f"id % 333334 * 10000 + div(id, 333334) * {hour + 3_000} as _us"
    )
    tables = {}
    write = suppress.materialize

    def kept_table(df, label):
        tables[label] = write(df, label)
        return tables[label]

    monkeypatch.setattr(suppress, "materialize", kept_table)
    found = sorted(row._us for row in suppress.kept_times(times, hour).collect())
    assert found == suppress._chain_from(
        suppress.np.sort(times.toPandas()["_us"].to_numpy()), suppress.NEVER, hour
    )
    shares = [row["count"] for row in tables["asks"].groupBy("_range").count().collect()]
    assert len(shares) >= 4 and max(shares) < 2 * sum(shares) / len(shares)
    pointed = tables["linked"].filter("_to is not null").groupBy("_key", "_to").count()
    assert pointed.agg(F.max("count")).first()[0] <= suppress.LEAF_ROWS


def test_rows_without_a_time_count_as_seen_now(spark):
    df = spark.createDataFrame(
        [("a", None, 1), ("a", None, 2), ("b", at(0), 3), ("b", at(5), 4), ("b", None, 5)],
        "event_id string, observed_at timestamp, n int",
    )
    kept = suppress_recent(df, ttl_seconds=60, order=("n",), now=F.lit(at(3600))).collect()
    assert sorted(row.n for row in kept) == [1, 3, 5]
    assert len(suppress_recent(df, ttl_seconds=60, order=("n",)).collect()) == 3


def test_several_key_columns_and_null_keys(spark):
    df = spark.createDataFrame(
        [("a", "x", at(0)), ("a", "y", at(1)), ("a", "x", at(2)), (None, "x", at(0)), (None, "x", at(1))],
        "event_id string, version string, observed_at timestamp",
    )
    kept = suppress_recent(df, ("event_id", "version"), ttl_seconds=60).collect()
    assert len(kept) == 3
    assert len(suppress_recent(df, ("event_id",), ttl_seconds=60).collect()) == 2


def test_worker_code_does_not_need_the_package():
    """A process that cannot import this package can load what is sent to the workers."""
    shipped = [suppress._chain(1, 1), suppress._summarise(1), suppress._walk(1), suppress._mark(1)]
    loaded = subprocess.run(
        [sys.executable, "-c", "import pickle, sys; pickle.load(sys.stdin.buffer)"],
        input=cloudpickle.dumps([*shipped, OrderedSuppression(1, [])]),
        cwd="/",
        env={name: value for name, value in os.environ.items() if name != "PYTHONPATH"},
        capture_output=True,
    )
    assert loaded.returncode == 0, loaded.stderr.decode()
