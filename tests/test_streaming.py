import json
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from quakeframe.plans.realtime import realtime_writer
from quakeframe.sinks.messages import publish_files
from quakeframe.sinks.runs import read_runs
from quakeframe.sinks.snapshot import read_snapshot
from quakeframe.sources.landed import parse_feature_collection
from quakeframe.sources.messages import file_message_stream
from quakeframe.streaming.consumer import batch_writer, consume
from quakeframe.streaming.suppress import suppress_recent_stream, suppressing_writer
from tests.helpers import GOOD_TIME, T0, at, envelope, keys
from tests.test_suppress import plain_rule


def message(event_id, mag, updated=0):
    text = envelope(event_id, {"mag": mag, "updated": GOOD_TIME + updated})
    return event_id, text


def land(spark, folder, *messages):
    publish_files(spark.createDataFrame(list(messages), "key string, value string").coalesce(1), str(folder))


def test_consumer_survives_restarts_and_repeats(spark, tmp_path):
    inbox, facts, latest, offsets = (str(tmp_path / n) for n in ("inbox", "facts", "latest", "offsets"))
    reports = []

    def drain():
        writer = batch_writer(facts, latest, compact_every=2, on_batch=reports.append)
        stream = file_message_stream(spark, inbox, max_files=1)
        consume(stream, writer, offsets, drain=True).awaitTermination()
        return writer

    land(spark, inbox, message("a", 1.0), message("b", 2.0), ("x", "{bad"))
    drain()
    land(spark, inbox, message("a", 3.0, updated=5), message("b", 9.0, updated=-5))
    land(spark, inbox, message("c", 4.0))
    writer = drain()
    assert [(r.batch_id, r.consumed_count, r.written_count) for r in reports[:1]] == [(0, 3, 2)]
    assert sum(r.consumed_count for r in reports) == 6 and sum(r.affected_count for r in reports) == 4
    assert keys(read_snapshot(spark, latest), "event_id", "mag") == [("a", 3.0), ("b", 2.0), ("c", 4.0)]
    assert read_runs(spark, facts).count() == 5
    # The last batch comes again, as after a crash before its offsets were committed.
    last = reports[-1].batch_id
    rows = [("c", message("c", 4.0)[1])] if reports[-1].written_count == 1 else [message("a", 3.0, 5), message("b", 9.0, -5)]
    writer(spark.createDataFrame(rows, "key string, value string"), last)
    assert read_runs(spark, facts).count() == 5
    assert keys(read_snapshot(spark, latest), "event_id", "mag") == [("a", 3.0), ("b", 2.0), ("c", 4.0)]


def test_of_tied_messages_the_first_to_arrive_stays(spark, tmp_path):
    inbox, facts, latest, offsets = (str(tmp_path / n) for n in ("inbox", "facts", "latest", "offsets"))
    for first in (9.0, 5.0, 7.0):
        # Several in one file, which are read in turn, and several files, one after another.
        land(spark, inbox, *[message(f"e{i}", first + i + j / 10) for j in range(4) for i in range(30)])
    writer = batch_writer(facts, latest)
    consume(file_message_stream(spark, inbox), writer, offsets, drain=True).awaitTermination()
    assert keys(read_snapshot(spark, latest), "event_id", "mag") == sorted((f"e{i}", 9.0 + i) for i in range(30))
    assert "arrival" not in read_runs(spark, facts).columns


def test_counts_of_each_fetch_in_a_micro_batch(spark, tmp_path):
    def document(*ids, title="all"):
        features = [json.loads(envelope(i))["feature"] for i in ids]
        return json.dumps({"type": "FeatureCollection", "metadata": {"title": title, "status": 200, "generated": GOOD_TIME}, "features": features})

    counts, memory = str(tmp_path / "counts"), str(tmp_path / "memory")
    writer = realtime_writer(lambda df, n: df.count(), memory, "feed", topic="t", ttl_seconds=60, counts_path=counts)
    rows = [(document("a", "a", "b"), at(0)), (document("c"), at(0)), (document("a", "d", title="next"), at(30)), (document(), at(50))]
    batch = parse_feature_collection(spark.createDataFrame(rows, "value string, observed_at timestamp"))
    for _ in range(2):
        writer(batch, 0)
    writer(parse_feature_collection(spark.createDataFrame([(document("a"), at(61))], "value string, observed_at timestamp")), 1)
    got = spark.read.parquet(counts).orderBy("observed_at").collect()
    names = ("title", "fetched_count", "unique_count", "published_count", "duplicate_count")
    assert [tuple(r[x] for x in names) for r in got] == [
        ("all", 4, 3, 3, 1), ("next", 2, 2, 1, 1), ("all", 0, 0, 0, 0), ("all", 1, 1, 1, 0),
    ]
    assert all(r.started_at <= r.finished_at and r.source_mode == "realtime" and r.topic == "t" for r in got)
    assert {r.status for r in got} == {200} and all(r.generated_at is not None for r in got)


def test_new_checkpoint_continues_with_the_next_generation(spark, tmp_path):
    facts, latest = str(tmp_path / "facts"), str(tmp_path / "latest")
    first = batch_writer(facts, latest, compact_every=1)
    first(spark.createDataFrame([message("a", 1.0)], "key string, value string"), 0)
    second = batch_writer(facts, latest, generation=1)
    second(spark.createDataFrame([message("a", 2.0, updated=9)], "key string, value string"), 0)
    assert keys(read_snapshot(spark, latest), "event_id", "mag") == [("a", 2.0)]
    assert read_runs(spark, facts).count() == 2


def test_batches_without_good_rows(spark, tmp_path):
    facts, latest, reports = str(tmp_path / "facts"), str(tmp_path / "latest"), []
    writer = batch_writer(facts, latest, compact_every=1, on_batch=reports.append)
    bad = spark.createDataFrame([("x", "{bad")], "key string, value string")
    writer(bad, 0)
    writer(bad, 1)
    writer(spark.createDataFrame([message("a", 1.0)], "key string, value string"), 2)
    writer(bad, 3)
    assert [(r.consumed_count, r.written_count, r.affected_count) for r in reports] == [
        (1, 0, 0), (1, 0, 0), (1, 1, 1), (1, 0, 0),
    ]
    assert keys(read_snapshot(spark, latest), "event_id", "mag") == [("a", 1.0)]


def seen_batches(seed):
    """Three batches in time order, with a frequent key."""
    rng = random.Random(seed)
    rows = sorted(((rng.choice("aaaab"), rng.randrange(9_000)) for _ in range(150)), key=lambda row: row[1])
    return rows, [rows[:50], rows[50:90], rows[90:]]


SEEN = "event_id string, observed_at timestamp, n int"


def pairs(df):
    return sorted((row.event_id, (row.observed_at - T0) / timedelta(seconds=1)) for row in df.collect())


TICKED = f"{SEEN}, tick boolean"


def send(spark, folder, rows, tick=None):
    """Rows (key, second or None, n), and a tick at a second, as one file."""
    data = [(key, None if second is None else at(second), n, False) for key, second, n in rows]
    data += [(None, at(tick), -1, True)] if tick is not None else []
    spark.createDataFrame(data, TICKED).coalesce(1).write.mode("append").parquet(folder)


def drain(spark, inbox, out, offsets, **options):
    stream = spark.readStream.schema(TICKED).option("maxFilesPerTrigger", 1).parquet(inbox)
    (
        suppress_recent_stream(stream, beat="tick", **options)
        .writeStream.trigger(availableNow=True).option("checkpointLocation", offsets)
        .format("parquet").start(out).awaitTermination()
    )
    return spark.read.schema(f"{TICKED}, mark string").parquet(out)


def marked(df, mark):
    return sorted(r.n for r in df.collect() if r.mark == mark)


@pytest.mark.parametrize(("seed", "late"), [(7, 0), (8, 900), (9, 900)])
def test_any_order_gives_the_rule_across_restarts(spark, tmp_path, seed, late):
    inbox, out, offsets = (str(tmp_path / n) for n in ("inbox", "out", "offsets"))
    rng = random.Random(seed)
    rows, _ = seen_batches(seed)
    numbered = [(k, s, i) for i, (k, s) in enumerate(rows)]
    # What arrives when: up to the allowed delay after its own time.
    arrival = sorted(numbered, key=lambda r: r[1] + (rng.random() * (late - 1) if late else 0))
    cuts = [0, 40, 45, 100, len(arrival)]
    for i, j in zip(cuts, cuts[1:]):
        part = arrival[i:j]
        rng.shuffle(part)
        # A row as old as the newest one of an earlier file counts as late if nothing may be late.
        send(spark, inbox, part if late else [r for r in part if i == 0 or r[1] > arrival[i - 1][1]])
        drain(spark, inbox, out, offsets, ttl_seconds=600, order=("n",), late_seconds=late)
    send(spark, inbox, [], tick=50_000)
    got = drain(spark, inbox, out, offsets, ttl_seconds=600, order=("n",), late_seconds=late)
    sent = [(r.event_id, (r.observed_at - T0) / timedelta(seconds=1)) for r in spark.read.parquet(inbox).collect() if not r.tick]
    assert pairs(got.filter("mark is null")) == sorted(plain_rule(sent, 600))
    assert got.filter("mark is not null").isEmpty()


def test_late_and_untimed_rows_come_out_with_a_mark(spark, tmp_path):
    inbox, out, offsets = (str(tmp_path / n) for n in ("inbox", "out", "offsets"))
    send(spark, inbox, [("a", 1_000, 0), ("b", 5_000, 1), ("c", None, 2)])
    drain(spark, inbox, out, offsets, ttl_seconds=600, late_seconds=1_000)
    # Behind the watermark of 4,000; one row in time, and one more that the held row suppresses.
    send(spark, inbox, [("a", 3_999, 3), ("a", 4_000, 4), ("a", 4_001, 5), ("b", 5_300, 6), ("c", None, 7)])
    drain(spark, inbox, out, offsets, ttl_seconds=600, late_seconds=1_000)
    send(spark, inbox, [], tick=90_000)
    got = drain(spark, inbox, out, offsets, ttl_seconds=600, late_seconds=1_000)
    assert marked(got, None) == [0, 1, 5] and marked(got, "late") == [3, 4] and marked(got, "untimed") == [2, 7]


def test_a_missing_time_may_be_the_time_of_reading(spark, tmp_path):
    inbox, out, offsets = (str(tmp_path / n) for n in ("inbox", "out", "offsets"))
    send(spark, inbox, [("a", 100, 0), ("a", None, 1), ("b", None, 2)], tick=90_000)
    got = drain(spark, inbox, out, offsets, ttl_seconds=600, now=F.lit(at(300)))
    assert marked(got, None) == [0, 2] and len(got.collect()) == 2


def test_batch_form_equals_the_rule_with_repeats(spark, tmp_path):
    out, memory = str(tmp_path / "out"), str(tmp_path / "memory")

    def publish(df, batch_id):
        df.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    writer = suppressing_writer(publish, memory, ttl_seconds=600, order=("n",))
    rows, batches = seen_batches(8)
    for number, batch in enumerate(batches):
        data = [(key, at(second), i) for i, (key, second) in enumerate(batch)]
        df = spark.createDataFrame(data, SEEN)
        writer(df, number)
        writer(df, number)
    assert pairs(spark.read.parquet(out)) == sorted(plain_rule(rows, 600))


def test_state_ends_with_the_time_to_live(spark, tmp_path):
    inbox, out, offsets = (str(tmp_path / n) for n in ("inbox", "out", "offsets"))
    batches = [[(f"k{i}", i + 1, i) for i in range(20)], [("late", 5_000, 20)], [("later", 9_000, 21)], [("k3", 9_001, 22)]]
    for batch in batches:
        send(spark, inbox, batch)
        drain(spark, inbox, out, offsets, ttl_seconds=600, order=("n",))
    send(spark, inbox, [], tick=9_100)
    got = drain(spark, inbox, out, offsets, ttl_seconds=600, order=("n",))
    kept = spark.read.format("statestore").option("stateVarName", "last_published").load(offsets).count()
    assert kept <= 3
    assert marked(got, None) == list(range(23))


def test_a_new_checkpoint_goes_on_from_the_memory(spark, tmp_path):
    memory, sizes = str(tmp_path / "memory"), []
    for generation, second in ((0, 0), (1, 30)):
        writer = suppressing_writer(
            lambda df, batch_id: sizes.append(df.count()), memory, ttl_seconds=60, generation=generation
        )
        writer(spark.createDataFrame([("a", at(second), 0)], SEEN), 0)
    assert sizes == [1, 0]


def test_idle_keys_are_forgotten(spark, tmp_path):
    memory = str(tmp_path / "memory")
    writer = suppressing_writer(lambda df, batch_id: df.count(), memory, ttl_seconds=60)
    writer(spark.createDataFrame([("old", at(0), 0)], SEEN), 0)
    writer(spark.createDataFrame([("new", at(100), 0)], SEEN), 1)
    assert [row._key for row in spark.read.parquet(f"{memory}/batch_id=1").collect()] == ["new"]


def test_keys_share_states_whose_parts_stay_in_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("quakeframe.streaming.suppress.PART_ROWS", 3)
    inbox, out, offsets = (str(tmp_path / n) for n in ("inbox", "out", "offsets"))
    options = {"ttl_seconds": 600, "order": ("n",), "late_seconds": 900, "buckets": 2}
    rng = random.Random(3)
    rows = [(f"k{rng.randrange(12)}", rng.randrange(2_000), i) for i in range(120)]
    arrival = sorted(rows, key=lambda r: r[1] + rng.random() * 899)
    for i in range(0, 120, 40):
        send(spark, inbox, arrival[i : i + 40])
    send(spark, inbox, [], tick=2_901)
    got = drain(spark, inbox, out, offsets, **options)
    assert pairs(got) == sorted(plain_rule([r[:2] for r in rows], 600))
    assert 1 <= spark.read.format("statestore").option("stateVarName", "last_published").load(offsets).count() <= 2
