"""The suppression rule of ``operators.suppress`` on a stream."""

from __future__ import annotations

import pickle
import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.storagelevel import StorageLevel

from quakeframe.defaults import SUPPRESS_TTL_SECONDS
from quakeframe.operators.suppress import MEMORY_DDL, NEVER, key_text, remember, suppress_after
from quakeframe.sources.tables import child_names, drop_path, table_exists

STATE_STORE_SETTING = "spark.sql.streaming.stateStore.providerClass"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Batches of one generation; those of the next have higher numbers.
GENERATION = 10**9
# Groups of keys that share a state: Python is called, and its frames are made, for each group and not for each key.
BUCKETS = 4_096
# Most rows that wait in one entry of the state.
PART_ROWS = 2_000
PACKED = T.StructType([T.StructField("packed", T.BinaryType())])
PART_NUMBER = T.StructType([T.StructField("number", T.LongType())])
UNTIMED_US = NEVER
# Why a row was let out without the rule.
MARK = "mark"
LATE, UNTIMED = "late", "untimed"


class OrderedSuppression(StatefulProcessor):
    """Holds the rows of a bucket of keys until the watermark has passed them, and then decides in time order.

    No row that may still come in time is before the watermark, so what is released is final. Rows wait in
    parts that are sorted by time; a release reads those that begin before the watermark and lays what
    is left of them down as new parts, so what waits longer is not touched. A timer on the earliest
    held row releases it; one on the end of the last time to live ends the state. Rows behind the watermark,
    and rows without a time, go out at once with a mark.
    """

    def __init__(self, ttl: int, columns: list[str]) -> None:
        self._ttl = ttl
        self._columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        # Last published time by key; (earliest time, number) of each part; the parts.
        self._last = handle.getValueState("last_published", PACKED)
        self._parts = handle.getValueState("parts", PACKED)
        self._held = handle.getMapState("held", PART_NUMBER, PACKED)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1_000
        parts = self._read(self._parts, [])
        before = min(parts, default=None)
        for chunk in rows:
            times = chunk["seen_us"].to_numpy()
            untimed = times == UNTIMED_US
            late = ~untimed & (times <= passed) if passed > 0 else np.zeros(len(times), dtype=bool)
            for which, mark in ((untimed, UNTIMED), (late, LATE)):
                if which.any():
                    yield self._out(chunk[which], mark)
            self._hold(chunk[~(untimed | late)], parts)
        first = min(parts, default=None)
        self._write(self._parts, parts)
        # There is a timer for what waits already.
        if first is not None and (before is None or first < before):
            self._handle.registerTimer(first[0] // 1_000 + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1_000
        parts, last = self._read(self._parts, []), self._read(self._last, {})
        due = [x for x in parts if x[0] <= passed]
        if due:
            rows = pd.concat([pickle.loads(self._held.getValue((number,))[0]) for _, number in due])
            for _, number in due:
                self._held.removeKey((number,))
            parts = [x for x in parts if x[0] > passed]
            in_time = rows["seen_us"].to_numpy() <= passed
            self._hold(rows[~in_time], parts)
            self._write(self._parts, parts)
            published = self._judge(rows[in_time], last)
            if len(published):
                yield self._out(published, None)
        # Rows to come are behind the watermark, so an ended time to live decides nothing more.
        last = {name: us for name, us in last.items() if us + self._ttl >= passed}
        self._write(self._last, last)
        # One timer is enough: the next release, or else the end of the state.
        if parts:
            self._handle.registerTimer(min(parts)[0] // 1_000 + 1)
        elif last:
            self._handle.registerTimer((max(last.values()) + self._ttl) // 1_000 + 2)

    def _judge(self, rows: pd.DataFrame, last: dict[str, int]) -> pd.DataFrame:
        """The rows to publish; ``last`` follows."""
        ordered = [name for name in rows.columns if name.startswith("seen_order_")]
        rows = rows.sort_values(["seen_key", "seen_us", *ordered, "seen_order"], kind="stable")
        kept = []
        for at, (name, us) in enumerate(zip(rows["seen_key"].tolist(), rows["seen_us"].tolist(), strict=True)):
            if name not in last or us > last[name] + self._ttl:
                last[name] = us
                kept.append(at)
        return rows.iloc[kept]

    def _hold(self, rows: pd.DataFrame, parts: list[tuple[int, int]]) -> None:
        """Lay rows down as parts, and add these to the list."""
        rows = rows.sort_values("seen_us", kind="stable")
        number = max((x[1] for x in parts), default=-1) + 1
        for at in range(0, len(rows), PART_ROWS):
            part = rows.iloc[at : at + PART_ROWS]
            self._held.updateValue((number,), (pickle.dumps(part),))
            parts.append((int(part["seen_us"].iloc[0]), number))
            number += 1

    @staticmethod
    def _read(state, empty):
        packed = state.get()
        return empty if packed is None else pickle.loads(packed[0])

    @staticmethod
    def _write(state, value) -> None:
        if value:
            state.update((pickle.dumps(value),))
        else:
            state.clear()

    def _out(self, rows: pd.DataFrame, mark: str | None) -> pd.DataFrame:
        out = rows[self._columns].copy()
        out[MARK] = pd.Series([mark] * len(out), index=out.index, dtype="object")
        return out

    def close(self) -> None:
        pass


def use_state_store(spark: SparkSession) -> None:
    """Set the state store that keyed processors need."""
    if spark.conf.get(STATE_STORE_SETTING, None) != STATE_STORE:
        spark.conf.set(STATE_STORE_SETTING, STATE_STORE)


def suppress_recent_stream(
    stream: DataFrame,
    key: Sequence[str] = ("event_id",),
    time: str = "observed_at",
    ttl_seconds: float = SUPPRESS_TTL_SECONDS,
    order: Sequence[str] = (),
    late_seconds: float = 0,
    beat: str | None = None,
    now: Column | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Rows to publish, equal to the batch form for rows in any order, and all that it could not judge.

    Rows wait until the watermark, ``late_seconds`` behind the newest row, has passed them; then they
    are judged in time order, and of rows equal in key and time the first by ``order`` counts. Every
    other row comes out with a reason in the column ``mark``: ``late`` where it came behind the
    watermark (by ``late_seconds`` or more), ``untimed`` where it has no time and ``now``, which stands for one,
    is not given. Published rows have no mark, so whoever publishes filters on that.

    Rows with true in the column ``beat`` move the watermark and are nothing else: a source that
    falls silent sends them to let out what still waits.

    The state of a key is the rows that wait, as many as come within ``late_seconds``, and one time, which ends
    with its time to live. Keys are dealt into ``buckets``, each with one state, and a task holds the rows
    of one bucket that become due at once; a checkpoint keeps the number it began with. Limit the size of a
    micro-batch at the source. Column names must not begin with an underscore, which row tuples do not allow.
    """
    use_state_store(stream.sparkSession)
    if MARK in stream.columns:
        raise ValueError(f"the stream must not have a column {MARK}")
    processor = OrderedSuppression(round(ttl_seconds * 1_000_000), stream.columns)
    # The column that the watermark is on ends before the stateful operator, for which Spark would
    # drop late rows if it saw it.
    timed = stream.withColumn("seen_at", F.coalesce(time, now) if now is not None else F.col(time))
    timed = timed.withWatermark("seen_at", f"{round(late_seconds * 1_000)} milliseconds")
    if beat is not None:
        # On the time as well, so that the filter is not pushed below the watermark.
        timed = timed.filter(~F.coalesce(F.col(beat), F.lit(False)) | (F.col("seen_at") < F.lit("0001-01-01")))
    keyed = timed.select(
        *stream.columns,
        key_text(key).alias("seen_key"),
        F.pmod(F.xxhash64(key_text(key)), F.lit(buckets)).alias("seen_bucket"),
        F.coalesce(F.unix_micros("seen_at"), F.lit(UNTIMED_US)).alias("seen_us"),
        *[F.col(name).alias(f"seen_order_{at}") for at, name in enumerate(order)],
        F.xxhash64(*stream.columns).alias("seen_order"),
    )
    return keyed.groupBy("seen_bucket").transformWithStateInPandas(
        processor,
        outputStructType=T.StructType([*stream.schema.fields, T.StructField(MARK, T.StringType())]),
        outputMode="Append",
        timeMode="EventTime",
    )


def suppressing_writer(
    publish: Callable[[DataFrame, int], None],
    memory_path: str,
    key: Sequence[str] = ("event_id",),
    time: str = "observed_at",
    ttl_seconds: float = SUPPRESS_TTL_SECONDS,
    order: Sequence[str] = (),
    generation: int = 0,
) -> Callable[[DataFrame, int], None]:
    """The same rule as a ``foreachBatch`` function, for streams with very frequent keys.

    The batch form does the work, so rows stay in the JVM and one key is spread over many
    tasks. What was published last is a small table, rewritten per batch: a repeated batch
    starts from the table of the batch before it. ``publish`` gets the rows and the batch id
    and must replace its own output when a batch is repeated. Raise ``generation`` when the
    stream starts over with a new checkpoint; its first batch then goes on from what the last
    generation remembered.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch_id = generation * GENERATION + number
        memory = read_memory(batch.sparkSession, memory_path, batch_id)
        # One micro-batch, kept on memory and disk since the rule reads it more than once.
        seen = batch.persist(StorageLevel.MEMORY_AND_DISK)
        passed = suppress_after(seen, memory, key, time, ttl_seconds, order)
        passed = passed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            publish(passed, number)
            remember(memory, passed, key, time, ttl_seconds).write.mode("overwrite").parquet(
                f"{memory_path}/batch_id={batch_id}"
            )
        finally:
            passed.unpersist()
            seen.unpersist()
        for older in stored_batches(batch.sparkSession, memory_path, batch_id)[1:]:
            drop_path(batch.sparkSession, f"{memory_path}/batch_id={older}")

    return write


def stored_batches(spark: SparkSession, memory_path: str, before: int) -> list[int]:
    """Complete tables of batches before one, newest first; two at most in the normal course."""
    numbers = [int(x.split("=")[1]) for x in child_names(spark, memory_path) if x.startswith("batch_id=")]
    complete = [n for n in numbers if n < before and table_exists(spark, f"{memory_path}/batch_id={n}/_SUCCESS")]
    return sorted(complete, reverse=True)


def read_memory(spark: SparkSession, memory_path: str, before: int) -> DataFrame:
    """Last published times after the newest batch before one; empty before the first."""
    stored = stored_batches(spark, memory_path, before)
    if not stored:
        return spark.createDataFrame([], MEMORY_DDL)
    return spark.read.schema(MEMORY_DDL).parquet(f"{memory_path}/batch_id={stored[0]}")


# Send what runs in Python workers by value, so that they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
