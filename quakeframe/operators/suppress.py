"""Suppressing copies seen again too soon.

A row is kept when its key has no kept row within the time to live before it; a gap equal
to the time to live is still too soon, and dropped rows do not extend it. So each kept
row decides the next one: a chain per key.

All distinct keys and times are sorted over the cluster, in ranges of about equal numbers of
rows. A key that lies inside one range is chained there, reading its times once. A key that
reaches over a border may be any frequent key: its times become pieces of at most
``LEAF_ROWS`` rows. A piece is summarised as a step function from "the chain continues after
time x" to "the chain leaves at time e", which gives every piece its entry once the steps are
composed, and the pieces then mark their kept rows.

Composing takes one of two ways with the same result. Where the steps of a key are at most
``WALK_STEPS``, its summaries are walked in order. Where they are more (very many times inside one
time to live, so that summaries are as long as pieces), each step is a row that knows the step it
leads to, and the steps the chain goes through are found by doubling: after round k the first
2**k of them are known, and every step knows the one 2**k further on. These are joins over rows, so
no task reads the key.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quakeframe.defaults import SUPPRESS_TTL_SECONDS
from quakeframe.session import materialize

# Most rows of a piece.
LEAF_ROWS = 50_000
# Most steps of a key that one task walks through.
WALK_STEPS = 4 * LEAF_ROWS

NEVER = np.iinfo(np.int64).min
CHAIN_DDL = "_key string, _us bigint, _piece bigint"
PIECE_DDL = "_key string, _piece bigint, starts array<bigint>, exits array<bigint>"
ENTRY_DDL = "_key string, _piece bigint, _after bigint"
TIME_DDL = "_key string, _us bigint"
MEMORY_DDL = "_key string, _last bigint"


def key_text(key: Sequence[str]) -> Column:
    """One text per key; null parts count as equal to each other."""
    return F.to_json(F.struct(*key)) if len(key) > 1 else F.coalesce(
        F.col(key[0]).cast("string"), F.lit("\0")
    )


def time_us(time: str, now: Column | None = None) -> Column:
    """Microseconds of a time; a missing one is the time of reading."""
    return F.unix_micros(F.coalesce(F.col(time), F.current_timestamp() if now is None else now))


def suppress_recent(
    df: DataFrame,
    key: Sequence[str] = ("event_id",),
    time: str = "observed_at",
    ttl_seconds: float = SUPPRESS_TTL_SECONDS,
    order: Sequence[str] = (),
    now: Column | None = None,
) -> DataFrame:
    """The rows that would be published; of rows equal in key and time, the first by ``order``.

    A row without a time counts as seen ``now``, by default when the query runs.

    ``df`` is read twice, once for key and time only, and the chains are written to the shared
    folder while this is called. Where ``df`` is costly to compute, pass it through
    ``session.materialize`` first.
    """
    ttl = round(ttl_seconds * 1_000_000)
    if ttl < 0:
        raise ValueError("ttl_seconds must not be negative")
    if now is None:
        now = F.lit(df.sparkSession.range(1).select(F.current_timestamp()).first()[0])
    keyed = df.select("*", key_text(key).alias("_key"), time_us(time, now).alias("_us"))
    first = F.struct(*order, F.xxhash64(*df.columns))
    one_per_time = keyed.groupBy("_key", "_us").agg(
        F.min_by(F.struct(*df.columns), first).alias("_row")
    )
    kept = kept_times(keyed.select("_key", "_us"), ttl)
    return one_per_time.join(kept, ["_key", "_us"], "left_semi").select("_row.*")


def suppress_after(
    df: DataFrame,
    memory: DataFrame,
    key: Sequence[str] = ("event_id",),
    time: str = "observed_at",
    ttl_seconds: float = SUPPRESS_TTL_SECONDS,
    order: Sequence[str] = (),
    now: Column | None = None,
) -> DataFrame:
    """``suppress_recent`` for rows that come after those ``memory`` was made from.

    A row still inside the time to live of the remembered one goes; the rest starts a chain.
    """
    ttl = round(ttl_seconds * 1_000_000)
    keyed = df.withColumn("_key", key_text(key)).join(memory, "_key", "left")
    open_rows = keyed.filter(F.col("_last").isNull() | (time_us(time, now) > F.col("_last") + ttl))
    return suppress_recent(open_rows.select(*df.columns), key, time, ttl_seconds, order, now)


def remember(
    memory: DataFrame,
    published: DataFrame,
    key: Sequence[str] = ("event_id",),
    time: str = "observed_at",
    ttl_seconds: float = SUPPRESS_TTL_SECONDS,
) -> DataFrame:
    """Last published time per key; keys whose time to live is over by the newest time go."""
    fresh = published.select(key_text(key).alias("_key"), time_us(time).alias("_last"))
    newest = memory.unionByName(fresh).groupBy("_key").agg(F.max("_last").alias("_last"))
    now = newest.agg(F.max("_last")).first()[0]
    if now is None:
        return newest
    return newest.filter(F.col("_last") >= now - round(ttl_seconds * 1_000_000))


def kept_times(times: DataFrame, ttl: int) -> DataFrame:
    """Key and time of every kept row, from all keys and times in microseconds."""
    distinct = times.distinct()
    if ttl == 0:
        return distinct
    ranged = distinct.repartitionByRange("_key", "_us").sortWithinPartitions("_key", "_us")
    # Written, so that the pieces are the same for all that reads them.
    chains = materialize(ranged.mapInArrow(_chain(ttl, LEAF_ROWS), CHAIN_DDL), "chains")
    pieces = chains.filter("_piece is not null")
    summaries = pieces.groupBy("_key", "_piece").applyInPandas(_summarise(ttl), PIECE_DDL)
    entries = _entries(materialize(summaries, "steps"), ttl)
    marked = (
        pieces.groupBy("_key", "_piece")
        .cogroup(entries.groupBy("_key", "_piece"))
        .applyInPandas(_mark(ttl), TIME_DDL)
    )
    return chains.filter("_piece is null").select("_key", "_us").unionByName(marked)


def _entries(summaries: DataFrame, ttl: int) -> DataFrame:
    """For each piece that the chain of its key may enter, the time after which it continues."""
    steps = summaries.groupBy("_key").agg(F.sum(F.size("starts")).alias("_steps"))
    heavy = steps.filter(F.col("_steps") > WALK_STEPS).select("_key")
    if heavy.isEmpty():
        return _walked(summaries, ttl)
    light = summaries.join(heavy, "_key", "left_anti")
    return _walked(light, ttl).unionByName(_doubled(summaries.join(heavy, "_key", "left_semi"), ttl))


def _walked(summaries: DataFrame, ttl: int) -> DataFrame:
    in_order = summaries.repartition("_key").sortWithinPartitions("_key", "_piece")
    return in_order.mapInArrow(_walk(ttl), ENTRY_DDL)


def _doubled(summaries: DataFrame, ttl: int) -> DataFrame:
    """Entries by doubling; pieces that the chain passes over get none."""
    step = F.explode(F.arrays_zip("starts", "exits")).alias("_step")
    steps = summaries.select("_key", "_piece", step).select(
        "_key", "_piece", F.col("_step.starts").alias("_us"), (F.col("_step.exits") + ttl).alias("_after")
    )
    linked = materialize(_linked(steps), "linked")
    first = steps.groupBy("_key").agg(F.min(F.struct("_us", "_piece")).alias("_first"))
    reached = first.select("_key", "_first._us")
    jumps = linked.filter("_to is not null").select("_key", "_us", F.col("_to._us").alias("_to"))
    while not jumps.isEmpty():
        further = reached.join(jumps, ["_key", "_us"]).select("_key", F.col("_to").alias("_us"))
        reached = materialize(reached.unionByName(further), "reached")
        onward = jumps.select("_key", F.col("_us").alias("_to"), F.col("_to").alias("_far"))
        twice = jumps.join(onward, ["_key", "_to"]).select("_key", "_us", F.col("_far").alias("_to"))
        jumps = materialize(twice, "jumps")
    entered = linked.filter("_to is not null").join(reached, ["_key", "_us"], "left_semi")
    return first.select("_key", "_first._piece", F.lit(NEVER).alias("_after")).unionByName(
        entered.select("_key", F.col("_to._piece").alias("_piece"), "_after")
    )


def _linked(steps: DataFrame) -> DataFrame:
    """Each step with ``_to``, the first step of its key that starts later than ``_after``.

    Starts and the times that ask for one are sorted together, in ranges; what the end of a range
    leaves open is answered by the first start of a later range of the key.
    """
    starts = steps.select("_key", F.col("_us").alias("_at"), F.lit(False).alias("_asks"), "_piece", "_us", "_after")
    asks = steps.select("_key", F.col("_after").alias("_at"), F.lit(True).alias("_asks"), "_piece", "_us", "_after")
    # An ask at the time of a start comes behind it: only later starts answer.
    ranged = starts.unionByName(asks).repartitionByRange("_key", "_at", "_asks", "_us")
    laid = materialize(ranged.withColumn("_range", F.spark_partition_id()), "asks")
    start = F.when(~F.col("_asks"), F.struct("_us", "_piece"))
    backwards = Window.partitionBy("_key", "_range").orderBy(F.desc("_at"), F.desc("_asks"), "_us")
    inside = laid.withColumn("_next", F.last(start, ignorenulls=True).over(backwards)).filter("_asks")
    borders = laid.groupBy("_key", "_range").agg(F.min(start).alias("_first"))
    later = Window.partitionBy("_key").orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    beyond = borders.select("_key", "_range", F.last("_first", ignorenulls=True).over(later).alias("_beyond"))
    return inside.join(beyond, ["_key", "_range"]).select(
        "_key", "_us", "_after", F.coalesce("_next", "_beyond").alias("_to")
    )


def _chain_from(times: np.ndarray, after: int, ttl: int) -> list[int]:
    """Kept ones of sorted times, for a chain that continues after ``after``."""
    kept = []
    at = int(np.searchsorted(times, after, "right"))
    while at < len(times):
        kept.append(int(times[at]))
        at = int(np.searchsorted(times, kept[-1] + ttl, "right"))
    return kept


def _chain(ttl: int, leaf_rows: int):
    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        current, at_start = None, True
        done_keys: list[str] = []
        done_times: list[np.ndarray] = []

        def pieces() -> Iterator[pa.RecordBatch]:
            times = np.concatenate(held)
            for at in range(0, len(times), leaf_rows):
                part = times[at : at + leaf_rows]
                yield _batch([current] * len(part), part, np.full(len(part), part[0]))

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            times = batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                if held and keys[start] != current:
                    if at_start:
                        yield from pieces()
                    else:
                        kept = _chain_from(np.concatenate(held), NEVER, ttl)
                        done_keys += [current] * len(kept)
                        done_times.append(np.array(kept, dtype="int64"))
                    held, at_start = [], False
                current = keys[start]
                held.append(times[start:end])
            if len(done_keys) > leaf_rows:
                yield _batch(done_keys, np.concatenate(done_times), None)
                done_keys, done_times = [], []
        if done_keys:
            yield _batch(done_keys, np.concatenate(done_times), None)
        if held:
            yield from pieces()

    return chain


def _batch(keys: list[str], times: np.ndarray, piece: np.ndarray | None) -> pa.RecordBatch:
    pieces = pa.nulls(len(keys), pa.int64()) if piece is None else pa.array(piece)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.string()), pa.array(times), pieces], ["_key", "_us", "_piece"]
    )


def _keep_steps(starts: np.ndarray, exits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge neighbouring steps with the same exit."""
    change = np.append(exits[1:] != exits[:-1], True)
    return starts[change], exits[change]


def _summarise(ttl: int):
    def summarise(pdf: pd.DataFrame) -> pd.DataFrame:
        times = np.sort(pdf["_us"].to_numpy())
        following = np.append(np.searchsorted(times, times + ttl, "right"), len(times))
        # A chain from before enters within one time to live, or at the first time after it.
        entries = min(int(np.searchsorted(times, times[0] + ttl)) + 1, len(times))
        last = np.arange(entries)
        while True:
            step = following[last]
            moves = step < len(times)
            if not moves.any():
                break
            last = np.where(moves, step, last)
        starts, exits = _keep_steps(times[:entries], times[last])
        frame = pd.DataFrame({"_piece": [int(pdf["_piece"].iloc[0])], "starts": [starts], "exits": [exits]})
        frame.insert(0, "_key", pd.Series([pdf["_key"].iloc[0]], dtype="object"))
        return frame

    return summarise


def _walk(ttl: int):
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, after = None, NEVER
        for batch in batches:
            keys, pieces, entries = batch.column(0), batch.column(1), []
            for row, key in enumerate(keys.to_pylist()):
                if key != current:
                    current, after = key, NEVER
                entries.append(after)
                starts = batch.column(2)[row].values.to_numpy()
                at = int(np.searchsorted(starts, after, "right"))
                if at < len(starts):
                    after = batch.column(3)[row].values[at].as_py() + ttl
            yield pa.RecordBatch.from_arrays(
                [keys, pieces, pa.array(entries, pa.int64())], ["_key", "_piece", "_after"]
            )

    return walk


def _mark(ttl: int):
    def mark(times: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        # The chain passes over a piece without an entry.
        passed = times.empty or entry.empty
        kept = [] if passed else _chain_from(np.sort(times["_us"].to_numpy()), int(entry["_after"].iloc[0]), ttl)
        frame = pd.DataFrame({"_us": np.array(kept, dtype="int64")})
        frame.insert(0, "_key", pd.Series([] if passed else [times["_key"].iloc[0]] * len(frame), dtype="object"))
        return frame

    return mark


# Send what runs in Python workers by value, so that they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
