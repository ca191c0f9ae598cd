"""Mixture-controlled packing of documents into sequences.

Every source is a queue of documents. Windows of ``WINDOW_SEQUENCES`` sequences are filled by
deficit round-robin: a source earns its share of each window, pays for the tokens it delivers, and
carries what is left, of either sign, to the next window. The stream of tokens is cut into sequences
of ``LENGTH``.

To run in parallel, the schedule is cut into shards. The place of a document in its queue (a prefix
sum in three levels, so no task sees a whole queue) tells when its first token is due: token q of a
source with share w is due after q / w tokens of all sources. A shard takes the documents that are
due in its stretch of the schedule; how late its first document begins is the deficit that the source
brings along from the shard before. The last tokens of a shard go to sequences whose lengths are
powers of two, so nothing is padded.

Cases: a null or empty text is the one end token; a null source is a queue of its own; equal rows
are packed each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.blocks import small_batches
from llm.storage import written
from llm.token_ids import known_words

LENGTH = 4096
END_ID = 2
WINDOW_SEQUENCES = 64
SHARD_TOKENS = 8 << 20
# Chunks of the corpus for prefix sums, for each shard's worth of tokens.
CHUNKS = 16
# Chunks whose sizes are summed up in one task.
CHUNK_GROUP = 4096
SLICE_ROWS = 2_000
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, source string"
)


def tokenize(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Rows (uid, doc_id, queue, doc, tokens, ids), written; ids are packed 32-bit numbers."""
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("queue"),
        F.xxhash64("doc_id", "text").alias("doc"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = known_words(tokenizer_path, END_ID)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                ids, counts = known.encode(batch.column("text"))
                cuts = np.concatenate(([0], np.cumsum(counts))) * 4
                data = ids.astype("<u4").tobytes()
                packed = pa.array([data[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())
                kept = [batch.column(x) for x in ("uid", "doc_id", "queue", "doc")]
                names = ["uid", "doc_id", "queue", "doc", "tokens", "ids"]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(counts), packed], names)

    schema = "uid long, doc_id long, queue string, doc long, tokens long, ids binary"
    return written(rows.mapInArrow(encode, schema), "tokens")


def schedule(totals: dict[str, int], targets: dict[str, float]) -> dict[str, list[tuple[float, float, float]]]:
    """For each pool its stretches (tokens of the pool before, tokens of all before, share).

    Pools deliver in proportion to their targets while they last; the shares of those that have
    run out go to the others.
    """
    left = {k: float(v) for k, v in totals.items() if v > 0}
    out: dict[str, list[tuple[float, float, float]]] = {k: [] for k in left}
    served, now = dict.fromkeys(left, 0.0), 0.0
    while left:
        weight = {k: max(targets.get(k, 0.0), 0.0) for k in left}
        if not sum(weight.values()):
            weight = dict(left)
        whole = sum(weight.values())
        share = {k: w / whole for k, w in weight.items() if w > 0}
        length = min(left[k] / s for k, s in share.items())
        for k, s in share.items():
            out[k].append((served[k], now, s))
            served[k] += s * length
            left[k] -= s * length
        now += length
        left = {k: v for k, v in left.items() if v > 1e-6 * totals[k]}
    return out


def before_chunks(sizes: DataFrame) -> DataFrame:
    """From (queue, chunk, size) the tokens of a queue ``before`` each chunk, and its ``queue_size``."""
    earlier = (Window.unboundedPreceding, -1)
    grouped = sizes.withColumn("part", F.floor(F.col("chunk") / F.lit(CHUNK_GROUP)))
    in_part = Window.partitionBy("queue", "part").orderBy("chunk").rowsBetween(*earlier)
    before_part = Window.partitionBy("queue").orderBy("part").rowsBetween(*earlier)
    parts = grouped.groupBy("queue", "part").agg(F.sum("size").alias("part_size")).select(
        "queue", "part",
        F.coalesce(F.sum("part_size").over(before_part), F.lit(0)).alias("before_part"),
        F.sum("part_size").over(Window.partitionBy("queue")).alias("queue_size"),
    )
    inside = grouped.withColumn("inside_part", F.coalesce(F.sum("size").over(in_part), F.lit(0)))
    return inside.join(parts, ["queue", "part"]).select(
        "queue", "chunk", (F.col("before_part") + F.col("inside_part")).alias("before"), "queue_size"
    )


def due_times(light: DataFrame, targets: dict[str, float] | None) -> tuple[DataFrame, int]:
    """Rows with ``due`` (tokens of all sources before the document) and ``share``; and all tokens."""
    total = light.agg(F.sum("tokens")).first()[0] or 0
    count = max(1, -(-total * CHUNKS // SHARD_TOKENS))
    rows = light.withColumn("chunk", F.pmod("doc", F.lit(count)).cast("int"))
    in_chunk = Window.partitionBy("queue", "chunk").orderBy("doc", "uid").rowsBetween(Window.unboundedPreceding, -1)
    sums = before_chunks(rows.groupBy("queue", "chunk").agg(F.sum("tokens").alias("size")))
    placed = (
        rows.withColumn("inside", F.coalesce(F.sum("tokens").over(in_chunk), F.lit(0)))
        .join(sums, ["queue", "chunk"])
        .withColumn("at", (F.col("before") + F.col("inside")).cast("double"))
    )
    if targets is None:
        share = F.col("queue_size") / F.lit(float(max(1, total)))
        return placed.withColumns({"share": share, "due": F.col("at") / share}), total
    # One pool for each source with a target, and one for all others, in which each source
    # delivers in proportion to its size. Both tables below are bounded by the targets.
    named = ["=" + x for x in targets]
    pool = F.when(F.col("queue").isin(named), F.col("queue")).otherwise("")
    sizes = {r[0]: r[1] for r in light.groupBy(pool.alias("pool")).agg(F.sum("tokens")).collect()}
    rest = max(0.0, 1.0 - sum(targets.values()))
    plan = schedule(sizes, {"=" + k: v for k, v in targets.items()} | {"": rest})
    pool_size = F.when(pool == "", F.lit(float(sizes.get("", 1)))).otherwise(F.col("queue_size").cast("double"))
    part = F.col("queue_size") / pool_size
    at = F.col("at") / part
    due, share = F.lit(0.0), F.lit(1.0)
    for name, stretches in plan.items():
        for served, now, rate in stretches:
            here = (pool == name) & (at >= served)
            due = F.when(here, F.lit(now) + (at - served) / rate).otherwise(due)
            share = F.when(here, part * rate).otherwise(share)
    return placed.withColumns({"share": share, "due": due}), total


Queue = list[tuple[int, int]]


def deficit_round_robin(
    queues: dict[str, Queue], shares: dict[str, float], deficits: dict[str, float], window: int
) -> Iterator[tuple[int, int, int]]:
    """(uid, start, length) of pieces in the order of the stream; queues hold (uid, tokens)."""
    left = {k: sum(n for _, n in q) for k, q in queues.items()}
    deficit = dict(deficits)
    place = dict.fromkeys(queues, (0, 0))

    def deliver(name: str, amount: int) -> Iterator[tuple[int, int, int]]:
        left[name] -= amount
        deficit[name] -= amount
        row, start = place[name]
        while amount:
            uid, size = queues[name][row]
            taken = min(amount, size - start)
            yield uid, start, taken
            amount -= taken
            row, start = (row + 1, 0) if start + taken == size else (row, start + taken)
        place[name] = (row, start)

    while remaining := sum(left.values()):
        room = min(window, remaining)
        open_queues = [k for k in sorted(queues) if left[k]]
        whole = sum(shares[k] for k in open_queues)
        for name in open_queues:
            deficit[name] += window * shares[name] / whole
        for name in open_queues:
            amount = min(room, left[name], max(0, int(deficit[name])))
            room -= amount
            yield from deliver(name, amount)
        # What rounding and queues that ran out have left goes to those with the largest deficit.
        for name in sorted(open_queues, key=lambda k: -deficit[k]):
            amount = min(room, left[name])
            room -= amount
            yield from deliver(name, amount)


def sequence_sizes(tokens: int, length: int) -> list[int]:
    """Full sequences, then powers of two."""
    tail = tokens % length
    return [length] * (tokens // length) + [1 << b for b in reversed(range(tail.bit_length())) if tail >> b & 1]


def fill(pieces: Iterator[tuple[int, int, int]], tokens: int, length: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(uid, start, length, sequence, offset): the stream cut into sequences."""
    sizes = iter(sequence_sizes(tokens, length))
    number, size, offset = 0, next(sizes, 0), 0
    for uid, start, amount in pieces:
        while amount:
            if offset == size:
                number, size, offset = number + 1, next(sizes), 0
            taken = min(amount, size - offset)
            yield uid, start, taken, number, offset
            start, amount, offset = start + taken, amount - taken, offset + taken


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    length: int = LENGTH,
    targets: dict[str, float] | None = None,
    window_sequences: int = WINDOW_SEQUENCES,
) -> DataFrame:
    """One row per piece of a document in a sequence; see ``PIECES``.

    ``targets`` gives sources their share of tokens; without it each gets the share that it has of
    the corpus. Sources without a target share what the targets leave.
    """
    tokens = tokenize(docs, tokenizer_path)
    timed, _ = due_times(tokens.select("uid", "queue", "doc", "tokens"), targets)
    shard = F.floor(F.col("due") / SHARD_TOKENS).cast("int")
    late = (F.col("due") - shard * F.lit(float(SHARD_TOKENS))) * F.col("share")
    rows = timed.select(shard.alias("shard"), "queue", "at", "uid", "tokens", "share", late.alias("late"))

    def one_shard(table: pa.Table) -> pa.Table:
        table = table.sort_by([("queue", "ascending"), ("at", "ascending"), ("uid", "ascending")])
        queues: dict[str, Queue] = {}
        shares: dict[str, float] = {}
        deficits: dict[str, float] = {}
        columns = (table[x].to_pylist() for x in ("queue", "uid", "tokens", "share", "late"))
        for queue, uid, size, share, behind in zip(*columns, strict=True):
            queues.setdefault(queue, []).append((uid, size))
            shares.setdefault(queue, share)
            deficits.setdefault(queue, -behind)
        whole = sum(table["tokens"].to_pylist())
        stream = deficit_round_robin(queues, shares, deficits, window_sequences * length)
        cut = list(zip(*fill(stream, whole, length), strict=True)) or [[]] * 5
        number = int(table["shard"][0].as_py()) << 32 if len(table) else 0
        names = ["uid", "start", "length", "sequence_id", "offset"]
        arrays = [np.array(x, dtype=np.int64) for x in cut]
        arrays[3] = arrays[3] + number
        return pa.table([pa.array(x) for x in arrays], names)

    piece_schema = "uid long, start long, length long, sequence_id long, offset long"
    pieces = rows.groupBy("shard").applyInArrow(one_shard, piece_schema)
    per_document = pieces.groupBy("uid").agg(
        F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("pieces")
    )
    joined = tokens.select("uid", "doc_id", "queue", "tokens", "ids").join(per_document, "uid")
    return joined.mapInArrow(checksums, PIECES)


def checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each piece with the checksum of its ids."""
    for batch in batches:
        rows = []
        columns = (batch.column(x).to_pylist() for x in ("doc_id", "queue", "tokens", "ids", "pieces"))
        for doc_id, queue, count, ids, pieces in zip(*columns, strict=True):
            source = queue[1:] if queue else None
            for piece in pieces:
                start, size = piece["start"], piece["length"]
                crc = zlib.crc32(ids[4 * start : 4 * (start + size)])
                rows.append((doc_id, start, size, crc, count, piece["sequence_id"], piece["offset"], source))
        if rows:
            kinds = [pa.int64()] * 7 + [pa.string()]
            names = [x.split()[0] for x in PIECES.split(", ")]
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)
