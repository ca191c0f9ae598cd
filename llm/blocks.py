"""Documents in blocks of bounded size, and keys exchanged between blocks.

Counting a key over the whole corpus row by row would shuffle one row per position of every text.
Here each block first counts its own keys, sends each distinct key once, packed with others of the
same hash range, and gets back those keys that occur at least twice anywhere. A key that a third
of all documents hold is sent once per block, so no task gets more than one entry per block and
key. The text is shuffled once: every step that needs it uses the same exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.hashing import U64

BLOCK_BYTES = 8 << 20
HELD_KEYS = 4 << 20
# Bytes and rows that go to a Python worker at once; several workers share an executor's memory.
BATCH_BYTES = 4 << 20
BATCH_ROWS = 2_000
REPLY_SCHEMA = "blk int, keys binary, counts binary"
CLASS_SCHEMA = "blk int, bucket int, classes binary"
MANY = 15


def small_batches(spark: SparkSession) -> None:
    """Send texts to Python workers in small batches, also those far longer than usual."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def block_documents(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """Rows (blk, doc, doc_id, text) dealt by block, and the number of blocks.

    ``doc`` is a hash of id and text; rows with the same id and different texts stay apart, and
    equal rows share it, which is harmless: they get equal results. Null text counts as empty.
    """
    small_batches(docs.sparkSession)
    keyed = named_documents(docs)
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-int(size) // block_bytes))
    blocks = keyed.select(F.pmod("doc", F.lit(count)).cast("int").alias("blk"), "doc", "doc_id", "text")
    return blocks.repartition(count, "blk"), count


def named_documents(docs: DataFrame) -> DataFrame:
    """Rows (doc, doc_id, text), as ``block_documents`` deals them."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )
    return rows.select(F.xxhash64("doc_id", "text").alias("doc"), "doc_id", "text")


def pack(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, laid out byte by byte: the high bytes are mostly equal."""
    step = np.diff(keys, prepend=U64(0))
    return np.ascontiguousarray(step.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack(data: bytes) -> np.ndarray:
    step = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(U64).ravel()
    return np.cumsum(step, dtype=U64)


def pack_counts(counts: np.ndarray) -> bytes:
    """A byte for each count; those of 255 or more follow in full."""
    large = counts[counts >= 255].astype("<u8")
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + large.tobytes()


def unpack_counts(data: bytes, length: int) -> np.ndarray:
    out = np.frombuffer(data, np.uint8, length).astype(np.int64)
    out[out == 255] = np.frombuffer(data, "<u8", offset=length)
    return out


def repeated_keys(
    blocks: DataFrame,
    count: int,
    keys_of: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]],
    blocks_per_bucket: int = 2,
    least: int = 2,
) -> DataFrame:
    """Rows (blk, keys, counts) of packed, sorted 64-bit keys that occur ``least`` times in all blocks.

    ``keys_of`` gives the distinct keys of a batch, sorted, and their counts in it. Each block gets
    those of its own keys that occur often enough, with their counts over the whole input.
    """
    buckets = max(1, -(-count // blocks_per_bucket))

    def cuts(keys: np.ndarray) -> np.ndarray:
        return range_cuts(keys >> U64(32), buckets)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in runs(batches, "bucket"):
            parts = [unpack(x) for x in rows["keys"].to_pylist()]
            keys = np.concatenate(parts)
            counts = np.concatenate(
                [unpack_counts(x, len(p)) for x, p in zip(rows["counts"].to_pylist(), parts, strict=True)]
            )
            order = np.argsort(keys)
            ordered = keys[order]
            first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
            total = np.add.reduceat(counts[order], first)
            each = np.empty(len(keys), dtype=np.int64)
            each[order] = np.repeat(total, np.diff(np.append(first, len(keys))))
            owner = np.repeat(rows["blk"].to_numpy(), [len(p) for p in parts])
            keep = each >= least
            keys, each, owner = keys[keep], each[keep], owner[keep]
            if not len(keys):
                continue
            order = np.lexsort((keys, owner))
            keys, each, owner = keys[order], each[order], owner[order]
            found, at = np.unique(owner, return_index=True)
            ends = np.append(at[1:], len(owner))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found.astype(np.int32)),
                    pa.array([pack(keys[i:j]) for i, j in zip(at, ends, strict=True)], pa.binary()),
                    pa.array([pack_counts(each[i:j]) for i, j in zip(at, ends, strict=True)], pa.binary()),
                ],
                ["blk", "keys", "counts"],
            )

    return sent_keys(blocks, buckets, keys_of, cuts).mapInArrow(merge, REPLY_SCHEMA)


def sent_keys(
    blocks: DataFrame,
    buckets: int,
    keys_of: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]],
    cuts_of: Callable[[np.ndarray], np.ndarray],
) -> DataFrame:
    """Rows (bucket, blk, keys, counts) dealt and sorted by bucket: what each block holds of a hash range."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0
        for batch in batches:
            table = pa.Table.from_batches([batch])
            owner = table["blk"].to_numpy()
            for blk in np.unique(owner).tolist():
                part = table if (owner == blk).all() else table.filter(pa.array(owner == blk))
                held.setdefault(blk, []).append(keys_of(part))
                size += len(held[blk][-1][0])
            if size > HELD_KEYS:
                yield from (packed(blk, *summed(parts)) for blk, parts in held.items())
                held, size = {}, 0
        yield from (packed(blk, *summed(parts)) for blk, parts in held.items())

    def packed(blk: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        cuts = cuts_of(keys)
        full = np.flatnonzero(np.diff(cuts))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(full.astype(np.int32)),
                pa.array(np.full(len(full), blk, np.int32)),
                pa.array([pack(keys[cuts[i] : cuts[i + 1]]) for i in full], pa.binary()),
                pa.array([pack_counts(counts[cuts[i] : cuts[i + 1]]) for i in full], pa.binary()),
            ],
            ["bucket", "blk", "keys", "counts"],
        )

    sent = blocks.mapInArrow(send, "bucket int, blk int, keys binary, counts binary")
    return sent.repartition(buckets, "bucket").sortWithinPartitions("bucket")


def range_cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where the hash ranges of sorted keys of 32 bits begin and end: the product's high half keeps their order."""
    bucket = (keys * U64(buckets)) >> U64(32)
    return np.searchsorted(bucket, np.arange(buckets + 1, dtype=U64))


def short_keys(keys: np.ndarray, count: int) -> np.ndarray:
    """The first bits of sorted keys, so many that keys of ``count`` blocks seldom share them."""
    return keys >> U64(64 - short_bits(count))


def short_bits(count: int) -> int:
    return min(64, 32 + count.bit_length())


def class_of_count(counts: np.ndarray) -> np.ndarray:
    """Counts in 15 classes, the first 8 of one count each; a larger count is never in a lower class."""
    exponent = np.frexp(counts.astype(np.float64))[1] + 5
    return np.where(counts <= 8, counts, np.minimum(exponent, MANY)).astype(np.uint8)


def count_classes(
    blocks: DataFrame, count: int, keys_of: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]]
) -> DataFrame:
    """Rows (blk, bucket, classes): how often each key of a block occurs in all blocks, in classes.

    ``keys_of`` gives the distinct short keys of a batch, sorted, and their counts in it. A block knows its keys and
    their order, so a reply is half a byte a key; ``class_table`` reads them.
    """
    buckets = class_buckets(count)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in runs(batches, "bucket"):
            held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
            for blk, data, number in zip(*(rows[x].to_pylist() for x in ("blk", "keys", "counts")), strict=True):
                keys = unpack(data)
                held.setdefault(blk, []).append((keys, unpack_counts(number, len(keys))))
            parts = [summed(x) for x in held.values()]
            keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(keys, kind="stable")
            ordered = keys[order]
            first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
            found = class_of_count(np.add.reduceat(counts[order], first))
            each = np.empty(len(keys), dtype=np.uint8)
            each[order] = np.repeat(found, np.diff(np.append(first, len(keys))))
            ends = np.cumsum([len(x) for x, _ in parts])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.array(list(held), dtype=np.int32)),
                    pa.array(np.full(len(parts), bucket, np.int32)),
                    pa.array([halves(x) for x in np.split(each, ends[:-1])], pa.binary()),
                ],
                ["blk", "bucket", "classes"],
            )

    return sent_keys(blocks, buckets, keys_of, lambda keys: class_cuts(keys, count)).mapInArrow(merge, CLASS_SCHEMA)


def class_buckets(count: int) -> int:
    return max(1, -(-count // 2))


def class_cuts(keys: np.ndarray, count: int) -> np.ndarray:
    return range_cuts(keys >> U64(short_bits(count) - 32), class_buckets(count))


def halves(classes: np.ndarray) -> bytes:
    """Two classes in a byte."""
    even = np.append(classes, np.zeros(len(classes) % 2, np.uint8)).reshape(-1, 2)
    return (even[:, 0] | even[:, 1] << 4).tobytes()


def class_table(replies: pa.Table, keys: np.ndarray, count: int) -> np.ndarray:
    """The class of each of a block's sorted distinct short keys."""
    cuts = class_cuts(keys, count)
    out = np.zeros(len(keys), dtype=np.uint8)
    for bucket, data in zip(replies["bucket"].to_pylist(), replies["classes"].to_pylist(), strict=True):
        both = np.frombuffer(data, np.uint8)
        i, j = cuts[bucket : bucket + 2]
        out[i:j] = np.stack((both & 15, both >> 4), axis=1).ravel()[: j - i]
    return out


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of several sets of keys, with the sums of their counts."""
    if len(parts) == 1:
        return parts[0]
    keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def reply_table(replies: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """A block's replies as sorted keys and their counts."""
    parts = [unpack(x) for x in replies["keys"].to_pylist()]
    if not parts:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    counts = [unpack_counts(x, len(p)) for x, p in zip(replies["counts"].to_pylist(), parts, strict=True)]
    keys, counts = np.concatenate(parts), np.concatenate(counts)
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.concatenate(([True], keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, bool)
    return keys[first], counts[first]


def with_replies(
    blocks: DataFrame, replies: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str
) -> DataFrame:
    """Run ``work`` on each block together with what was sent to it."""

    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        return work(left, right)

    return blocks.groupBy("blk").cogroup(replies.groupBy("blk")).applyInArrow(both, schema)


def runs(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[object, pa.Table]]:
    """Consecutive rows with an equal value, over batch borders; only one run is held at a time."""
    held: list[pa.Table] = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        values = table[column].to_numpy(zero_copy_only=False)
        cuts = np.concatenate(([0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]))
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            if held and values[i] != current:
                yield current, pa.concat_tables(held)
                held = []
            current = values[i]
            held.append(table.slice(i, j - i))
    if held:
        yield current, pa.concat_tables(held)
