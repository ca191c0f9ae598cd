"""Document fingerprints by locally consistent parsing.

A text is parsed into phrases again and again. At each level runs of one symbol become one
symbol; deterministic coin tossing then gives every symbol a label from the lowest bit in which it
differs from the symbol before, repeated until few labels are left; phrases begin at local maxima
of the labels, and at local minima away from them. A phrase is named by a hash of its symbols, and
names are the symbols of the next level. A border depends on a few symbols around it only, so equal
substrings have equal phrases inside, wherever they stand.

A fingerprint is the ``SLOTS`` smallest names of level ``LEVELS``, as hexadecimal digits; likeness
estimates the share of common names among all names of two texts.

Cases: a null text counts as empty; the empty text has the empty fingerprint, like itself (1) and
unlike all others (0); texts too short for a phrase have one name; equal rows are each other's
neighbours; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.blocks import small_batches
from llm.hashing import GOLDEN, U64, mix, text_bytes

LEVELS = 3
SLOTS = 32
CHUNK_CHARS = 1 << 20
# Rows that the Parquet reader holds at once; its vectors grow by doubling until the texts fit.
READ_ROWS = 256
EMPTY_SLOT = np.uint64(0xFFFFFFFF)
PHRASE_WEIGHTS = np.cumprod(np.full(64, 0xD1342543DE82EF95, dtype=np.uint64), dtype=np.uint64)
SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def toss(symbols: np.ndarray, head: np.ndarray) -> np.ndarray:
    """Labels: place of the lowest bit that differs from the symbol before, and that bit."""
    before = np.empty_like(symbols)
    before[1:] = symbols[:-1]
    before[head] = ~symbols[head]
    differ = symbols ^ before
    place = np.bitwise_count((differ & (~differ + differ.dtype.type(1))) - differ.dtype.type(1))
    bit = (symbols >> place.astype(symbols.dtype)) & symbols.dtype.type(1)
    return (place * 2 + bit.astype(np.uint8)).astype(np.uint8)


def phrase_starts(labels: np.ndarray, head: np.ndarray) -> np.ndarray:
    """Where phrases begin: text heads, local maxima, and local minima not beside a maximum."""
    count = len(labels)
    before, after = np.empty_like(labels), np.empty_like(labels)
    before[1:], after[:-1], after[-1] = labels[:-1], labels[1:], labels[-1]
    # The ends of a text are neither; nothing depends on the text before or after it.
    before[head] = labels[head]
    after[head[1:] - 1] = labels[head[1:] - 1]
    top = (labels > before) & (labels > after)
    low = (labels < before) & (labels < after)
    beside = np.zeros(count, dtype=bool)
    beside[1:] |= top[:-1]
    beside[:-1] |= top[1:]
    start = top | (low & ~beside)
    start[head] = True
    return np.flatnonzero(start)


def one_level(symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of phrases of all texts, and the texts' offsets in them."""
    if not len(symbols):
        return np.zeros(0, dtype=U64), bounds
    heads = bounds[:-1][np.diff(bounds) > 0]
    new = np.ones(len(symbols), dtype=bool)
    new[1:] = symbols[1:] != symbols[:-1]
    new[heads] = True
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, len(symbols)))
    plain = symbols[first]
    bounds = np.searchsorted(first, bounds)
    heads = bounds[:-1][np.diff(bounds) > 0]
    labels = plain
    # As many tosses as bring any symbol of this width to six labels: 8 bits, or 64 bits.
    for _ in range(3 if plain.dtype == np.uint8 else 4):
        labels = toss(labels, heads)
    wide = plain.astype(U64) + U64(1)
    wide = np.where(length > 1, mix(wide * GOLDEN + length.astype(U64)), wide)
    starts = phrase_starts(labels, heads)
    place = np.arange(len(wide)) - np.repeat(starts, np.diff(np.append(starts, len(wide))))
    names = mix(np.add.reduceat(mix(wide) * PHRASE_WEIGHTS[np.minimum(place, 63)], starts))
    return names, np.searchsorted(starts, bounds)


def names_of(raw: np.ndarray, bounds: np.ndarray, levels: int = LEVELS) -> tuple[np.ndarray, np.ndarray]:
    """Phrase names of the last level for all texts in a row, and the texts' offsets in them."""
    symbols = raw
    for _ in range(levels):
        symbols, bounds = one_level(symbols, bounds)
    return symbols.astype(U64), bounds


def sketches(texts: list[str], levels: int = LEVELS, slots: int = SLOTS) -> np.ndarray:
    """A row of the smallest distinct names for each text, filled up with EMPTY_SLOT."""
    out = np.full((len(texts), slots), EMPTY_SLOT, dtype=U64)
    start = 0
    while start < len(texts):
        stop, size = start, 0
        while stop < len(texts) and (stop == start or size + len(texts[stop]) <= CHUNK_CHARS):
            size += len(texts[stop])
            stop += 1
        names, bounds = names_of(*text_bytes(pa.array(texts[start:stop], pa.large_string())), levels)
        text = np.repeat(np.arange(stop - start), np.diff(bounds))
        # 32 bits of a name, below the mark of an empty slot, sorted within each text.
        both = np.unique((text.astype(U64) << U64(32)) | np.minimum(names >> U64(32), EMPTY_SLOT - U64(1)))
        text = (both >> U64(32)).astype(np.int64)
        place = np.arange(len(both)) - np.searchsorted(text, np.arange(stop - start))[text]
        small = place < slots
        out[start + text[small], place[small]] = both[small] & EMPTY_SLOT
        start = stop
    return out


def likeness(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Share of common names among the smallest names of both, for each pair of rows."""
    slots = first.shape[1]
    both = np.sort(np.concatenate((first, second), axis=1), axis=1)
    new = np.ones(both.shape, dtype=bool)
    new[:, 1:] = both[:, 1:] != both[:, :-1]
    new &= both != EMPTY_SLOT
    counted = new & (np.cumsum(new, axis=1) <= slots)
    twice = np.zeros(both.shape, dtype=bool)
    twice[:, :-1] = both[:, 1:] == both[:, :-1]
    total = counted.sum(axis=1)
    return np.where(total == 0, 1.0, (counted & twice).sum(axis=1) / np.maximum(total, 1))


def printed(rows: np.ndarray) -> list[str]:
    filled = (rows != EMPTY_SLOT).sum(axis=1)
    digits = rows.astype(">u4").tobytes()
    width = rows.shape[1] * 4
    return [digits[i * width : i * width + 4 * n].hex() for i, n in enumerate(filled)]


def edited(text: str, other: str) -> str:
    """The text with its last third replaced by as much from the head of the other text."""
    part = len(text) // 3
    return text[: len(text) - part] + other[:part]


def described(ids: list, texts: list[str], known: np.ndarray, own: list[int]) -> pa.RecordBatch:
    """Rows for the texts at the places ``own``, each with the text after it as its neighbour."""
    changed = [edited(texts[i], texts[i + 1]) for i in own]
    after = sketches(changed)
    at = np.array(own, dtype=np.int64)
    columns = [
        pa.array([ids[i] for i in own], pa.int64()),
        pa.array([len(texts[i]) for i in own], pa.int64()),
        pa.array([hashlib.sha256(x.encode()).hexdigest() for x in changed], pa.string()),
        pa.array(printed(known[at]), pa.string()),
        pa.array(printed(after), pa.string()),
        pa.array(likeness(known[at], after)),
        pa.array(likeness(known[at], known[at + 1])),
    ]
    return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in SCHEMA.split(", ")])


def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of sorted ranges, each with the row after it; guests end a range and are left out."""
    ids: list = []
    texts: list[str] = []
    guests: list[bool] = []
    known = np.zeros((0, SLOTS), dtype=U64)
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            more = part.column("text").to_pylist()
            ids, texts = ids[-1:] + part.column("doc_id").to_pylist(), texts[-1:] + more
            guests = guests[-1:] + part.column("guest").to_pylist()
            known = np.concatenate((known[-1:], sketches(more)))
            own = [i for i, guest in enumerate(guests[:-1]) if not guest]
            if own:
                yield described(ids, texts, known, own)


def first_keys(keys: DataFrame, parts: int) -> list[dict[str, int | None]]:
    """The first key of each of at most ``parts`` ranges in descending order, smallest first."""
    dealt = keys.repartitionByRange(parts, F.col("key").desc())
    ranges = dealt.select("key", F.spark_partition_id().alias("range"))
    # One row of two numbers for each partition of the shuffle.
    found = ranges.groupBy("range").agg(F.max("key").alias("key")).select("key.doc_id", "key.doc").collect()
    return [r.asDict() for r in sorted(found, key=lambda r: (r.doc_id is not None, r))]


def fingerprint(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and of their edited texts; see ``SCHEMA``.

    The document after another is the one with the next smaller id, after the last the first.
    Keys alone, without texts, are cut into ranges over all partitions when this is called. The first row
    of a range goes to the range before as well, as a guest at its end; so texts are shuffled, sorted and
    read once, and each row meets its neighbour in its own range. The table is read anew for the texts and
    must give the same rows.
    """
    small_batches(docs.sparkSession)
    docs.sparkSession.conf.set("spark.sql.parquet.columnarReaderBatchSize", READ_ROWS)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("doc_id", "text").alias("doc"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    # In descending order: ids without null from the largest, nulls, and the smallest hash first among equals.
    key = F.struct("doc_id", F.bitwise_not("doc").alias("doc"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    firsts = first_keys(rows.select(key.alias("key")), parts)
    if not firsts:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    # One literal, so that planning does not take long with thousands of ranges.
    cuts = F.from_json(F.lit(json.dumps(firsts)), "array<struct<doc_id: bigint, doc: bigint>>")
    # Binary search for the number of cuts below the key; beyond the last cut the comparison is null.
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(firsts).bit_length()))])
    below = F.aggregate(
        steps, F.lit(0), lambda n, step: F.when(F.get(cuts, n + step - 1) < F.col("key"), n + step).otherwise(n)
    )
    placed = rows.withColumn("key", key).withColumn("part", F.least(below, F.lit(len(firsts) - 1)))
    at_home = F.struct("part", F.lit(False).alias("guest"))
    as_guest = F.struct(((F.col("part") + 1) % len(firsts)).alias("part"), F.lit(True).alias("guest"))
    is_first = F.get(cuts, F.col("part")).eqNullSafe(F.col("key"))
    places = F.when(is_first, F.array(at_home, as_guest)).otherwise(F.array(at_home))
    sent = placed.select("key", "text", F.inline(places))
    dealt = sent.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "guest", F.col("key").desc())
    return dealt.select("key.doc_id", "text", "guest").mapInArrow(in_order, SCHEMA)
