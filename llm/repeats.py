"""Repeated runs of symbols: what substring dedup over words and over bytes have in common.

A window is ``window`` consecutive symbols of one text. Suffixes are sampled at anchors: the
anchor of a window is its ``gram``-symbol run with the smallest hash, so equal windows have equal
anchors at equal offsets. Suffixes are then partitioned by prefix:

1. anchor grams are counted over all blocks; a window whose anchor occurs once cannot repeat;
2. a region is a run of windows with one anchor. Regions go to the group of their anchor gram, the
   prefix of the suffix that starts there;
3. a prefix with more than ``group_limit`` suffixes is lengthened to the whole window. At that
   depth a group is one class of equal windows, of which each block sends one row.

So every group fits in memory, whatever the number of copies, and every pair of equal windows
meets in exactly one group. A solver finds the repeats of a group; the places it gives back are
applied to the texts block by block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from llm.blocks import block_documents, repeated_keys, reply_table, with_replies
from llm.hashing import U64, gram_hashes, in_sorted, mix, pieces, ranges

GROUP_LIMIT = 1_500
POSITION_BITS = 32
PLACE = np.dtype([("doc", "<i8"), ("start", "<i4"), ("windows", "<i4")])
SPAN = np.dtype([("doc", "<i8"), ("start", "<i4"), ("length", "<i4")])
FULL_WINDOW = -1


@dataclass(frozen=True)
class Symbols:
    """One batch of texts as symbols: hashes, text offsets in them, and byte places of symbols."""

    raw: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray
    byte_starts: np.ndarray | None
    byte_ends: np.ndarray | None

    def cut(self, start: int, stop: int) -> bytes:
        if self.byte_starts is None:
            return self.raw[start:stop].tobytes()
        return self.raw[self.byte_starts[start] : self.byte_ends[stop - 1]].tobytes()


Reader = Callable[[np.ndarray, np.ndarray], Symbols]
# A region: symbols before its anchor, and its bytes. A solver gives (region, start, length, repeat).
Region = tuple[int, bytes]
Solver = Callable[[list[Region], int], Iterable[tuple[int, int, int, int]]]


@dataclass(frozen=True)
class Anchors:
    """Runs of windows with one anchor: text index, first window, windows, anchor, gram hash."""

    text: np.ndarray
    first: np.ndarray
    windows: np.ndarray
    anchor: np.ndarray
    key: np.ndarray


def anchors_of(symbols: Symbols, window: int, gram: int) -> Anchors:
    """Anchors of all windows; the leftmost of equal grams counts, so equal windows agree."""
    width = window - gram + 1
    lengths = np.diff(symbols.bounds)
    grams = gram_hashes(symbols.hashes, gram)
    none = np.zeros(0, np.int64)
    if len(grams) < width or not (lengths >= window).any():
        return Anchors(none, none, none, none, np.zeros(0, U64))
    low = U64((1 << POSITION_BITS) - 1)
    best = (grams & ~low) | np.arange(len(grams), dtype=U64)
    step = 1
    while step * 2 <= width:
        best = np.minimum(best[:-step], best[step:])
        step *= 2
    if step < width:
        best = np.minimum(best[: len(best) - (width - step)], best[width - step :])
    long = np.flatnonzero(lengths >= window)
    counts = lengths[long] - window + 1
    at = ranges(symbols.bounds[long], counts)
    anchor = (best[at] & low).astype(np.int64)
    text = np.repeat(long, counts)
    new = np.ones(len(at), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    windows = np.diff(np.append(first, len(at)))
    return Anchors(text[first], at[first], windows, anchor[first], grams[anchor[first]])


def repeated_places(
    docs: DataFrame, read: Reader, solve: Solver, window: int, gram: int, group_limit: int = GROUP_LIMIT
) -> tuple[DataFrame, DataFrame]:
    """Blocks of documents, and rows (blk, places, repeat, length) of repeats with their places."""
    blocks, count = block_documents(docs)

    def keys_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        parts = [anchors_of(read(raw, bounds), window, gram).key for _, _, raw, bounds in pieces(table["text"])]
        return np.unique(np.concatenate([np.zeros(0, U64), *parts]), return_counts=True)

    def regions(table: pa.Table, replies: pa.Table) -> pa.Table:
        keys, counts = reply_table(replies)
        cold: dict[str, list] = {"key": [], "blk": [], "places": [], "offset": [], "region": []}
        hot_keys, hot_places = [], []
        blk = table["blk"][0].as_py() if len(table) else 0
        docs_of = table["doc"].to_numpy()
        for begin, _, raw, bounds in pieces(table["text"]):
            symbols = read(raw, bounds)
            anchors = anchors_of(symbols, window, gram)
            known, at = in_sorted(anchors.key, keys)
            total = counts[at] if len(keys) else np.zeros(len(at), np.int64)
            doc = docs_of[begin + anchors.text]
            place = np.empty(len(doc), PLACE)
            place["doc"], place["windows"] = doc, anchors.windows
            place["start"] = anchors.first - symbols.bounds[anchors.text]
            chosen = np.flatnonzero(known & (total <= group_limit))
            stops = anchors.first + anchors.windows + window - 1
            cold["key"].append(anchors.key[chosen].view(np.int64))
            cold["offset"].append((anchors.anchor - anchors.first)[chosen].astype(np.int32))
            cold["places"] += [place[i : i + 1].tobytes() for i in chosen]
            cold["region"] += [symbols.cut(anchors.first[i], stops[i]) for i in chosen]
            hot = np.flatnonzero(known & (total > group_limit))
            if len(hot):
                whole = gram_hashes(symbols.hashes, window, 0x2545F4914F6CDD1D)
                each = ranges(anchors.first[hot], anchors.windows[hot])
                hot_keys.append(mix(whole[each] + U64(window)))
                one = np.empty(len(each), PLACE)
                one["doc"] = np.repeat(doc[hot], anchors.windows[hot])
                one["start"] = each - np.repeat(symbols.bounds[anchors.text[hot]], anchors.windows[hot])
                one["windows"] = 1
                hot_places.append(one)
        if hot_keys:
            hot_key, hot_place = np.concatenate(hot_keys), np.concatenate(hot_places)
            order = np.argsort(hot_key, kind="stable")
            hot_key, hot_place = hot_key[order], hot_place[order]
            first = np.flatnonzero(np.concatenate(([True], hot_key[1:] != hot_key[:-1])))
            ends = np.append(first[1:], len(hot_key))
            cold["key"].append(hot_key[first].view(np.int64))
            cold["offset"].append(np.full(len(first), FULL_WINDOW, np.int32))
            cold["places"] += [hot_place[i:j].tobytes() for i, j in zip(first, ends, strict=True)]
            cold["region"] += [None] * len(first)
        size = len(cold["places"])
        return pa.table(
            {
                "key": np.concatenate([np.zeros(0, np.int64), *cold["key"]]),
                "blk": np.full(size, blk, np.int32),
                "places": pa.array(cold["places"], pa.binary()),
                "offset": np.concatenate([np.zeros(0, np.int32), *cold["offset"]]),
                "region": pa.array(cold["region"], pa.binary()),
            }
        )

    def solve_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in grouped(batches):
            found = [x for group in rows if len(group) > 1 or len(group[0][2]) > PLACE.itemsize for x in solved(group)]
            if found:
                blk, places, repeat, length = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(blk, pa.int32()), pa.array(places, pa.binary()), pa.array(repeat, pa.int64()), pa.array(length, pa.int32())],
                    ["blk", "places", "repeat", "length"],
                )

    def solved(group: list[tuple]) -> Iterator[tuple[int, bytes, int, int]]:
        full = [x for x in group if x[3] == FULL_WINDOW]
        if sum(len(x[2]) for x in full) > PLACE.itemsize:
            for key, blk, places, _, _ in full:
                yield blk, spans(places, 0, window), key, window
        classes: dict[tuple[int, bytes], list[tuple]] = {}
        for row in group:
            if row[3] != FULL_WINDOW:
                classes.setdefault((row[3], row[4]), []).append(row)
        for (_, region), rows in classes.items():
            if len(rows) > 1:
                repeat = stable_hash(region)
                for _, blk, places, _, _ in rows:
                    length = int(np.frombuffer(places, PLACE)["windows"][0]) + window - 1
                    yield blk, spans(places, 0, length), repeat, length
        if len(classes) > 1:
            members = list(classes)
            for member, start, length, repeat in solve(members, window):
                for _, blk, places, _, _ in classes[members[member]]:
                    yield blk, spans(places, start, length), repeat, length

    replies = repeated_keys(blocks, count, keys_of)
    rows = with_replies(
        blocks, replies, regions, "key long, blk int, places binary, offset int, region binary"
    )
    dealt = rows.repartition("key").sortWithinPartitions("key")
    return blocks, dealt.mapInArrow(solve_groups, "blk int, places binary, repeat long, length int")


def stable_hash(data: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(data) - (1 << 63)


def spans(places: bytes, start: int, length: int) -> bytes:
    """Packed spans of a repeat that begins ``start`` symbols after each place."""
    given = np.frombuffer(places, PLACE)
    out = np.empty(len(given), SPAN)
    out["doc"], out["start"], out["length"] = given["doc"], given["start"] + start, length
    return out.tobytes()


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[list[list[tuple]]]:
    """Rows sorted by their first column, as groups of equal values, some groups at a time."""
    held: list[tuple] = []
    for batch in batches:
        groups: list[list[tuple]] = []
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and held[0][0] != row[0]:
                groups.append(held)
                held = []
            held.append(row)
        if groups:
            yield groups
    if held:
        yield [held]


def covered(table: pa.Table, found: pa.Table, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which symbols of a block's texts lie in a span, in a row, and the texts' offsets in them."""
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    parts = [np.frombuffer(x, SPAN) for x in found["places"].to_pylist()]
    span = np.concatenate(parts) if parts else np.zeros(0, SPAN)
    docs = table["doc"].to_numpy()
    order = np.argsort(docs, kind="stable")
    change = np.zeros(int(bounds[-1]) + 1, dtype=np.int64)
    left = np.searchsorted(docs[order], span["doc"], "left")
    right = np.searchsorted(docs[order], span["doc"], "right")
    row = order[ranges(left, right - left)] if len(span) else np.zeros(0, np.int64)
    start = bounds[row] + np.repeat(span["start"], right - left)
    np.add.at(change, start, 1)
    np.add.at(change, start + np.repeat(span["length"], right - left), -1)
    return np.cumsum(change[:-1]) > 0, bounds
