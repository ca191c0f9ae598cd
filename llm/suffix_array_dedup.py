"""Suffix-array dedup: maximal repeats of bytes from the common-prefix interval tree.

Suffixes that start with one gram are a group (see ``llm.repeats``). In a group the suffixes are
sorted, the lengths of common prefixes of neighbours are computed, and a stack scan over them
visits every interval of the common-prefix interval tree. An interval's suffixes continue
differently to the right, so its depth cannot grow; sorted by what stands before them, a second
scan finds where they differ to the left. A set that differs on both sides is a maximal repeat,
given with all places where it is not part of a longer one.

Cases: null and empty texts have no repeats; texts shorter than the window are kept whole; equal
rows repeat each other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.blocks import with_replies
from llm.hashing import byte_symbols, text_bytes
from llm.repeats import SPAN, Region, Symbols, covered, repeated_places, stable_hash

WINDOW = 200
GRAM = 32
DIGEST = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
OCCURRENCES = "repeat_id long, n_bytes int, doc_id long, start int"


def read_bytes(raw: np.ndarray, bounds: np.ndarray) -> Symbols:
    return Symbols(raw, bounds, byte_symbols(raw), None, None)


def intervals(prefixes: list[int]) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of every interval, from common prefixes of neighbours (first is 0)."""
    stack: list[tuple[int, int]] = []
    for i in range(1, len(prefixes) + 1):
        depth = prefixes[i] if i < len(prefixes) else -1
        first = i - 1
        while stack and stack[-1][0] > depth:
            top, first = stack.pop()
            yield top, first, i - 1
        if not stack or stack[-1][0] < depth:
            stack.append((depth, first))


def neighbours(texts: list[bytes]) -> list[int]:
    """Length of the common prefix of each text with the one before it; 0 for the first."""
    return [0, *(len(commonprefix(pair)) for pair in zip(texts[:-1], texts[1:], strict=True))]


def longest(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, repeat) of those spans that lie in no other."""
    out: list[tuple[int, int, int]] = []
    for span in sorted(set(found), key=lambda x: (x[0], -x[1])):
        if not out or span[1] > out[-1][1]:
            out.append(span)
    return out


def maximal_repeats(members: list[Region], window: int) -> Iterator[tuple[int, int, int, int]]:
    """(member, start, length, repeat) of repeats of at least ``window`` bytes among regions.

    A member is (offset of the shared gram, bytes); no two are equal.
    """
    right = [region[offset:] for offset, region in members]
    left = [region[:offset][::-1] for offset, region in members]
    suffixes = sorted(range(len(members)), key=right.__getitem__)
    prefixes = neighbours([right[i] for i in suffixes])
    rank = {i: n for n, i in enumerate(suffixes)}
    before = {i: n for n, i in enumerate(sorted(range(len(members)), key=left.__getitem__))}
    farthest = max(len(x) for x in left)
    found: list[list[tuple[int, int, int]]] = [[] for _ in members]
    for depth, first, last in intervals(prefixes):
        if depth + farthest < window:
            continue
        inside = sorted(suffixes[first : last + 1], key=before.__getitem__)
        borders = [i for i in range(first + 1, last + 1) if prefixes[i] == depth]
        for reach, low, high in intervals(neighbours([left[i] for i in inside])):
            if reach + depth < window:
                continue
            group = inside[low : high + 1]
            ranks = [rank[i] for i in group]
            if not any(min(ranks) < border <= max(ranks) for border in borders):
                continue  # the same continuation: a deeper interval has it
            offset, region = members[group[0]]
            repeat = stable_hash(region[offset - reach : offset + depth])
            for i in group:
                found[i].append((members[i][0] - reach, members[i][0] + depth, repeat))
    for member, spans in enumerate(found):
        for start, end, repeat in longest(spans):
            yield member, start, end - start, repeat


def repeat_groups(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows (repeat_id, n_bytes, doc_id, start) of all places of maximal repeats.

    A place inside a longer repeat of the same document at the same gram is left to that repeat.
    """
    blocks, places = repeated_places(docs, read_bytes, maximal_repeats, window, GRAM)

    def name(table: pa.Table, found: pa.Table) -> pa.Table:
        ids = dict(zip(table["doc"].to_pylist(), table["doc_id"].to_pylist(), strict=True))
        rows = set()
        for packed, repeat in zip(found["places"].to_pylist(), found["repeat"].to_pylist(), strict=True):
            for doc, start, length in np.frombuffer(packed, SPAN).tolist():
                rows.add((repeat, length, ids[doc], start))
        columns = list(zip(*sorted(rows, key=str), strict=True)) or [[]] * 4
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["repeat_id", "n_bytes", "doc_id", "start"])

    return with_replies(blocks, places.select("blk", "places", "repeat"), name, OCCURRENCES)


def remove_repeated_bytes(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document what is left without the bytes of repeats: ``DIGEST`` plus ``kept`` bytes."""
    blocks, places = repeated_places(docs, read_bytes, maximal_repeats, window, GRAM)

    def apply(table: pa.Table, found: pa.Table) -> pa.Table:
        raw, bounds = text_bytes(table["text"])
        mask, _ = covered(table, found, np.diff(bounds))
        edge = np.diff(np.concatenate((mask[:1], mask)).astype(np.int8)) == 1
        edge[:1] = mask[:1]
        edge[bounds[1:-1][bounds[1:-1] < len(mask)]] |= mask[bounds[1:-1][bounds[1:-1] < len(mask)]]
        removed = np.concatenate(([0], np.cumsum(mask)))
        runs = np.concatenate(([0], np.cumsum(edge)))
        kept = [raw[i:j][~mask[i:j]].tobytes() for i, j in zip(bounds[:-1], bounds[1:], strict=True)]
        return pa.table(
            {
                "doc_id": table["doc_id"],
                "n_bytes": np.diff(bounds),
                "n_removed": removed[bounds[1:]] - removed[bounds[:-1]],
                "n_spans": runs[bounds[1:]] - runs[bounds[:-1]],
                "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
                "kept": pa.array(kept, pa.binary()),
            }
        )

    return with_replies(blocks, places.select("blk", F.col("places")), apply, DIGEST + ", kept binary")
