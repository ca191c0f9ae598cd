"""Substring dedup over words: deep nodes of prefix-partitioned suffix trees.

The suffixes of all texts, as sequences of words, are split by prefix: by their first eight words
at sampled places, and by a whole window where more suffixes share that prefix than fit in memory
(see ``llm.repeats``). For each prefix the subtree is built: suffixes descend together while
they agree, and a node is where they part. A node whose depth, with the words they share before
the prefix, reaches the window is a repeat of all suffixes below it.

Cases: null and empty texts have no words; texts with fewer words than the window are kept; equal
rows repeat each other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from llm.blocks import with_replies
from llm.hashing import text_bytes, word_hashes, words_of
from llm.repeats import Region, Symbols, covered, repeated_places, stable_hash

WINDOW = 35
PREFIX = 8
DIGEST = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def read_words(raw: np.ndarray, bounds: np.ndarray) -> Symbols:
    starts, ends, offsets = words_of(raw, bounds)
    return Symbols(raw, offsets, word_hashes(raw, starts, ends), starts, ends)


def subtree(right: list[list[bytes]]) -> Iterator[tuple[int, list[int]]]:
    """(depth, suffixes below) of every inner node of the suffix tree of one prefix."""
    open_nodes = [(0, list(range(len(right))))]
    while open_nodes:
        depth, below = open_nodes.pop()
        while True:
            children: dict[bytes | None, list[int]] = {}
            for i in below:
                children.setdefault(right[i][depth] if depth < len(right[i]) else None, []).append(i)
            if len(children) > 1 or None in children:
                break
            depth += 1
        yield depth, below
        open_nodes += [(depth, x) for word, x in children.items() if word is not None and len(x) > 1]


def shared(first: list[bytes], second: list[bytes]) -> int:
    count = 0
    for a, b in zip(first, second, strict=False):
        if a != b:
            break
        count += 1
    return count


def deep_nodes(members: list[Region], window: int) -> Iterator[tuple[int, int, int, int]]:
    """(member, start, length, repeat) of repeats of at least ``window`` words among regions.

    A member is (words before the shared prefix, text); no two are equal.
    """
    words = [region.split() for _, region in members]
    right = [x[offset:] for x, (offset, _) in zip(words, members, strict=True)]
    left = [x[:offset][::-1] for x, (offset, _) in zip(words, members, strict=True)]
    farthest = max(len(x) for x in left)
    best: list[set[tuple[int, int]]] = [set() for _ in members]
    for depth, below in subtree(right):
        if depth + farthest < window:
            continue
        below = sorted(below, key=left.__getitem__)
        for a, b in zip(below[:-1], below[1:], strict=True):
            reach = shared(left[a], left[b])
            if reach + depth >= window:
                best[a].add((reach, depth))
                best[b].add((reach, depth))
    for member, found in enumerate(best):
        deepest = -1
        for reach, depth in sorted(found, reverse=True):
            if depth > deepest:
                deepest = depth
                start = members[member][0] - reach
                repeat = stable_hash(b" ".join(words[member][start : start + reach + depth]))
                yield member, start, reach + depth, repeat


def remove_repeated_words(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document what is left without the words of repeats: ``DIGEST`` plus ``kept`` text."""
    blocks, places = repeated_places(docs, read_words, deep_nodes, window, PREFIX)

    def apply(table: pa.Table, found: pa.Table) -> pa.Table:
        texts = [x.encode() for x in table["text"].to_pylist()]
        words = [x.split() for x in texts]
        sizes = np.array([len(x) for x in words], dtype=np.int64)
        mask, bounds = covered(table, found, sizes)
        removed = np.concatenate(([0], np.cumsum(mask)))
        count = removed[bounds[1:]] - removed[bounds[:-1]]
        kept = [
            b" ".join(compress(x, ~mask[i:j]) if n else x)
            for x, i, j, n in zip(words, bounds[:-1], bounds[1:], count, strict=True)
        ]
        return pa.table(
            {
                "doc_id": table["doc_id"],
                "n_words": sizes,
                "n_removed": count,
                "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
                "kept": pa.array([x.decode() for x in kept], pa.string()),
            }
        )

    return with_replies(blocks, places.select("blk", "places"), apply, DIGEST + ", kept string")
