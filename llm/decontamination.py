"""Benchmark decontamination by embedded windows, bit-sampling LSH and exact verification.

Texts and items are sequences of lower-case words without marks; in scripts written without spaces
(Chinese and Japanese, Thai, Lao, Burmese, Khmer) each character is a word. A window is as long as an item.
The CGK random walk copies the word under its cursor to each step of its output and moves on by a
random bit of word and step; sequences of small edit distance get outputs of small Hamming
distance. Several walks are each sampled at a few steps many times over; a window is a candidate
for every item of its length with which it shares a sample. Candidates are verified by the exact edit
distance, in words, between the item and the best-fitting part of the text.

Windows are laid only where they can match: within the tolerance some three words in a row of the
item are unchanged, so a window starts where such three words put it.

The benchmark is read in blocks of bounded size (``BLOCK_ITEMS``); each block is matched with all
documents, so its size has no limit and no shuffle of documents is needed.

Items with fewer than ``LEAST_WORDS`` words are allowed no edits; they are found word for word, by a hash of
the whole.

Cases: null and empty texts match nothing, nor do items without words; very long texts are read piece by
piece of the input; equal items and equal rows match alike; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.blocks import small_batches
from llm.hashing import GOLDEN, SECOND, U64, gram_hashes, in_sorted, mix, pieces, ranges, text_bytes, word_hashes, words_of

SEED_WORDS = 3
LEAST_WORDS = 5
EDITS = 0.2
WALKS = 3
SAMPLES = 32
STEPS = 2
BLOCK_ITEMS = 5_000
BLOCK_BYTES = 8 << 20
BATCH_WINDOWS = 20_000

# Words are letters, digits and bytes over 127; all else parts them.
BREAK = np.ones(256, dtype=bool)
BREAK[48:58] = BREAK[65:91] = BREAK[97:123] = BREAK[128:] = False
SPACE = 0x20
# Ranges of code points of scripts without spaces, and of wide marks, as the first two bytes in UTF-8.
UNSPACED = (
    (0xE0B8, 0xE0BB), (0xE180, 0xE182), (0xE19E, 0xE19F), (0xE2BA, 0xE2BF), (0xE381, 0xE9BF), (0xEFA4, 0xEFAB),
    (0xF0A0, 0xF0B1),
)
WIDE_MARKS = ((0xE380, 0xE380), (0xEFBC, 0xEFBC))
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
MATCHES = "doc_id long, item_id long, start_word int, n_edits int, n_item_words int"


def normal_words(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all lower-case words in a row, and the texts' offsets in them."""
    folded, bounds = with_characters_apart(FOLD[raw], bounds)
    starts, ends, offsets = words_of(folded, bounds, BREAK)
    return word_hashes(folded, starts, ends), offsets


def with_characters_apart(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with spaces around characters of scripts without spaces, and for wide marks."""
    lead = np.flatnonzero(raw >= 0xE0)
    if not len(lead):
        return raw, bounds
    pair = raw[lead].astype(np.int64) << 8 | raw[lead + 1]
    marks = np.zeros(len(lead), dtype=bool)
    for low, high in WIDE_MARKS:
        marks |= (pair >= low) & (pair <= high)
    # Wide letters and digits share their first two bytes with wide marks.
    third = raw[lead + 2]
    marks &= ~((pair == 0xEFBC) & ((third >= 0x90) & (third <= 0x99) | (third >= 0xA1) & (third <= 0xBA)))
    apart = np.zeros(len(lead), dtype=bool)
    for low, high in UNSPACED:
        apart |= (pair >= low) & (pair <= high)
    if marks.any():
        for i in range(3):
            raw[lead[marks] + i] = SPACE
    first = lead[apart]
    if not len(first):
        return raw, bounds
    cuts = np.sort(np.concatenate((first, first + np.where(raw[first] >= 0xF0, 4, 3))))
    return np.insert(raw, cuts, SPACE), bounds + np.searchsorted(cuts, bounds, "left")


def tolerance(words: int) -> int:
    """Edits allowed for an item: a fifth of its words, as long as a seed must survive them."""
    return max(0, min(int(EDITS * words), (words - SEED_WORDS) // SEED_WORDS))


def walk(rows: np.ndarray, sizes: np.ndarray, number: int) -> np.ndarray:
    """CGK outputs of padded sequences, one column each; zero after the end of a sequence."""
    count, width = rows.shape
    flat = np.concatenate((rows, np.zeros((count, 1), dtype=U64)), axis=1).ravel()
    first = np.arange(count) * (width + 1)
    cursor, last = first.copy(), first + sizes
    out = np.empty((STEPS * width, count), dtype=U64)
    for step in range(STEPS * width):
        word = flat[cursor]
        out[step] = word
        salt = (number << 32 | step) * int(GOLDEN) & (2**64 - 1)
        turn = (word ^ U64(salt)) * SECOND
        cursor = np.minimum(cursor + (turn >> U64(63)).astype(np.int64), last)
    return out


def samples(rows: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """One key per sequence for each sample of each walk: its length and two steps' words.

    The steps are random and the same for sequences of one length. Where a sequence has ended there
    is no key, which is 0.
    """
    every = np.arange(len(rows))
    for number in range(WALKS):
        out = walk(rows, sizes, number)
        for sample in range(SAMPLES):
            random = np.random.default_rng([number, sample])
            first, second = random.random(2)
            one, two = out[(first * STEPS * sizes).astype(np.int64), every], out[(second * STEPS * sizes).astype(np.int64), every]
            key = mix(one * GOLDEN + two + sizes.astype(U64))
            yield np.where((one == 0) | (two == 0), U64(0), key)


@dataclass(frozen=True)
class Items:
    """A block of the benchmark: item ids, words, and where each seed stands in which item."""

    ids: list
    words: list[np.ndarray]
    seeds: np.ndarray
    seed_item: np.ndarray
    seed_place: np.ndarray
    rows: np.ndarray
    sizes: np.ndarray
    keys: list[tuple[np.ndarray, np.ndarray]]
    # Items of few words follow the others in ids and words; by length their hashes, sorted, and places.
    short: dict[int, tuple[np.ndarray, np.ndarray]]


def items_of(ids: list, texts: list[str]) -> Items:
    hashes, offsets = normal_words(*text_bytes(pa.array(texts, pa.large_string())))
    every = [(item, hashes[offsets[i] : offsets[i + 1]]) for i, item in enumerate(ids)]
    known = [item for item, x in every if len(x) >= LEAST_WORDS]
    words = [x for _, x in every if len(x) >= LEAST_WORDS]
    grams = [gram_hashes(x, SEED_WORDS) for x in words]
    seeds = np.concatenate([np.zeros(0, U64), *grams])
    owner = np.repeat(np.arange(len(grams)), [len(x) for x in grams]) if grams else np.zeros(0, np.int64)
    place = ranges(np.zeros(len(grams), np.int64), np.array([len(x) for x in grams], np.int64))
    order = np.argsort(seeds, kind="stable")
    sizes = np.array([len(x) for x in words], dtype=np.int64)
    rows = np.zeros((len(words), int(sizes.max(initial=0))), dtype=U64)
    for row, x in zip(rows, words, strict=True):
        row[: len(x)] = x
    keys = []
    for sample in samples(rows, sizes) if words else ():
        held = np.argsort(sample, kind="stable")
        held = held[sample[held] != 0]
        keys.append((sample[held], held))
    few = [(item, x) for item, x in every if 0 < len(x) < LEAST_WORDS]
    short = {}
    for length in sorted({len(x) for _, x in few}):
        at = np.array([len(words) + i for i, (_, x) in enumerate(few) if len(x) == length], dtype=np.int64)
        whole = np.array([gram_hashes(x, length)[0] for _, x in few if len(x) == length], dtype=U64)
        held = np.argsort(whole, kind="stable")
        short[length] = (whole[held], at[held])
    known, all_words = known + [item for item, _ in few], words + [x for _, x in few]
    return Items(known, all_words, seeds[order], owner[order], place[order], rows, sizes, keys, short)


def verbatim(hashes: np.ndarray, offsets: np.ndarray, items: Items) -> Iterator[tuple[int, int, int]]:
    """(text, item, first word) of the first place of each item of few words in each text."""
    for length, (table, held) in items.short.items():
        grams = gram_hashes(hashes, length)
        at = np.flatnonzero(in_sorted(grams, table)[0])
        text = np.searchsorted(offsets, at, "right") - 1
        inside = at + length <= offsets[text + 1]
        at, text = at[inside], text[inside]
        left, right = (np.searchsorted(table, grams[at], side) for side in ("left", "right"))
        item = held[ranges(left, right - left)]
        text, at = np.repeat(text, right - left), np.repeat(at, right - left)
        _, first = np.unique(text * len(items.ids) + item, return_index=True)
        yield from zip(text[first].tolist(), item[first].tolist(), (at - offsets[text])[first].tolist(), strict=True)


def windows_of(hashes: np.ndarray, offsets: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, first word within the text, length) at which an item may begin."""
    none = np.zeros(0, np.int64)
    grams = gram_hashes(hashes, SEED_WORDS)
    if not len(grams) or not len(items.seeds):
        return none, none, none
    hit, _ = in_sorted(grams, items.seeds)
    at = np.flatnonzero(hit)
    text = np.searchsorted(offsets, at, "right") - 1
    inside = at + SEED_WORDS <= offsets[text + 1]
    at, text = at[inside], text[inside]
    left, right = (np.searchsorted(items.seeds, grams[at], side) for side in ("left", "right"))
    which = ranges(left, right - left)
    text, at = np.repeat(text, right - left), np.repeat(at, right - left)
    length = items.sizes[items.seed_item[which]]
    start = at - items.seed_place[which] - offsets[text]
    found = np.unique(np.stack((text, start, length), axis=1), axis=0)
    return found[:, 0], found[:, 1], found[:, 2]


def cut(hashes: np.ndarray, offsets: np.ndarray, text: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    """Words from ``start`` on, one row each; zero outside of the text."""
    at = (offsets[text] + start)[:, None] + np.arange(width)
    inside = (at >= offsets[text][:, None]) & (at < offsets[text + 1][:, None])
    return np.where(inside, hashes[np.clip(at, 0, max(0, len(hashes) - 1))], U64(0))


def candidates(rows: np.ndarray, sizes: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """(window, item) pairs that share a sample."""
    found = [np.zeros(0, dtype=np.int64)]
    for mine, (table, held) in zip(samples(rows, sizes), items.keys, strict=True):
        known, left = in_sorted(mine, table)
        window = np.flatnonzero(known & (mine != 0))
        left = np.searchsorted(table, mine[window], "left")
        size = np.searchsorted(table, mine[window], "right") - left
        found.append(np.repeat(window, size) * len(items.ids) + held[ranges(left, size)])
    both = np.unique(np.concatenate(found))
    return both // max(1, len(items.ids)), both % max(1, len(items.ids))


def fitting_edits(items: np.ndarray, sizes: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Edit distance between each item and the part of its text that fits best, row by row."""
    columns = np.arange(texts.shape[1] + 1, dtype=np.int32)
    best = np.zeros((len(items), texts.shape[1] + 1), dtype=np.int32)
    for i in range(items.shape[1]):
        change = best[:, :-1] + (texts != items[:, i : i + 1])
        step = best + 1
        step[:, 1:] = np.minimum(step[:, 1:], change)
        step = np.minimum.accumulate(step - columns, axis=1) + columns
        best = np.where((i < sizes)[:, None], step, best)
    return best.min(axis=1)


def matches(column: pa.Array, items: Items) -> list[tuple[int, int, int, int]]:
    """(row, item, first word of the window, edits) of the best match for each row and item."""
    out: dict[tuple[int, int], tuple[int, int]] = {}
    if not items.ids:
        return []
    allowed = np.array([tolerance(int(x)) for x in items.sizes], dtype=np.int64)
    width, slack = items.rows.shape[1], int(allowed.max(initial=0))
    held: list[tuple[np.ndarray, ...]] = []
    count = 0

    def settle() -> None:
        row, start, size, text = (np.concatenate(x) for x in zip(*held, strict=True))
        body = np.where(np.arange(width) < size[:, None], text[:, slack : slack + width], U64(0))
        window, item = candidates(body, size, items)
        for at in range(0, len(window), BATCH_WINDOWS):
            w, i = window[at : at + BATCH_WINDOWS], item[at : at + BATCH_WINDOWS]
            edits = fitting_edits(items.rows[i], items.sizes[i], text[w])
            for k in np.flatnonzero(edits <= allowed[i]):
                key = (int(row[w[k]]), int(i[k]))
                value = (int(edits[k]), max(0, int(start[w[k]])))
                out[key] = min(out.get(key, value), value)

    for begin, _, raw, bounds in pieces(column):
        hashes, offsets = normal_words(raw, bounds)
        for t, i, s in verbatim(hashes, offsets, items):
            out[begin + t, i] = (0, s)
        text, start, size = windows_of(hashes, offsets, items)
        for at in range(0, len(text), BATCH_WINDOWS):
            t, s = text[at : at + BATCH_WINDOWS], start[at : at + BATCH_WINDOWS]
            wide = cut(hashes, offsets, t, s - slack, width + 2 * slack)
            held.append((begin + t, s, size[at : at + BATCH_WINDOWS], wide))
            count += len(t)
            if count >= BATCH_WINDOWS:
                settle()
                held.clear()
                count = 0
    if held:
        settle()
    return [(row, item, start, edits) for (row, item), (edits, start) in sorted(out.items())]


def benchmark_blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The items, a bounded number at a time; an item of many bytes makes blocks smaller."""
    rows = benchmark.filter("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    count, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-count // BLOCK_ITEMS), -(-size // BLOCK_BYTES))
    for number in range(blocks):
        mine = rows if blocks == 1 else rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number)
        table = mine.distinct().toArrow()
        order = sorted(zip(table["item_id"].to_pylist(), table["text"].to_pylist(), strict=True), key=str)
        yield items_of([x for x, _ in order], [x for _, x in order])


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows ``MATCHES``: every document and item that match, with the fewest edits found."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = docs.sparkSession.createDataFrame([], MATCHES)
    for items in benchmark_blocks(benchmark):

        def match(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column("doc_id").to_pylist()
                found = [
                    (ids[row], items.ids[item], start, edits, len(items.words[item]))
                    for row, item, start, edits in matches(batch.column("text"), items)
                ]
                if found:
                    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
                    names = [x.split()[0] for x in MATCHES.split(", ")]
                    columns = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        out = out.unionByName(rows.mapInArrow(match, MATCHES))
    return out


def drop_leaking(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no item is found, with all their columns."""
    small_batches(docs.sparkSession)
    for items in benchmark_blocks(benchmark):

        def clean(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[[row for row, _, _, _ in matches(batch.column("text"), items)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
