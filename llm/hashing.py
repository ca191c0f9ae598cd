"""Vectorised hashing of many texts at once, for code that runs inside Spark tasks.

An Arrow string column is one byte buffer with offsets, so a batch of texts is hashed as one
array; nothing here loops over characters or words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
GOLDEN = U64(0x9E3779B97F4A7C15)
SECOND = U64(0xD6E8FEB86659FD93)
BYTE_FACTOR = 0x5851F42D4C957F2D

# Word separators: space and the control characters 0x09 to 0x0D.
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(values: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    out = values ^ (values >> U64(32))
    out *= SECOND
    out ^= out >> U64(29)
    out *= GOLDEN
    out ^= out >> U64(32)
    return out


def pieces(column: pa.Array | pa.ChunkedArray, size: int = 1 << 18) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, end, bytes, offsets) of texts of about ``size`` bytes, whose arrays stay in the processor's cache."""
    raw, bounds = text_bytes(column)
    start = 0
    while start < len(bounds) - 1:
        stop = max(start + 1, int(np.searchsorted(bounds, bounds[start] + size, "right")) - 1)
        yield start, stop, raw[bounds[start] : bounds[stop]], bounds[start : stop + 1] - bounds[start]
        start = stop


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and the n + 1 offsets of the texts; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def powers(factor: int, count: int) -> np.ndarray:
    out = np.full(count, factor, dtype=U64)
    if count:
        out[0] = 1
    return np.cumprod(out, dtype=U64)


def words_of(
    raw: np.ndarray, bounds: np.ndarray, separator: np.ndarray = SEPARATOR
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the n + 1 offsets of the texts in the word list."""
    if not len(raw):
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, np.zeros(len(bounds), dtype=np.int64)
    inside = ~separator[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    # A text's end also ends its last word.
    edges = bounds[1:-1]
    edges = edges[(edges > 0) & (edges < len(raw))]
    first[edges] |= inside[edges]
    last[edges - 1] |= inside[edges - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, bounds)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word, a polynomial of its bytes."""
    if not len(starts):
        return np.zeros(0, dtype=U64)
    weights = powers(BYTE_FACTOR, len(raw) + 1)
    total = np.zeros(len(raw) + 1, dtype=U64)
    np.cumsum((raw.astype(U64) + U64(1)) * weights[:-1], out=total[1:], dtype=U64)
    inverse = powers(pow(BYTE_FACTOR, -1, 2**64), len(raw) + 1)
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(U64))


def gram_hashes(symbols: np.ndarray, length: int, factor: int = BYTE_FACTOR) -> np.ndarray:
    """Hash of every run of ``length`` symbols, by doubling; shorter than the input by length - 1."""
    count = len(symbols) - length + 1
    if count <= 0:
        return np.zeros(0, dtype=U64)
    power, part, part_length = factor | 1, symbols, 1
    out, out_length, rest = None, 0, length
    while True:
        if rest & 1:
            if out is None:
                out, out_length = part, part_length
            else:
                size = len(symbols) - out_length - part_length + 1
                out = out[:size] * U64(power) + part[out_length : out_length + size]
                out_length += part_length
        rest >>= 1
        if not rest:
            return mix(out[:count])
        size = len(symbols) - 2 * part_length + 1
        part = part[:size] * U64(power) + part[part_length : part_length + size]
        power = power * power % 2**64
        part_length *= 2


def byte_symbols(raw: np.ndarray) -> np.ndarray:
    return (raw.astype(U64) + U64(1)) * GOLDEN


def in_sorted(values: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values are in a sorted table, and where."""
    if not len(table):
        return np.zeros(len(values), dtype=bool), np.zeros(len(values), dtype=np.int64)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[at] == values, at


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All of start, start + 1, ... for each start and count, in a row."""
    total = int(counts.sum())
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) if total else 0
    return np.arange(total, dtype=np.int64) + shift
