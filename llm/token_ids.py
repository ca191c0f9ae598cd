"""Token ids of many texts, each distinct word encoded once.

Tokenizers of this kind drop white space and never look past it, so the ids of a text are those of its
words in a row. Words are told apart by 64-bit hashes of a batch at once; only new ones are split
by the tokenizer's own pattern, and their pieces given to its model. What a worker has learned
stays with its process for later tasks, up to ``KNOWN_WORDS`` words. Tokenizers of other kinds, and
words of letters whose case or composition is not simple, are encoded by the whole tokenizer.
"""

from __future__ import annotations

import json
import os
import sys
from array import array
from itertools import chain
from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from llm.hashing import U64, in_sorted, pieces, ranges, word_hashes, words_of

KNOWN_WORDS = 600_000
KNOWN_PIECES = 100_000
BATCH_BYTES = 4 << 20
# Up to here letters change case one by one and are composed already; the one exception is U+0130.
SIMPLE = 0x250
CACHE = "_known_token_ids"


def byte_letters() -> dict[int, int]:
    """The usual printable stand-ins of bytes: themselves if visible, else letters from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return {b: b if b in visible else next(hidden) for b in range(256)}


class Pieces(dict):
    """Place of each piece's ids in a row of all; a new piece is given to the model when it is asked for."""

    def __init__(self, model, letters: dict[int, int]):
        self.model = model
        self.letters = letters
        self.forget()

    def forget(self) -> None:
        """Known pieces: none but the line break, which has no ids, at place 0."""
        self.clear()
        self["\n"] = 0
        self.flat = array("I")
        self.ends = array("q", [0])

    def __missing__(self, piece: str) -> int:
        # Visible ASCII stands for itself.
        plain = piece.isascii() and piece.isprintable()
        written = piece if plain else piece.encode().decode("latin-1").translate(self.letters)
        self.flat.extend([x.id for x in self.model.tokenize(written)])
        self.ends.append(len(self.flat))
        self[piece] = place = len(self)
        return place

    def ids_of(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces at these places, in a row, and how many each has."""
        # Copies, since arrays that numpy looks into cannot grow.
        ends = np.array(self.ends, dtype=np.int64)
        size = np.diff(ends, prepend=0)
        return np.array(self.flat, dtype=np.uint32)[ranges((ends - size)[place], size[place])], size[place]


class WordIds:
    """Encodes texts with one tokenizer file; ``end`` closes every text."""

    def __init__(self, path: str, end: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end = end
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        self.by_words = by_words(parts)
        if self.by_words:
            self.special = [x["content"] for x in parts["added_tokens"]]
            pattern = parts["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
            self.pattern = regex.compile(rf"(?:{pattern})|\n")
        self.letters = byte_letters()
        self.pieces = Pieces(self.tokenizer.model, self.letters)
        self.forget()

    def forget(self) -> None:
        """Known words: sorted hashes, and for each where its ids are; place 0 is the end of a text."""
        self.hashes = np.zeros(0, dtype=U64)
        self.place = np.zeros(0, dtype=np.int64)
        self.flat = np.array([self.end], dtype=np.uint32)
        self.first = np.array([0], dtype=np.int64)
        self.size = np.array([1], dtype=np.int64)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each closed by the end, and how many each has."""
        ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for start, stop, raw, bounds in pieces(column, BATCH_BYTES):
            some = self.by_word(raw, bounds) if self.by_words else self.by_text(column.slice(start, stop - start))
            ids.append(some[0])
            counts.append(some[1])
        return np.concatenate(ids), np.concatenate(counts)

    def by_text(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = [x or "" for x in column.to_pylist()]
        ids = [[*x.ids, self.end] for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for x in ids for i in x), np.uint32, int(counts.sum())), counts

    def by_word(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, ends, offsets = words_of(raw, bounds)
        distinct, at, which = np.unique(word_hashes(raw, starts, ends), return_index=True, return_inverse=True)
        if len(self.hashes) + len(distinct) > KNOWN_WORDS:
            self.forget()
        known, _ = in_sorted(distinct, self.hashes)
        self.learn(distinct[~known], words_at(raw, starts[at[~known]], ends[at[~known]]))
        place = self.place[np.searchsorted(self.hashes, distinct)][which] if len(distinct) else which
        # Each text is its words and the end, whose place is 0.
        texts = len(bounds) - 1
        order = np.zeros(len(place) + texts, dtype=np.int64)
        order[np.arange(len(place)) + np.repeat(np.arange(texts), np.diff(offsets))] = place
        sizes = self.size[order]
        total = np.concatenate(([0], np.cumsum(sizes)))
        counts = np.diff(total[offsets + np.arange(texts + 1)])
        return self.flat[ranges(self.first[order], sizes)], counts

    def learn(self, hashes: np.ndarray, words: list[str]) -> None:
        if not words:
            return
        flat, size = self.ids_of(words)
        place = len(self.size) + np.arange(len(size))
        self.first = np.concatenate((self.first, len(self.flat) + np.cumsum(size) - size))
        self.flat = np.concatenate((self.flat, flat))
        self.size = np.concatenate((self.size, size))
        at = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.place = np.insert(self.place, at, place)

    def ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words without white space, in a row, and how many each has."""
        simple = [x.isascii() or max(x) < chr(SIMPLE) and "İ" not in x for x in words]
        whole = "\n".join(words)
        if any(s in whole for s in self.special):
            simple = [plain and not any(s in x for s in self.special) for x, plain in zip(words, simple, strict=True)]
        if all(simple):
            return self.ids_of_simple(words)
        odd = [x for x, plain in zip(words, simple, strict=True) if not plain]
        known_flat, known_size = self.ids_of_simple([x for x, plain in zip(words, simple, strict=True) if plain])
        odd_ids = [x.ids for x in self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)] if odd else []
        odd_size = np.fromiter(map(len, odd_ids), np.int64, len(odd_ids))
        flat = np.concatenate((known_flat, np.fromiter(chain.from_iterable(odd_ids), np.uint32, int(odd_size.sum()))))
        size = np.concatenate((known_size, odd_size))
        # Back to the order of the words.
        first = np.cumsum(size) - size
        order = np.empty(len(words), dtype=np.int64)
        order[np.concatenate((np.flatnonzero(simple), np.flatnonzero(~np.array(simple))))] = np.arange(len(words))
        return flat[ranges(first[order], size[order])], size[order]

    def ids_of_simple(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words that are only lower-cased and split into pieces."""
        if not words:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        found = self.pattern.findall("\n".join(words).lower())
        if len(self.pieces) > KNOWN_PIECES:
            self.pieces.forget()
        place = np.fromiter(map(self.pieces.__getitem__, found), np.int64, len(found))
        flat, sizes = self.pieces.ids_of(place)
        # A break stands between two words.
        word = np.cumsum(place == 0)
        return flat, np.bincount(word, sizes, len(words)).astype(np.int64)


def words_at(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    """The words at these places, none of which holds a line break."""
    if not len(starts):
        return []
    size = ends - starts
    joined = np.full(int(size.sum()) + len(size), 10, dtype=np.uint8)
    behind = np.cumsum(size + 1)
    joined[ranges(behind - size - 1, size)] = raw[ranges(starts, size)]
    return joined[:-1].tobytes().decode().split("\n")


def by_words(parts: dict) -> bool:
    """Whether a tokenizer splits at white space and drops it, in the form handled by ``WordIds``."""
    normal = [x.get("type") for x in (parts.get("normalizer") or {}).get("normalizers", [])]
    split = (parts.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (
        normal == ["NFC", "Replace", "Lowercase"]
        and [x.get("type") for x in split] == ["Split", "ByteLevel"]
        and split[0].get("behavior") == "Removed"
        and split[0].get("invert") is True
        and "Regex" in split[0].get("pattern", {})
        and not split[1].get("add_prefix_space")
        and not split[1].get("use_regex")
        and parts["model"].get("type") == "BPE"
    )


def known_words(path: str, end: int) -> WordIds:
    """This process's encoder of a tokenizer file."""
    kept = sys.modules.setdefault(CACHE, SimpleNamespace(encoders={})).encoders
    if (path, end) not in kept:
        kept[path, end] = WordIds(path, end)
    return kept[path, end]
