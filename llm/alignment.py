"""Two tokenizers' tokens of the same texts, aligned, and counts of the id pairs that they link.

Token ends come from spans: the character offsets of a ``tokenizers`` encoding and the byte spans of
a sentencepiece proto. They are coarse: tokens that split a character share its offsets, byte tokens
of one character have empty spans, and the space put before a text has none. A span that overlaps
no other is a cut; between cuts the ends are refined by the lengths of the tokens' decoded bytes, and
all decoded bytes are compared with the text. Where tokens of both end, a group ends; every token of one
in a group is linked with every token of the other.

Work is done once for each distinct chunk of a text. Chunks begin at a space or a line feed that follows
no white space, at a letter after a single line feed, and at punctuation after a letter A-Z or a-z. The
first tokenizer always splits there, and the second where none of its pieces holds both sides, which is
looked up in its vocabulary; if either is of another kind, a chunk is a whole text. New chunks are encoded
many at a time, behind a few characters that give each the start it has in texts. Chunks are told apart
by 64-bit hashes; a worker process remembers up to ``KNOWN_CHUNKS`` of them.

Texts are read twice. The first time tasks count, for each id pair, the documents that hold it
linked; the counts are summed in a table. The second time chunks are scored by the most frequent
pairs, at most ``SHARED_PAIRS`` of them, which each worker gets; rows of all other pairs of a document
are joined with the table, and none of these pairs is in more than its share of the rows.

Cases: null, empty and unfaithfully encoded texts (those with U+2581) have no tokens; of a very long
text only its distinct chunks are encoded, a long text without spaces is one chunk; equal rows
count each and get equal results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import sys
import uuid
from collections.abc import Callable, Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.blocks import small_batches
from llm.hashing import U64, in_sorted, pieces, ranges, word_hashes
from llm.storage import written
from llm.token_ids import byte_letters

KNOWN_CHUNKS = 700_000
KNOWN_BYTES = 48 << 20
SHARED_PAIRS = 1 << 20
# Chunks that are encoded together, in bytes.
LEARNED_BYTES = 1 << 15
# Groups with more links are summed up by distinct ids first.
WIDE_GROUP = 1 << 16
SPACE, LINE_FEED = 0x20, 0x0A
LETTER = np.zeros(256, dtype=bool)
LETTER[65:91] = LETTER[97:123] = True
# What stands before chunks that begin with a letter, or with anything else but a space.
BEFORE_LETTER, BEFORE_OTHER = b" a\n", b" a"
MARK = "▁"
PUNCTUATION = """!"#$%&'()*+,-./:;<=>?@[]^_`{|}~"""
CACHE = "_known_alignments"
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
SCORED = f"{ALIGNED}, n_best long, count_sum long, pairs array<long>, times array<long>"


def solid_ends(raw: np.ndarray) -> np.ndarray:
    """Bytes that end a character which is surely no white space."""
    solid = (raw > SPACE) & (raw != 0x7F)
    # The last byte of a character of two bytes after 0xC2, or of three that begin like white space does.
    solid[1:] &= raw[:-1] != 0xC2
    for first, second in ((0xE1, 0x9A), (0xE2, 0x80), (0xE2, 0x81), (0xE3, 0x80)):
        solid[2:] &= (raw[:-2] != first) | (raw[1:-1] != second)
    return solid


def chunk_starts(raw: np.ndarray, bounds: np.ndarray, solid: np.ndarray, closing: np.ndarray) -> np.ndarray:
    """Where chunks begin in texts that begin with a space each; ``closing`` are bytes that end a word."""
    starts = np.zeros(len(raw), dtype=bool)
    if not len(raw):
        return np.zeros(0, dtype=np.int64)
    letter = LETTER[raw]
    starts[1:] = ((raw[1:] == SPACE) | (raw[1:] == LINE_FEED)) & solid[:-1]
    starts[1:] |= closing[raw[1:]] & letter[:-1]
    starts[2:] |= letter[2:] & (raw[1:-1] == LINE_FEED) & solid[:-2]
    starts[bounds[:-1]] = True
    # A solid end of the text before says nothing.
    second = bounds[:-1] + 1
    starts[second[second < bounds[1:]]] = False
    return np.flatnonzero(starts)


def token_ends(begin: np.ndarray, end: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Byte ends of tokens: those of spans that overlap no other, refined between by decoded lengths."""
    if not len(end):
        return end
    coarse = end > begin
    coarse[:-1] &= begin[1:] >= end[:-1]
    decoded = np.cumsum(sizes)
    last = np.maximum.accumulate(np.where(coarse, np.arange(len(end)), -1))
    none = last < 0
    return np.where(none, 0, end[last]) + decoded - np.where(none, 0, decoded[last])


class Vocabulary:
    """Decoded bytes of all ids."""

    def __init__(self, entries: list[bytes]):
        self.size = np.fromiter(map(len, entries), np.int64, len(entries))
        self.first = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(entries), np.uint8)

    def decoded(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[ranges(self.first[ids], self.size[ids])]


class Tokenizers:
    """A byte-level tokenizer (A) and a sentencepiece model (B) with spans of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        names = self.a.get_vocab(with_added_tokens=True)
        entries = [b""] * (max(names.values()) + 1)
        bytes_of = {chr(letter): byte for byte, letter in byte_letters().items()}
        for name, i in names.items():
            entries[i] = bytes(bytes_of[c] for c in name) if all(c in bytes_of for c in name) else name.encode()
        self.vocabulary_a = Vocabulary(entries)
        own = [self.b.id_to_piece(i) for i in range(len(self.b))]
        self.vocabulary_b = Vocabulary(
            [bytes([int(x[3:5], 16)]) if self.b.is_byte(i) else x.replace(MARK, " ").encode() for i, x in enumerate(own)]
        )
        with open(path_a, encoding="utf-8") as file:
            parts = json.load(file)
        split = parts.get("pre_tokenizer") or {}
        self.by_chunks = (
            parts.get("normalizer") is None
            and split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
            and not any(x[i] == MARK != x[i - 1] for x in own for i in range(1, len(x)))
            and not any("\n" in x for x in own)
        )
        # Punctuation that no piece holds after a letter.
        joined = {x[i] for x in own for i in range(1, len(x)) if LETTER[ord(x[i - 1]) & 255] and x[i - 1].isascii()}
        self.closing = np.zeros(256, dtype=bool)
        self.closing[[ord(x) for x in PUNCTUATION if x not in joined]] = True

    def tokens_a(self, text: str, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and byte ends of A's tokens; ``raw`` is the text in bytes."""
        found = self.a.encode(text, add_special_tokens=False)
        ids = np.array(found.ids, dtype=np.int64)
        spans = np.array(found.offsets, dtype=np.int64).reshape(-1, 2)
        if len(text) != len(raw):
            # From characters to bytes.
            spans = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))[spans]
        return ids, token_ends(spans[:, 0], spans[:, 1], self.vocabulary_a.size[ids])

    def tokens_b(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids and byte ends of B's tokens; the first space of the text is the one that B puts there."""
        if len(text) == 1:
            return np.array([self.b.piece_to_id(MARK)], dtype=np.int64), np.ones(1, dtype=np.int64)
        found = self.b.encode(text[1:], return_type="proto").pieces
        ids = np.array([x.id for x in found], dtype=np.int64)
        spans = np.array([(x.begin, x.end) for x in found], dtype=np.int64).reshape(-1, 2)
        # The first span lacks the space before the text, all others are one byte further on.
        return ids, token_ends(spans[:, 0] + 1, spans[:, 1] + 1, self.vocabulary_b.size[ids])


def linked(ids_a, ids_b, group_a, group_b, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, pair, times) of linked ids, groups in order; a group may list a pair more than once."""
    count_a, count_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    first_b = np.cumsum(count_b) - count_b
    wide = count_a * count_b > WIDE_GROUP
    narrow = ~wide[group_a]
    repeat = count_b[group_a[narrow]]
    b = ids_b[ranges(first_b[group_a[narrow]], repeat)]
    parts = [(np.repeat(group_a[narrow], repeat), np.repeat(ids_a[narrow], repeat) << 32 | b, np.ones(len(b), np.int64))]
    for g in np.flatnonzero(wide):
        one, times_a = np.unique(ids_a[group_a == g], return_counts=True)
        two, times_b = np.unique(ids_b[group_b == g], return_counts=True)
        pair = (one[:, None] << 32 | two[None, :]).ravel()
        parts.append((np.full(len(pair), g), pair, np.outer(times_a, times_b).ravel()))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


class Chunks:
    """What is known of chunks: tokens, groups, links, and the pairs linked in each."""

    def __init__(self, tokenizers: Tokenizers, frequent: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None):
        self.tokenizers = tokenizers
        # Sorted pairs with their counts, and whether a pair's count is the highest of its A id.
        self.frequent = frequent
        # Counts of pairs that are no longer remembered.
        self.done: list[tuple[np.ndarray, np.ndarray]] = []
        self.pairs, self.documents = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.forget()

    def forget(self) -> None:
        self.count_anew()
        self.hashes, self.place = np.zeros(0, U64), np.zeros(0, np.int64)
        # Each chunk's tokens of A and of B, groups, links, sum of counts, best links; whether it fails.
        self.sums = np.zeros((7, 0), np.int64)
        self.groups: list[str] = []
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.linked, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        # Pairs by number, and sorted with their numbers.
        self.pairs, self.documents = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.sorted_pairs, self.numbers_of = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.bytes = 0

    def count_anew(self) -> None:
        """Lay the counts of documents aside and start with 0."""
        found = self.documents > 0
        if found.any():
            self.done.append((self.pairs[found], self.documents[found]))
        self.documents = np.zeros(len(self.pairs), np.int64)

    def look_up(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, solid: np.ndarray) -> np.ndarray:
        """Places of chunks among the known ones."""
        distinct, at, which = np.unique(word_hashes(raw, starts, ends), return_index=True, return_inverse=True)
        known, _ = in_sorted(distinct, self.hashes)
        new = at[~known]
        room = len(self.hashes) + len(new) <= KNOWN_CHUNKS and self.bytes + int((ends - starts)[new].sum()) <= KNOWN_BYTES
        if not room and len(self.hashes):
            self.forget()
            known[:], new = False, at
        chunks = [raw[i:j].tobytes() for i, j in zip(starts[new].tolist(), ends[new].tolist(), strict=True)]
        self.learn(distinct[~known], chunks, solid[ends[new] - 1])
        return self.place[np.searchsorted(self.hashes, distinct)][which]

    def learn(self, hashes: np.ndarray, chunks: list[bytes], solid: np.ndarray) -> None:
        if not chunks:
            return
        mark, by_chunks = MARK.encode(), self.tokenizers.by_chunks
        # A chunk that ends in white space, or in what may be some, is encoded alone, as at a text's end.
        order, alone, part, size = [], [], [], 0
        for i, (chunk, ends_solid) in enumerate(zip(chunks, solid.tolist(), strict=True)):
            if not by_chunks or not (ends_solid or chunk == b"\n") or mark in chunk:
                alone.append([i])
                continue
            part.append(i)
            size += len(chunk)
            if size >= LEARNED_BYTES:
                order, part, size = [*order, part], [], 0
        order += [part] if part else []
        order += alone
        found = [self.in_place([chunks[i] for i in part]) for part in order]
        sums, groups, sizes, pairs, times = zip(*found, strict=True)
        begin = len(self.size)
        size = np.concatenate(sizes)
        self.first = np.concatenate((self.first, len(self.linked) + np.cumsum(size) - size))
        self.size = np.concatenate((self.size, size))
        self.linked = np.concatenate((self.linked, self.numbers(np.concatenate(pairs))))
        self.times = np.concatenate((self.times, *times))
        self.sums = np.concatenate((self.sums, *sums), axis=1)
        for some in groups:
            self.groups += some
        self.bytes += sum(map(len, chunks))
        places = np.empty(len(chunks), np.int64)
        places[np.array([i for part in order for i in part], dtype=np.int64)] = begin + np.arange(len(chunks))
        spot = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, spot, hashes)
        self.place = np.insert(self.place, spot, places)

    def in_place(self, chunks: list[bytes]) -> tuple:
        """``aligned`` for chunks that need not begin with a space: each follows what it may follow in a text."""
        parts, own = [], []
        for chunk in chunks:
            if chunk[0] != SPACE:
                parts.append(BEFORE_LETTER if LETTER[chunk[0]] else BEFORE_OTHER)
            own.append(len(parts))
            parts.append(chunk)
        sums, groups, sizes, pairs, times = self.aligned(parts)
        if len(own) < len(parts):
            keep = np.zeros(len(parts), dtype=bool)
            keep[own] = True
            of_own = np.repeat(keep, sizes)
            sums, sizes, pairs, times = sums[:, keep], sizes[keep], pairs[of_own], times[of_own]
            groups = [groups[i] for i in own]
        return sums, groups, sizes, pairs, times

    def aligned(self, chunks: list[bytes]) -> tuple:
        """Sums, group texts, and linked pairs of chunks that follow each other."""
        data = b"".join(chunks)
        raw, text = np.frombuffer(data, np.uint8), data.decode()
        t = self.tokenizers
        ids_a, ends_a = t.tokens_a(text, raw)
        ids_b, ends_b = t.tokens_b(text)
        faithful = np.array_equal(t.vocabulary_a.decoded(ids_a), raw) and np.array_equal(t.vocabulary_b.decoded(ids_b), raw)
        chunk_ends = np.cumsum([len(x) for x in chunks])
        if not faithful:
            if len(chunks) > 2:
                raise ValueError("chunks are not encoded as by themselves")
            none, fails = np.zeros(0, np.int64), np.zeros((7, len(chunks)), np.int64)
            fails[6] = 1
            return fails, [""] * len(chunks), np.zeros(len(chunks), np.int64), none, none
        both = np.zeros(len(raw) + 1, np.uint8)
        both[ends_a] += 1
        both[ends_b] += 1
        cuts = np.flatnonzero(both == 2)
        if not (both[chunk_ends] == 2).all():
            raise ValueError("a token reaches over the end of a chunk")
        group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        chunk = np.searchsorted(chunk_ends, cuts)
        count_a, count_b = np.bincount(group_a, minlength=len(cuts)), np.bincount(group_b, minlength=len(cuts))
        group, pair, times = linked(ids_a, ids_b, group_a, group_b, len(cuts))
        where, pair, times = distinct_pairs(chunk[group], pair, times)
        sums = np.zeros((7, len(chunks)), np.int64)
        for row, values in enumerate((count_a, count_b, np.ones(len(cuts), np.int64), count_a * count_b)):
            np.add.at(sums[row], chunk, values)
        if self.frequent is not None:
            keys, counts, best = self.frequent
            known, at = in_sorted(pair, keys)
            np.add.at(sums[4], where[known], (times[known] * counts[at[known]]))
            np.add.at(sums[5], where[known], (times[known] * best[at[known]]))
            where, pair, times = where[~known], pair[~known], times[~known]
        a, b = list(map(str, ids_a.tolist())), list(map(str, ids_b.tolist()))
        stop_a, stop_b = np.cumsum(count_a).tolist(), np.cumsum(count_b).tolist()
        texts, i, j = [], 0, 0
        for k, m in zip(stop_a, stop_b, strict=True):
            texts.append(f"{a[i] if k - i == 1 else ','.join(a[i:k])}|{b[j] if m - j == 1 else ','.join(b[j:m])}")
            i, j = k, m
        stops = np.searchsorted(chunk, np.arange(1, len(chunks) + 1)).tolist()
        groups = [";".join(texts[i:j]) for i, j in zip([0, *stops[:-1]], stops, strict=True)]
        return sums, groups, np.bincount(where, minlength=len(chunks)), pair, times

    def numbers(self, pair: np.ndarray) -> np.ndarray:
        """Places of pairs in ``pairs``, which grows by the new ones."""
        distinct, which = np.unique(pair, return_inverse=True)
        known, _ = in_sorted(distinct, self.sorted_pairs)
        new = distinct[~known]
        spot = np.searchsorted(self.sorted_pairs, new)
        self.sorted_pairs = np.insert(self.sorted_pairs, spot, new)
        self.numbers_of = np.insert(self.numbers_of, spot, len(self.pairs) + np.arange(len(new)))
        self.pairs = np.concatenate((self.pairs, new))
        self.documents = np.concatenate((self.documents, np.zeros(len(new), np.int64)))
        return self.numbers_of[np.searchsorted(self.sorted_pairs, distinct)][which]

    def read(self, texts: pa.Array, work: Callable[[np.ndarray, np.ndarray, np.ndarray], None]) -> None:
        """``work`` on the first text, chunk places, and each text's offsets in them, part by part."""
        for first, _, raw, bounds in pieces(texts, 1 << 21):
            raw, bounds = np.insert(raw, bounds[:-1], SPACE), bounds + np.arange(len(bounds))
            solid, t = solid_ends(raw), self.tokenizers
            starts = chunk_starts(raw, bounds, solid, t.closing) if t.by_chunks else bounds[:-1]
            ends = np.append(starts[1:], len(raw))
            work(first, self.look_up(raw, starts, ends, solid), np.searchsorted(starts, bounds))

    def pairs_of(self, place: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, number, times) of the distinct pairs of each text."""
        total = max(1, len(self.size))
        some, count = np.unique(text * total + place, return_counts=True)
        text, place = some // total, some % total
        size = self.size[place]
        at = ranges(self.first[place], size)
        times = self.times[at] * np.repeat(count, size)
        total = max(1, len(self.pairs))
        key, which = np.unique(np.repeat(text, size) * total + self.linked[at], return_inverse=True)
        return key // total, key % total, np.bincount(which, weights=times, minlength=len(key)).astype(np.int64)

    def faithful(self, place: np.ndarray, offsets: np.ndarray, empty: np.ndarray) -> np.ndarray:
        """Which texts have tokens."""
        return ~empty & (per_text(self.sums[6][place], offsets) == 0)


def distinct_pairs(where: np.ndarray, pair: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal (where, pair) as one, with their times added."""
    order = np.lexsort((pair, where))
    where, pair, times = where[order], pair[order], times[order]
    if not len(where):
        return where, pair, times
    first = np.flatnonzero(np.concatenate(([True], (where[1:] != where[:-1]) | (pair[1:] != pair[:-1]))))
    return where[first], pair[first], np.add.reduceat(times, first)


def per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(values)))[offsets])


def known_chunks(path_a: str, path_b: str, frequent=None, name: str = "") -> Chunks:
    """What this process knows of two tokenizers' chunks; ``name`` stands for the frequent pairs' table."""
    kept = sys.modules.setdefault(CACHE, SimpleNamespace(chunks={}, name=None))
    if kept.name != (path_a, path_b, name):
        tokenizers = next(iter(kept.chunks.values())).tokenizers if kept.name and kept.name[:2] == (path_a, path_b) else None
        kept.chunks = {name: Chunks(tokenizers or Tokenizers(path_a, path_b), frequent)}
        kept.name = (path_a, path_b, name)
    chunks = kept.chunks[name]
    # Of a task that failed half-way counts may be left.
    chunks.count_anew()
    chunks.done.clear()
    return chunks


def empty_texts(texts: pa.Array) -> np.ndarray:
    return np.array([not x for x in texts.is_valid().to_pylist()]) | (
        pa.compute.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False) == 0
    )


def count_pairs(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(pair, documents): an A id times 2**32 and a B id, and how many documents hold them linked."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = known_chunks(path_a, path_b)
        for batch in batches:
            empty = empty_texts(batch["text"])

            def add(first: int, place: np.ndarray, offsets: np.ndarray, empty=empty) -> None:
                faithful = chunks.faithful(place, offsets, empty[first : first + len(offsets) - 1])
                text = np.repeat(np.arange(len(faithful)), np.diff(offsets))
                _, number, _ = chunks.pairs_of(place[faithful[text]], text[faithful[text]])
                chunks.documents += np.bincount(number, minlength=len(chunks.pairs))

            chunks.read(batch["text"], add)
            yield from counted(chunks)
        chunks.count_anew()
        yield from counted(chunks)

    def counted(chunks: Chunks) -> Iterator[pa.RecordBatch]:
        while chunks.done:
            pairs, documents = chunks.done.pop()
            yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(documents)], ["pair", "documents"])

    rows = docs.select("text").mapInArrow(count, "pair long, documents long")
    return rows.groupBy("pair").agg(F.sum("documents").alias("documents"))


def most_frequent(counts: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Pairs with at least so many documents that they are ``most`` or fewer, and all others."""
    steps = counts.groupBy(F.floor(F.log2("documents") * 8).alias("step")).agg(F.count("*").alias("n"))
    least, total = 0, 0
    # One row for each eighth of a doubling.
    for step, n in sorted(steps.collect(), reverse=True):
        total += n
        if total > most:
            least = step + 1
            break
    frequent = F.floor(F.log2("documents") * 8) >= least
    return counts.filter(frequent), counts.filter(~frequent)


def align_documents(docs: DataFrame, path_a: str, path_b: str, shared_pairs: int = SHARED_PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document.

    The counts of all pairs and the rows of documents are written to the shared folder while this is called.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    a_id = F.shiftright("pair", 32)
    # An A id has at most as many pairs as B has ids.
    highest = F.max("documents").over(Window.partitionBy(a_id))
    counts = written(count_pairs(docs, path_a, path_b), "pairs")
    counts = written(counts.select("pair", "documents", (F.col("documents") == highest).alias("best")), "pairs")
    frequent, rare = most_frequent(counts, shared_pairs)
    table = frequent.toArrow().sort_by("pair")
    shared = spark.sparkContext.broadcast(
        (table["pair"].to_numpy(), table["documents"].to_numpy(), table["best"].to_numpy().astype(np.int64))
    )

    name = uuid.uuid4().hex

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = known_chunks(path_a, path_b, shared.value, name)
        for batch in batches:
            empty = empty_texts(batch["text"])
            out: list[pa.RecordBatch] = []

            def add(first: int, place: np.ndarray, offsets: np.ndarray, empty=empty, batch=batch, out=out) -> None:
                faithful = chunks.faithful(place, offsets, empty[first : first + len(offsets) - 1])
                sums = [per_text(x[place], offsets) * faithful for x in chunks.sums[:6]]
                texts = list(map(chunks.groups.__getitem__, place.tolist()))
                groups = [
                    hashlib.sha256(";".join(texts[i:j]).encode()).hexdigest() if ok else ""
                    for i, j, ok in zip(offsets[:-1].tolist(), offsets[1:].tolist(), faithful.tolist(), strict=True)
                ]
                text = np.repeat(np.arange(len(faithful)), np.diff(offsets))
                some = faithful[text] & (chunks.size[place] > 0)
                of_text, number, times = chunks.pairs_of(place[some], text[some])
                cuts = pa.array(np.searchsorted(of_text, np.arange(len(faithful) + 1)).astype(np.int32))
                out.append(
                    pa.RecordBatch.from_arrays(
                        [
                            batch["doc_id"].slice(first, len(faithful)),
                            *[pa.array(x) for x in sums[:4]],
                            pa.array(groups, pa.string()),
                            pa.array(sums[5]),
                            pa.array(sums[4]),
                            pa.ListArray.from_arrays(cuts, pa.array(chunks.pairs[number])),
                            pa.ListArray.from_arrays(cuts, pa.array(times)),
                        ],
                        ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum", "pairs", "times"],
                    )
                )

            chunks.read(batch["text"], add)
            yield from out

    rows = written(docs.mapInArrow(score, SCORED).withColumn("row", F.monotonically_increasing_id()), "aligned")
    rest = rows.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    rest = rest.join(rare, "pair").groupBy("row").agg(
        F.sum(F.col("times") * F.col("documents")).alias("more_count"),
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
    )
    whole = rows.drop("pairs", "times").join(rest, "row", "left")
    return whole.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_count", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
