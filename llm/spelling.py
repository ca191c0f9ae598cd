"""Spelling variants: each word with its near words, from pairs of trie nodes.

All prefixes of all words are nodes of a trie and all suffixes nodes of a reversed one; both are
numbered by a scan over the sorted words. Cut at a place, a word is a pair of integers (prefix
node, suffix node). Two words differ by a replaced code point exactly if a pair of each that leaves
out one code point is the same; one has one more code point than the other exactly if such a pair of
the longer one is a pair of the other cut in two. So near words are exact, and no distance is
computed. A pair is shared by at most as many words as there are code points to leave out, and one
more; these are summed up where they meet (how many, the most frequent ones), without listing pairs
of words. Work and memory are linear in the words' lengths.

A trie node is new in the sorted list where a word goes on after what it shares with the word before.
Ranges of the list are numbered apart; the shared start of two neighbouring ranges, one row for each
range, is settled on the driver.

Cases: null and empty texts have no words; a null id counts as an empty one in the hash; equal
rows each count; of near words with equal counts the first in code-point order wins; very long texts
are read whole, and very long words cost what their length is; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.blocks import small_batches
from llm.decontamination import FOLD
from llm.hashing import pieces, word_hashes, words_of
from llm.storage import written

MIN_CHARS = 5
MIN_COUNT = 3
TIMES_AS_FREQUENT = 2
MISSPELT_EVERY = 97
HELD_WORDS = 300_000
# Runs up to here have their checksum from that of the id; longer ones are hashed one by one.
SHORT_RUN = 64
RANGE_CHARS = 400_000
PATHS = "part int, word string, n long, path array<long>, fresh array<boolean>, made long"

# Bytes of the letters A-Z and a-z. U+00C0 to U+00FF are 0xC3 and one more byte.
LETTER = np.zeros(256, dtype=bool)
LETTER[65:91] = LETTER[97:123] = True
FIRST_OF_TWO = 0xC3
SPACE = 0x20

CRC_TABLE = np.array([zlib.crc32(bytes([i])) ^ zlib.crc32(b"\0") for i in range(256)], dtype=np.uint32)


def crc_after(crcs: np.ndarray, count: int) -> np.ndarray:
    """Checksums of texts, carried over 0 to ``count`` more bytes; xor with the bytes' own gives the whole."""
    out = np.empty((count + 1, len(crcs)), dtype=np.uint32)
    out[0] = crcs
    for i in range(count):
        out[i + 1] = (out[i] >> np.uint32(8)) ^ CRC_TABLE[out[i] & np.uint32(255)]
    return out


def letter_runs(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with A-Z lower-cased and a space for all that is no letter; starts, ends and offsets of runs."""
    inside = LETTER[raw] | (raw == FIRST_OF_TWO)
    inside[1:] |= raw[:-1] == FIRST_OF_TWO
    symbols = np.where(inside, FOLD[raw], np.uint8(SPACE))
    return symbols, *words_of(symbols, bounds)


def without(run: str, at: int) -> str:
    return run[:at] + run[at + 1 :]


class WordCounter:
    """Counts the words of texts; ``every`` says which runs lose a code point, 0 for none."""

    def __init__(self, every: int, least_chars: int):
        self.every = every
        self.least = least_chars
        self.counts: dict[bytes, int] = {}

    def read(self, ids: list, texts: pa.Array) -> None:
        for first, end, raw, bounds in pieces(texts, 1 << 20):
            symbols, starts, ends, offsets = letter_runs(raw, bounds)
            if len(starts):
                self.read_runs(ids[first:end], symbols, starts, ends, offsets)

    def read_runs(self, ids, symbols, starts, ends, offsets) -> None:
        hashes = word_hashes(symbols, starts, ends)
        _, at, which, count = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
        data = symbols.tobytes()
        runs = [data[i:j] for i, j in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
        if self.every:
            text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
            for i in self.misspelt(ids, runs, which, text, starts, ends).tolist():
                count[which[i]] -= 1
                run = runs[which[i]].decode()
                known = zlib.crc32(f"{ids[text[i]]}:{run}".encode())
                self.add(without(run, known % len(run)).encode(), 1)
        # Bytes that go on a code point don't count as characters.
        more = np.concatenate(([0], np.cumsum((symbols & 0xC0) == 0x80)))
        chars = ends[at] - starts[at] - (more[ends[at]] - more[starts[at]])
        kept = np.flatnonzero((chars >= self.least) & (count > 0))
        counts, known = self.counts, self.counts.get
        for i, n in zip(kept.tolist(), count[kept].tolist(), strict=True):
            run = runs[i]
            counts[run] = known(run, 0) + n

    def misspelt(self, ids, runs, which, text, starts, ends) -> np.ndarray:
        """Places of the runs whose checksum, after the id's, is divisible by ``every``."""
        of_run = np.array([zlib.crc32(x) for x in runs], dtype=np.uint32)
        of_id = np.array([zlib.crc32(f"{x}:".encode()) for x in ids], dtype=np.uint32)
        carried = crc_after(of_id, SHORT_RUN)
        size = ends - starts
        whole = carried[np.minimum(size, SHORT_RUN), text] ^ of_run[which]
        for i in np.flatnonzero(size > SHORT_RUN).tolist():
            whole[i] = zlib.crc32(runs[which[i]], int(of_id[text[i]]))
        return np.flatnonzero(whole % np.uint32(self.every) == 0)

    def add(self, run: bytes, n: int) -> None:
        if len(run.decode()) >= self.least:
            self.counts[run] = self.counts.get(run, 0) + n

    def flush(self) -> pa.RecordBatch:
        words, counts = list(self.counts), list(self.counts.values())
        self.counts.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())], ["word", "n"]
        )


def count_words(
    docs: DataFrame, every: int = MISSPELT_EVERY, least_chars: int = MIN_CHARS, least: int = MIN_COUNT
) -> DataFrame:
    """(word, n) of all words of ``least_chars`` or more that occur ``least`` times or more."""
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = WordCounter(every, least_chars)
        for batch in batches:
            counter.read(["" if x is None else x for x in batch["doc_id"].to_pylist()], batch["text"])
            if len(counter.counts) > HELD_WORDS:
                yield counter.flush()
        yield counter.flush()

    rows = docs.select("doc_id", "text").filter(F.col("text").isNotNull())
    counted = rows.mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def shared_start(a: str, b: str) -> int:
    """How many code points two words share at the start."""
    size = min(len(a), len(b))
    for i in range(size):
        if a[i] != b[i]:
            return i
    return size


def trie_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted words of a range with the numbers of all their prefixes, counted from 1 in the range.

    ``fresh`` marks code points that differ from the one before, ``made`` is the last number given.
    """
    last, path, made = "", [0], 0
    for batch in batches:
        paths, fresh, upto = [], [], []
        for word in batch["key"].to_pylist():
            shared = shared_start(last, word)
            path = path[: shared + 1] + list(range(made + 1, made + len(word) - shared + 1))
            made += len(word) - shared
            last = word
            paths.append(path)
            fresh.append([i == 0 or word[i] != word[i - 1] for i in range(len(word))])
            upto.append(made)
        yield pa.RecordBatch.from_arrays(
            [
                batch["part"],
                batch["word"],
                batch["n"],
                pa.array(paths, pa.list_(pa.int64())),
                pa.array(fresh, pa.list_(pa.bool_())),
                pa.array(upto, pa.int64()),
            ],
            ["part", "word", "n", "path", "fresh", "made"],
        )


def joined_ranges(ends: list) -> list[tuple[int, list[int], int]]:
    """(part, numbers of what a range's first word shares with the range before, shift of all others)."""
    out: list[tuple[int, list[int], int]] = []
    last, path, made = "", [0], 0
    for part, first_word, last_word, last_path, count in ends:
        shared = shared_start(last, first_word)
        known, shift = path[: shared + 1], made - shared
        out.append((part, known, shift))
        path = [known[x] if x <= shared else x + shift for x in last_path]
        last, made = last_word, made + count - shared
    return out


def numbered(words: DataFrame, ranges: int, backward: bool) -> DataFrame:
    """(word, n, path, fresh): the numbers of the trie nodes on each word's way, read backward or not.

    Node 0 is the empty prefix; numbers ascend in the order of the prefixes.
    """
    key = F.reverse("word") if backward else F.col("word")
    ordered = words.select(key.alias("key"), "word", "n").repartitionByRange(ranges, "key").sortWithinPartitions("key")
    local = ordered.select(F.spark_partition_id().alias("part"), "*").mapInArrow(trie_paths, PATHS)
    local = written(local, "suffixes" if backward else "prefixes")
    way = F.col("path")
    # A range's words in the key's order are in the order of their last node.
    end = F.element_at(way, -1)
    ends = local.groupBy("part").agg(
        F.min_by("word", end).alias("first_word"), F.max_by("word", end).alias("last_word"),
        F.max_by("path", end).alias("path"), F.max("made").alias("made"),
    )
    # One row for each range.
    spark = words.sparkSession
    turn = -1 if backward else 1
    found = [(r.part, r.first_word[::turn], r.last_word[::turn], r.path, r.made) for r in ends.collect()]
    fixed = spark.createDataFrame(joined_ranges(sorted(found)), "part int, known array<long>, shift long")
    whole = F.transform(
        way, lambda x: F.when(x < F.size("known"), F.get("known", x.cast("int"))).otherwise(x + F.col("shift"))
    )
    return local.join(F.broadcast(fixed), "part").select("word", "n", whole.alias("path"), "fresh")


def node_pairs(words: DataFrame) -> DataFrame:
    """(node, word, n, pairs) of distinct words; ``node`` is the word's own, ``pairs`` its integer pairs.

    A pair's ``kind`` is 0 if it is the word cut in two, 1 if a code point is left out between, and 2 if
    that is the first of a run of equal ones, so that each shorter word is met once.
    """
    size = words.agg(F.sum(F.char_length("word"))).first()[0] or 0
    ranges = max(1, -(-size // RANGE_CHARS))
    forward = numbered(words, ranges, False).withColumnRenamed("path", "before")
    backward = numbered(words, ranges, True).select("word", F.col("path").alias("after"))
    both = forward.join(backward, "word")
    length = F.size("fresh")
    skipped = F.transform(
        F.sequence(F.lit(0), length - 1),
        lambda i: F.struct(
            F.get("before", i).alias("prefix"),
            F.get("after", length - 1 - i).alias("suffix"),
            F.when(F.get("fresh", i), 2).otherwise(1).alias("kind"),
        ),
    )
    cut = F.transform(
        F.sequence(F.lit(0), length),
        lambda i: F.struct(
            F.get("before", i).alias("prefix"), F.get("after", length - i).alias("suffix"), F.lit(0).alias("kind")
        ),
    )
    return both.select(F.element_at("before", -1).alias("node"), "word", "n", F.concat(skipped, cut).alias("pairs"))


def near_words(pairs: DataFrame) -> DataFrame:
    """(node, n_near, best): how many words are near, and (n, minus its node) of the first of them."""
    rows = pairs.select("node", "n", F.inline("pairs"))
    pair = Window.partitionBy("prefix", "suffix")
    me = F.struct("n", (-F.col("node")).alias("minus"))
    left_out, once = F.col("kind") > 0, F.col("kind") == 2
    met = rows.select(
        "*",
        me.alias("me"),
        F.count_if(left_out).over(pair).alias("replaced"),
        F.count_if(once).over(pair).alias("longer"),
        F.max(F.when(~left_out, me)).over(pair).alias("whole"),
    ).filter("replaced > 1 or (whole is not null and longer > 0)")
    met = met.withColumns(
        {
            "top": F.max(F.when(left_out, F.col("me"))).over(pair),
            "top_longer": F.max(F.when(once, F.col("me"))).over(pair),
        }
    )
    met = met.withColumn("next", F.max(F.when(left_out & (F.col("me") != F.col("top")), F.col("me"))).over(pair))
    other = F.when(F.col("me") != F.col("top"), F.col("top")).otherwise(F.col("next"))
    shorter = F.when(once, F.col("whole"))
    each = met.select(
        "node",
        F.when(left_out, F.col("replaced") - 1 + F.when(shorter.isNotNull(), 1).otherwise(0))
        .otherwise(F.col("longer"))
        .alias("n_near"),
        F.when(left_out, F.greatest(other, shorter)).otherwise(F.col("top_longer")).alias("best"),
    ).filter("n_near > 0")
    return each.groupBy("node").agg(F.sum("n_near").alias("n_near"), F.max("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(node, root) of rows (node, form): the end of each way from form to form, by doubled steps.

    Counts at least double on each step, so ways are short and have no circles. Each round is written.
    """
    now = written(forms.select("node", F.col("form").alias("root")), "forms")
    while True:
        onward = now.select(F.col("node").alias("root"), F.col("root").alias("next"))
        after = now.join(onward, "root", "left").select("node", F.coalesce("next", "root").alias("root"), "next")
        after = written(after, "forms")
        if after.filter("next is not null").isEmpty():
            return after.select("node", "root")
        now = after.select("node", "root")


def group_variants(words: DataFrame, times: int = TIMES_AS_FREQUENT) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of distinct words (word, n).

    A word's form is the near word of largest n, if that is ``times`` its own at least. Tables of the
    tries and the forms are written to the shared folder while this is called.
    """
    pairs = written(node_pairs(written(words, "words")), "pairs")
    near = written(near_words(pairs), "near")
    known = pairs.select("node", "word", "n").join(near, "node", "left").select(
        "node", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("best.n") >= F.col("n") * times, -F.col("best.minus")).alias("form_node"),
    )
    ends = roots(known.filter("form_node is not null").select("node", F.col("form_node").alias("form")))
    form = pairs.select(F.col("node").alias("form_node"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    root = pairs.select(F.col("node").alias("root_node"), F.col("word").alias("root_word"))
    named = known.join(form, "form_node", "left").join(ends.withColumnRenamed("root", "root_node"), "node", "left")
    return named.join(root, "root_node", "left").select(
        "word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame) -> DataFrame:
    """The variants among the words of all documents."""
    return group_variants(count_words(docs))
