"""Line dedup by pairwise alignment.

The shortest runs of lines with ``BLOCK_CHARS`` characters are taken forward from every line and
backward from every line, so every block that can go is made of them, however short its lines are. A
run that several documents share belongs to the earliest of them. A later document is paired with the
owners of all its shared runs. There is one pair for each owner, not one for each two documents.
Each pair is aligned by patience diff on line hashes: lines that occur once on both sides are
anchors, the longest chain of them in order is kept, and equal lines next to anchors join them. Runs of aligned lines with at least
``BLOCK_CHARS`` characters are deleted from the later document.

With ``any_order`` what the chain leaves over is aligned once more without regard to order, so blocks
that stand elsewhere in the owner go too. Where no line repeats inside a document, this removes what
the alignment of all pairs of documents would remove: every common block is made of shared runs, and
each run's owner is aligned with the document. Without it a block stays where its owner has it in
another order, also if a third document between the two has it in the same.

A later document's lines travel once to the task that reads its owners' lines one after another;
documents with very many owners, and owners of very many documents, are repeated in parts.

Earlier means the smaller (id, hash of id and text), null ids last. Cases: null text stays null and
empty text empty; a very long text is one row, and a task holds the lines of one later document and
one owner at a time; blank lines match only beside others; lines repeated inside one document stay;
rows equal in id and text count as one document; an empty table gives no rows; other columns
are kept, but for ``n_chars``, which follows the text.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.blocks import small_batches
from llm.hashing import GOLDEN, U64, mix
from llm.storage import written

OWNER_PAIRS = 1_000
LATER_PAIRS = 200
BLOCK_CHARS = 24
LAST_ID = 2**63 - 1
ORDER = "decimal(38,0)"


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest chain with rising second members; the first ones rise already."""
    tops: list[int] = []
    piles: list[int] = []
    before = [-1] * len(pairs)
    for i, (_, j) in enumerate(pairs):
        at = bisect_left(tops, j)
        before[i] = piles[at - 1] if at else -1
        if at == len(tops):
            tops.append(j)
            piles.append(i)
        else:
            tops[at], piles[at] = j, i
    chain = []
    i = piles[-1] if piles else -1
    while i >= 0:
        chain.append(pairs[i])
        i = before[i]
    return chain[::-1]


def patience(first: list[int], second: list[int]) -> list[tuple[int, int]]:
    """Aligned places of two lists of lines, in order."""
    out: list[tuple[int, int]] = []
    open_ranges = [(0, len(first), 0, len(second))]
    while open_ranges:
        a, a_end, b, b_end = open_ranges.pop()
        while a < a_end and b < b_end and first[a] == second[b]:
            out.append((a, b))
            a, b = a + 1, b + 1
        while a < a_end and b < b_end and first[a_end - 1] == second[b_end - 1]:
            a_end, b_end = a_end - 1, b_end - 1
            out.append((a_end, b_end))
        if a == a_end or b == b_end:
            continue
        here, there = Counter(first[a:a_end]), Counter(second[b:b_end])
        place = {second[j]: j for j in range(b, b_end) if there[second[j]] == 1}
        anchors = [(i, place[first[i]]) for i in range(a, a_end) if here[first[i]] == 1 and first[i] in place]
        chain = increasing(anchors)
        for i, j in chain:
            out.append((i, j))
        edges = [(a - 1, b - 1), *chain, (a_end, b_end)]
        if chain:
            open_ranges += [
                (i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges[:-1], edges[1:], strict=True) if k > i + 1 and m > j + 1
            ]
    return sorted(out)


def moved(first: list[int], second: list[int], aligned: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Aligned places in any order among the lines left over: those that are single on both sides, and equal ones beside them."""
    here, there = {i for i, _ in aligned}, {j for _, j in aligned}
    out: list[tuple[int, int]] = []
    while True:
        ours = Counter(x for i, x in enumerate(first) if i not in here)
        theirs = Counter(x for j, x in enumerate(second) if j not in there)
        place = {x: j for j, x in enumerate(second) if j not in there and theirs[x] == 1}
        before = len(out)
        for i, x in enumerate(first):
            if i in here or ours[x] != 1 or x not in place or place[x] in there:
                continue
            a, b = i, place[x]
            while a and b and a - 1 not in here and b - 1 not in there and first[a - 1] == second[b - 1]:
                a, b = a - 1, b - 1
            while a < len(first) and b < len(second) and a not in here and b not in there and first[a] == second[b]:
                here.add(a)
                there.add(b)
                out.append((a, b))
                a, b = a + 1, b + 1
        if len(out) == before:
            return out


def common_lines(first: list[int], second: list[int], chars: list[int], least: int = BLOCK_CHARS, any_order: bool = False) -> list[int]:
    """Lines of the second list in aligned blocks with at least ``least`` characters."""
    out: list[int] = []
    block: list[int] = []
    last = (-2, -2)
    chain = patience(first, second)
    if any_order:
        chain = sorted(chain + moved(first, second, chain))
    for pair in [*chain, (-2, -2)]:
        if block and (pair[0] != last[0] + 1 or pair[1] != last[1] + 1):
            if sum(chars[j] for j in block) >= least:
                out += block
            block = []
        block.append(pair[1])
        last = pair
    return out


def line_tables(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents with their place in the order, and the written table of their line hashes."""
    doc = F.xxhash64("doc_id", "text")
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).cast("decimal(28,0)")
    order = (place * F.lit(10**10).cast("decimal(11,0)") + F.pmod(doc, F.lit(10**10))).cast(ORDER)
    taken = [x for x in docs.columns if x.lower() not in ("_order", "_removed")]
    ordered = docs.select(*taken, order.alias("_order"))
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)
    hashes = ordered.select(
        "_order",
        F.transform(lines, lambda x: F.when(F.trim(x) == "", F.lit(0)).otherwise(F.xxhash64(x))).alias("hashes"),
        F.transform(lines, lambda x: F.length(x)).alias("chars"),
    )
    return ordered, written(hashes.dropDuplicates(["_order"]), "lines")


def run_keys(hashes: np.ndarray, chars: np.ndarray, offsets: np.ndarray, least: int = BLOCK_CHARS) -> tuple[np.ndarray, np.ndarray]:
    """(text, key) of the shortest runs of at least ``least`` characters from and to every line that is not blank."""
    ends = np.cumsum(chars.astype(np.int64))
    starts = ends - chars
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    every = np.arange(len(hashes))
    first = np.concatenate((every, np.searchsorted(starts, ends - least, "right") - 1))
    last = np.concatenate((np.searchsorted(ends, starts + least, "left"), every))
    whole = np.tile(hashes != 0, 2)
    both = np.tile(text, 2)
    whole &= (first >= offsets[both]) & (last < offsets[both + 1])
    first, last, both = first[whole], last[whole], both[whole]
    # Sums of lines times powers of an odd number; its inverse brings a run to the place 0.
    power = np.cumprod(np.full(len(hashes), GOLDEN, U64))
    inverse = np.cumprod(np.full(len(hashes), U64(pow(int(GOLDEN), -1, 2**64)), U64))
    sums = np.concatenate((np.zeros(1, U64), np.cumsum(mix(hashes.view(U64)) * power)))
    keys = mix((sums[last + 1] - sums[first]) * inverse[first] + (last - first).astype(U64)).view(np.int64)
    found = np.unique(np.stack((both, keys), axis=1), axis=0)
    return found[:, 0], found[:, 1]


def pairs_of(lines: DataFrame) -> DataFrame:
    """(owner, later): each document with the earliest holders of its shared runs of lines."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("hashes")
            offsets = np.concatenate(([0], np.cumsum(pa.compute.list_value_length(column).to_numpy())))
            values = (batch.column(x).flatten().to_numpy() for x in ("hashes", "chars"))
            text, keys = run_keys(*values, offsets)
            yield pa.RecordBatch.from_arrays([batch.column("_order").take(pa.array(text)), pa.array(keys)], ["_order", "run"])

    held = lines.mapInArrow(runs, f"_order {ORDER}, run long")
    owners = held.groupBy("run").agg(F.min("_order").alias("owner"), F.max("_order").alias("last"))
    # A table of its own, so that Spark can split the runs that very many documents hold.
    owners = written(owners.filter("owner < last").select("run", "owner"), "owners")
    shared = held.join(owners, "run").filter("owner < _order")
    return shared.select("owner", F.col("_order").alias("later")).distinct()


def in_parts(pairs: DataFrame, side: str, least: int, part: str) -> DataFrame:
    """(side, part): in how many parts those with over ``least`` pairs are dealt out; at most pairs / least rows."""
    count = pairs.groupBy(side).agg(F.count("*").alias("n")).filter(F.col("n") > least)
    return written(count.select(side, F.ceil(F.col("n") / least).cast("int").alias(part)), part)


def removed_lines(lines: DataFrame, any_order: bool = False) -> DataFrame:
    """(_order, _removed): numbers of lines that go from each later document."""
    pairs = written(pairs_of(lines), "pairs")
    owner_parts = in_parts(pairs, "owner", OWNER_PAIRS, "owner_part")
    later_parts = in_parts(pairs, "later", LATER_PAIRS, "later_part")

    def dealt(part: str, by: str) -> F.Column:
        return F.pmod(F.xxhash64(by), F.coalesce(part, F.lit(1))).cast("int").alias(part)

    def repeated(part: str) -> F.Column:
        return F.explode(F.sequence(F.lit(0), F.coalesce(part, F.lit(1)) - 1)).alias(part)

    placed = pairs.join(owner_parts, "owner", "left").join(later_parts, "later", "left")
    placed = placed.select("owner", "later", dealt("owner_part", "later"), dealt("later_part", "owner"))
    owner = lines.select(F.col("_order").alias("owner"), "hashes").join(owner_parts, "owner", "left")
    owner = owner.select("owner", repeated("owner_part"), "hashes")
    later = lines.select(F.col("_order").alias("later"), "hashes", "chars").join(later_parts, "later", "left")
    later = later.select("later", repeated("later_part"), F.lit(0).alias("side"), "hashes", "chars")
    chars = F.lit(None).cast("array<int>").alias("chars")
    owner = placed.join(owner, ["owner", "owner_part"]).select("later", "later_part", F.lit(1).alias("side"), "hashes", chars)
    key = ["later", "later_part"]
    both = later.unionByName(owner).repartition(*key).sortWithinPartitions(*key, "side")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        second, sizes = None, None
        for batch in batches:
            ids, gone = [], []
            for place, (side, hashes) in enumerate(zip(batch.column("side").to_pylist(), batch.column("hashes"), strict=True)):
                if side == 0:
                    second, sizes = hashes, batch.column("chars")[place]
                    continue
                if isinstance(second, pa.Scalar):
                    second, sizes = second.as_py(), sizes.as_py()
                found = common_lines(hashes.as_py(), second, sizes, any_order=any_order)
                if found:
                    ids.append(place)
                    gone.append(np.array(found, "<i4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("later").take(pa.array(ids, pa.int64())), pa.array(gone, pa.binary())], ["_order", "gone"]
            )

    aligned = both.mapInArrow(align, f"_order {ORDER}, gone binary")
    return aligned.groupBy("_order").agg(F.collect_set("gone").alias("_removed"))


def remove_common_lines(docs: DataFrame, any_order: bool = False) -> DataFrame:
    """All columns of the documents with what is left of ``text``, and ``n_lines`` and ``n_removed``."""
    small_batches(docs.sparkSession)
    ordered, lines = line_tables(docs)
    joined = ordered.join(removed_lines(lines, any_order), "_order", "left")
    kept = [x for x in docs.columns if x.lower() not in ("n_lines", "n_removed", "_order", "_removed")]
    fields = {x.name: x.dataType.simpleString() for x in docs.schema.fields}

    def delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, total, gone = [], [], []
            for text, packed in zip(batch.column("text").to_pylist(), batch.column("_removed").to_pylist(), strict=True):
                removed = {i for x in packed or () for i in np.frombuffer(x, "<i4").tolist()}
                lines = text.split("\n") if text is not None else []
                total.append(len(lines))
                gone.append(len(removed))
                texts.append("\n".join(x for i, x in enumerate(lines) if i not in removed) if removed else text)
            columns = [pa.array(texts, pa.string()) if x == "text" else batch.column(x) for x in kept]
            columns += [pa.array(total, pa.int64()), pa.array(gone, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "n_lines", "n_removed"])

    schema = ", ".join(f"`{x}` {fields[x]}" for x in kept) + ", n_lines long, n_removed long"
    out = joined.select(*kept, "_removed").mapInArrow(delete, schema)
    if "n_chars" in kept:
        changed = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", changed.cast(fields["n_chars"]))
    return out
