"""N-gram Jaccard join by vertical partitioning.

A document is the set of its distinct shingles, as hashes. The global order of shingles is the order of
their hashes, and it is cut into fragments.

1. Documents that cannot have a partner leave early: all but a few of their shingles must occur
   elsewhere. Blocks learn how often each of their shingles occurs, in classes of half a byte.
2. Candidates: documents of similar size are cut into more fragments than two linked sets can
   differ in, so linked sets agree on at least one whole fragment. The rarest fragments of each are
   enough for that, one more than can differ; those of frequent shingles, which tie texts that have
   nothing else in common, are left aside. Equal fragments link each document to the one next in
   size, never all to all; components of these links are clusters that hold every linked pair.
3. Overlaps: in a cluster partial overlaps are counted fragment by fragment and summed per pair; a
   cluster larger than ``CELL_MEMBERS`` is dealt out in cells of two chunks, so no task holds it
   whole. Each cell returns links enough to connect what it found, not every pair. Texts are read
   again for it, only those of clusters, as they are smaller than their sets.

Equal sets are one class throughout. ``percent`` is the least similarity in percent, compared in
whole numbers.

Cases: texts of fewer words than a shingle are one shingle; null and empty texts have the empty set
and are linked with nothing; equal rows are linked; a null id is never the smallest; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.blocks import block_documents, class_table, count_classes, named_documents, short_keys, with_replies
from llm.components import components, smallest_reachable
from llm.decontamination import FOLD
from llm.hashing import U64, gram_hashes, mix, pieces, word_hashes, words_of
from llm.repeats import grouped
from llm.storage import written

WORDS = 4
PERCENT = 85
CELL_MEMBERS = 2_048
CELL_SHINGLES = 1 << 19
FRAGMENT_COLUMNS = 1_024
SETS = "doc long, doc_id long, n_shingles long, class long, fragments binary"
NO_CLASS = 0


def shingle_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    for _, _, raw, bounds in pieces(column):
        folded = FOLD[raw]
        starts, ends, offsets = words_of(folded, bounds)
        hashes = word_hashes(folded, starts, ends)
        grams = gram_hashes(hashes, words)
        for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            if j - i >= words:
                yield np.unique(grams[i : j - words + 1])
            elif j > i:
                yield gram_hashes(hashes[i:j], j - i) + U64(j - i)
            else:
                yield np.zeros(0, U64)


def unshared(size: int, percent: int) -> int:
    """How many of its shingles a document may have that a linked one has not."""
    return (100 - percent) * size // 100


def differing(size: int, percent: int) -> int:
    """In how many shingles, of either, a document and a linked one may differ at most."""
    return (100 - percent) * size // percent


def class_of(shingles: np.ndarray) -> int:
    """A number for each set: two sums over its hashes, mixed; never 0."""
    if not len(shingles):
        return NO_CLASS
    both = np.array([mix(shingles).sum(), mix(shingles * U64(3)).sum() + U64(len(shingles))], dtype=U64)
    return int(mix(both[:1] + mix(both[1:])).view(np.int64)[0]) or 1


def size_class(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Linked sets are in the same or in neighbouring classes."""
    return np.floor(np.log(np.maximum(sizes, 1)) / np.log(100 / percent) + 1e-9).astype(np.int64)


def fragments(group: int, percent: int) -> int:
    """More fragments than two linked sets of size class ``group`` or the one before can differ in.

    One more than the largest possible difference would do if none were empty; the rest makes up for
    empty fragments, which are no evidence and are skipped.
    """
    largest = int((100 / percent) ** (group + 1)) + 1
    differ = 2 * largest * (100 - percent) // (100 + percent)
    return differ + differ // 8 + 20


def fragment_keys(shingles: np.ndarray, rarity: np.ndarray, percent: int) -> np.ndarray:
    """Keys of the rarest non-empty fragments of a set, in the groups of its own and the next size class.

    ``rarity`` has the class of each shingle's count. A fragment is as rare as its rarest shingle, so all sets order
    the fragments alike, and one that two linked sets have in common is among the first of both.
    """
    own = int(size_class(np.array([len(shingles)]), percent)[0])
    mixed = mix(shingles)
    parts = []
    for group in (own, own + 1):
        count = fragments(group, percent)
        place = ((shingles >> U64(32)) * U64(count)) >> U64(32)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        salt = place[first] + U64(group << 40)
        keys = mix(np.add.reduceat(mixed, first) + mix(salt))
        rarest = np.minimum.reduceat(rarity, first)
        order = np.lexsort((keys, rarest))[: differing(len(shingles), percent) + 1]
        parts.append(keys[order[rarest[order] > 1]])
    return np.concatenate(parts)


def documents_as_sets(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Written rows ``SETS``; ``fragments`` only of documents that may have a partner, once per block."""
    blocks, count = block_documents(docs)

    def keys_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        parts = [np.zeros(0, U64), *shingle_sets(table["text"], words)]
        return np.unique(short_keys(np.concatenate(parts), count), return_counts=True)

    def describe(table: pa.Table, replies: pa.Table) -> pa.Table:
        sets = list(shingle_sets(table["text"], words))
        keys, at = np.unique(short_keys(np.concatenate([np.zeros(0, U64), *sets]), count), return_inverse=True)
        rarity = class_table(replies, keys, count)[at]
        names, kept, seen, end = [], [], set(), 0
        for shingles in sets:
            size, name = len(shingles), class_of(shingles)
            own = rarity[end : end + size]
            end += size
            enough = size and name not in seen and (own < 2).sum() <= unshared(size, percent)
            names.append(name)
            kept.append(fragment_keys(shingles, own, percent).tobytes() or None if enough else None)
            seen.add(name)
        return pa.table(
            {
                "doc": table["doc"], "doc_id": table["doc_id"],
                "n_shingles": pa.array([len(x) for x in sets], pa.int64()), "class": pa.array(names, pa.int64()),
                "fragments": pa.array(kept, pa.binary()),
            }
        )

    return written(with_replies(blocks, count_classes(blocks, count, keys_of), describe, SETS), "sets")


def candidate_links(sets: DataFrame, percent: int) -> DataFrame:
    """(class, leader): classes that agree on a fragment, each with the one before it in size."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [np.frombuffer(x, np.int64) for x in batch.column("fragments").to_pylist()]
            if keys:
                number = [len(x) for x in keys]
                owners = [pa.array(np.repeat(batch.column(x).to_numpy(), number)) for x in ("n_shingles", "class")]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), *owners], ["key", "size", "class"])

    held = sets.select("class", "n_shingles", "fragments").mapInArrow(cut, "key long, size long, class long")
    in_order = Window.partitionBy("key").orderBy("size", "class")
    before = {"leader": F.lag("class").over(in_order), "less": F.lag("size").over(in_order)}
    # Sizes between those of two linked sets are as near to each other.
    near = held.withColumns(before).filter("class <> leader").filter(F.col("less") * 100 >= F.col("size") * percent)
    return near.select("class", "leader")


def cells_of(sets: DataFrame, clusters: DataFrame) -> DataFrame:
    """Rows (cell, class, doc): a cluster's classes with a document of each, in one cell or in cells of two chunks."""
    one = sets.groupBy("class").agg(F.min("doc").alias("doc"), F.first("n_shingles").alias("size"))
    members = written(one.join(clusters, one["class"] == clusters["node"]).select("root", "class", "doc", "size"), "members")
    sizes = members.groupBy("root").agg(F.count("*").alias("members"), F.sum("size").alias("size"))
    chunks = F.ceil(F.greatest(F.col("members") / CELL_MEMBERS, F.col("size") / CELL_SHINGLES))
    # Two chunks meet in a cell, so chunks of a cluster that must be cut are half as large.
    count = F.when(chunks <= 1, F.lit(1)).otherwise(chunks * 2)
    dealt = members.join(sizes.select("root", count.cast("int").alias("chunks")), "root")
    own = F.pmod(F.xxhash64("class"), F.col("chunks")).cast("int")
    return dealt.select("root", "class", "doc", "chunks", own.alias("own")).select(
        "class", "doc", "root", "own",
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"),
    ).select(
        F.xxhash64("root", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), "class", "doc"
    )


def linked_in_cell(names: np.ndarray, sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is linked among the sets: each node with the smallest it reaches.

    Partial overlaps of all pairs are counted per fragment of the global order and summed.
    """
    sizes = np.array([len(x) for x in sets])
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    df = np.diff(np.append(first, len(values)))
    column = np.repeat(np.cumsum(df > 1) - 1, df)
    shared = np.repeat(df > 1, df)
    column, owner = column[shared], owner[shared]
    overlap = np.zeros((len(sets), len(sets)), dtype=np.float32)
    width = int(column[-1]) + 1 if len(column) else 0
    for start in range(0, width, FRAGMENT_COLUMNS):
        i, j = np.searchsorted(column, (start, start + FRAGMENT_COLUMNS))
        part = np.zeros((len(sets), min(FRAGMENT_COLUMNS, width - start)), dtype=np.float32)
        part[owner[i:j], column[i:j] - start] = 1
        overlap += part @ part.T
    common = overlap.astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - common
    a, b = np.nonzero(np.triu(100 * common >= percent * union, 1))
    nodes, low = smallest_reachable(names[a], names[b])
    return nodes[nodes != low], low[nodes != low]


def links(docs: DataFrame, sets: DataFrame, clusters: DataFrame, words: int, percent: int) -> DataFrame:
    """(class, linked): links of sets, enough of them to connect each component."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in grouped(batches):
            found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
            for group in groups:
                if len(group) > 1:
                    names = np.array([name for _, name, _ in group], dtype=np.int64)
                    members = list(shingle_sets(pa.array([text for *_, text in group], pa.string()), words))
                    found.append(linked_in_cell(names, members, percent))
            first, second = (np.concatenate(x) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(first), pa.array(second)], ["class", "linked"])

    # Cells grow with the corpus, so they are not for every executor, also where they are still few.
    cells = cells_of(sets, clusters).hint("merge")
    texts = named_documents(docs).join(cells, "doc").select("cell", "class", "text")
    # A class can come twice to a cell, as its own and as the other chunk's, or in equal rows.
    dealt = texts.repartition("cell").dropDuplicates(["cell", "class"]).sortWithinPartitions("cell")
    return dealt.mapInArrow(count, "class long, linked long")


def with_components(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc, doc_id, n_shingles, root): documents with the smallest class of their component."""
    rows = documents_as_sets(docs, words, percent)
    sets = rows.filter("fragments is not null")
    clusters = components(candidate_links(sets, percent))
    found = components(links(docs, sets, clusters, words, percent))
    plain = rows.select("doc", "doc_id", "n_shingles", "class")
    joined = plain.join(found, plain["class"] == found["node"], "left")
    return joined.select("doc", "doc_id", "n_shingles", F.coalesce("root", "class").alias("root"))


def join_similar(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc, doc_id, n_shingles, component_id) for every document."""
    rows = with_components(docs, words, percent)
    # The empty set is linked with nothing, so each such document is a component of its own.
    some = rows.filter("n_shingles > 0")
    smallest = some.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    alone = rows.filter("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["doc", "doc_id", "n_shingles", "component_id"]
    return some.join(smallest, "root").select(*columns).unionByName(alone.select(*columns))


def keep_one_of_each(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The documents with all columns, one of each component: that with the smallest id.

    Among rows equal in id and text one stays. Documents without words all stay.
    """
    rows = with_components(docs, words, percent)
    first = F.row_number().over(Window.partitionBy("root").orderBy(F.col("doc_id").asc_nulls_last(), "doc"))
    one = rows.filter("n_shingles > 0").withColumn("_rank", first).filter("_rank = 1").select("doc", "n_shingles")
    none = rows.filter("n_shingles = 0").select("doc", "n_shingles").distinct()
    kept = one.unionByName(none).select(F.col("doc").alias("_doc"), F.col("n_shingles").alias("_size"))
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = docs.withColumn("_doc", F.xxhash64(F.col("doc_id").cast("long"), text)).join(kept, "_doc")
    copy = F.row_number().over(Window.partitionBy("_doc").orderBy("_size"))
    return marked.withColumn("_copy", copy).filter("_copy = 1 or _size = 0").select(*docs.columns)
