"""Weighted shards by rendezvous hashing of stable record keys.

Every shard scores every key: with u the key's hash with the shard as a number between 0 and 1, the
score is -weight / ln(u), and the highest score takes the record. A shard's share is that of its
weight, and only the key and the shards decide. One more shard takes records for itself and moves
none between the others; one fewer hands out its own records only.

Records of a shard are numbered without gaps. They are dealt into chunks by hash; a record's number
is what lies before it in its chunk, before the chunk in its span of chunks, and before the span,
so no task sorts a whole shard. Rows equal in all that is numbered are folded to one row with a
multiplicity before the shuffle and unfolded in pieces, so many copies of one row stay spread.

Cases: null and empty texts have size 1 and checksum 0; a null key is a key like others; equal keys
share a shard, and equal rows get numbers of their own; the length of a text does not matter, since texts
are measured where they are read and never shuffled here; an empty table gives no rows; other
columns are kept by ``assign_shards``, but for one named like the new one, which is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.storage import written

WEIGHTS = (1.0,) * 8
CHUNK_ROWS = 4_000
SPAN_CHUNKS = 1_000
FOLDED_ROWS = 1_000
LAW = "key"
# What a 53-bit number is divided by to lie between 0 and 1.
HASH_BITS = 53


def score(key: Sequence[Column], shard: int, weight: float) -> Column:
    """How strongly a shard claims a key."""
    bits = F.shiftrightunsigned(F.xxhash64(*key, F.lit(shard)), 64 - HASH_BITS)
    return F.lit(-float(weight)) / F.ln((bits.cast("double") + F.lit(0.5)) / F.lit(float(2**HASH_BITS)))


def winner(key: Sequence[Column], weights: Sequence[float]) -> Column:
    """(score, minus the shard) of the shard that takes a key; the first of equal ones."""
    claims = [
        F.struct(score(key, i, w).alias("score"), F.lit(-i).alias("minus"))
        for i, w in enumerate(weights)
        if w > 0
    ]
    if not claims:
        raise ValueError("one shard at least must have a weight above 0")
    return claims[0] if len(claims) == 1 else F.greatest(*claims)


def shard_of(key: Sequence[Column], weights: Sequence[float]) -> Column:
    """The shard of a key, from 0; shards of weight 0 get nothing."""
    return (-winner(key, weights)["minus"]).cast("int")


def assign_shards(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, key: Sequence[str] = ("doc_id",), name: str = "shard"
) -> DataFrame:
    """All rows and columns with their shard; with the text as key, copies of a text stay together."""
    return docs.withColumn(name, shard_of([F.col(x) for x in key], weights))


def moved_rows(
    docs: DataFrame, weights: Sequence[float], new_weights: Sequence[float], key: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """Rows whose shard changes, with ``old_shard`` and ``new_shard``."""
    both = assign_shards(assign_shards(docs, weights, key, "old_shard"), new_weights, key, "new_shard")
    return both.filter("old_shard <> new_shard")


def number_rows(rows: DataFrame, group: str, name: str = "slot") -> DataFrame:
    """Narrow rows with numbers from 0 in each group, fixed by the rows alone.

    The rows are written to the shared folder while this is called; the numbering is lazy.
    """
    columns = rows.columns
    folded = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows"))
    folded = written(folded, "shard-rows")
    total = folded.agg(F.sum("_rows")).first()[0] or 0
    chunks = max(1, -(-total // (CHUNK_ROWS * 8)))
    parts = folded.select(
        *columns, "_rows", F.explode(F.expr(f"sequence(0, (_rows - 1) div {FOLDED_ROWS})")).alias("_part")
    ).select(
        *columns,
        "_part",
        F.least(F.lit(FOLDED_ROWS), F.col("_rows") - F.col("_part") * FOLDED_ROWS).alias("_rows"),
        F.pmod(F.xxhash64(*columns, "_part"), F.lit(chunks)).alias("_chunk"),
    )
    earlier = Window.unboundedPreceding, -1
    sizes = parts.groupBy(group, "_chunk").agg(F.sum("_rows").alias("_size"))
    sizes = sizes.withColumn("_span", F.expr(f"_chunk div {SPAN_CHUNKS}"))
    in_span = Window.partitionBy(group, "_span").orderBy("_chunk").rowsBetween(*earlier)
    in_group = Window.partitionBy(group).orderBy("_span").rowsBetween(*earlier)
    spans = sizes.groupBy(group, "_span").agg(F.sum("_size").alias("_size"))
    spans = spans.select(group, "_span", F.coalesce(F.sum("_size").over(in_group), F.lit(0)).alias("_before_span"))
    starts = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(in_span), F.lit(0))).join(spans, [group, "_span"])
    starts = starts.select(group, "_chunk", (F.col("_before") + F.col("_before_span")).alias("_before"))
    in_chunk = Window.partitionBy(group, "_chunk").orderBy(*columns, "_part").rowsBetween(*earlier)
    placed = parts.withColumn("_inside", F.coalesce(F.sum("_rows").over(in_chunk), F.lit(0)))
    first = F.col("_before") + F.col("_inside")
    numbers = F.sequence(first, first + F.col("_rows") - 1)
    return placed.join(starts, [group, "_chunk"]).select(*columns, F.explode(numbers).alias(name))


def shard_documents(docs: DataFrame, weights: Sequence[float] = WEIGHTS, added: float = 1.0) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every document.

    ``size`` is the text's bytes and 1; ``grown_shard`` is the shard if there were one more of
    weight ``added``.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    key = [F.col("doc_id").cast("long")]
    best, new = winner(key, weights), score(key, len(weights), added)
    grown = F.when(new > best["score"], F.lit(len(weights))).otherwise(-best["minus"])
    rows = docs.select(
        key[0].alias("doc_id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        shard_of(key, weights).alias("shard"),
        grown.cast("int").alias("grown_shard"),
    )
    return number_rows(rows, "shard").select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), "grown_shard",
    )


def write_shards(
    docs: DataFrame,
    path: str,
    weights: Sequence[float] = WEIGHTS,
    key: Sequence[str] = ("doc_id",),
    file_rows: int = 1_000_000,
) -> None:
    """Write all rows as Parquet in a folder for each shard, ``shard=0`` and so on.

    A large shard is written by several tasks, so a task holds no whole shard.
    """
    sharded = assign_shards(docs, weights, key).hint("rebalance", "shard")
    sharded.write.option("maxRecordsPerFile", file_rows).partitionBy("shard").parquet(path)
