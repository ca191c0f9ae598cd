"""Connected components of links by jumping to smaller nodes and contracting."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.storage import written

EDGE = "high long, low long"


def smallest_reachable(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of an edge list and the smallest node that each can reach."""
    nodes, at = np.unique(np.concatenate((first, second)), return_inverse=True)
    a, b = at[: len(first)], at[len(first) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            jump = label[label]
            if (jump == label).all():
                break
            label = jump
        if (label == before).all():
            return nodes, nodes[label]


def contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a partition as one edge per node, to the smallest node it reaches in there."""
    kept = [np.zeros((2, 0), dtype=np.int64)]
    for batch in batches:
        first, second = (c.to_numpy() for c in batch.columns)
        nodes, low = smallest_reachable(*np.concatenate((kept[0], np.stack((first, second))), axis=1))
        kept[0] = np.stack((nodes, low))[:, nodes != low]
    high, low = kept[0]
    yield pa.RecordBatch.from_arrays([pa.array(high), pa.array(low)], ["high", "low"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for every node with an edge the smallest node of its component.

    In every round an edge to a node goes on to the smallest neighbour of that node instead, and
    what then meets at a node is contracted. When nothing changes, all that is left are stars.
    Each round is written, so that a later one does not depend on executors that held an earlier one.
    """
    first, second = edges.columns
    oriented = edges.select(F.greatest(first, second).alias("high"), F.least(first, second).alias("low"))
    now = written(met(oriented.filter("high <> low")), "edges")
    state = None
    while True:
        mark = F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))
        found = tuple(now.agg(F.count("*"), mark).first())
        if found == state or not found[0]:
            # A node is high once at most now; only roots are low.
            return now.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(
                now.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
            )
        state = found
        least = now.groupBy("high").agg(F.min("low").alias("least")).withColumnRenamed("high", "low")
        onward = now.join(least, "low", "left").select("high", F.coalesce("least", "low").alias("low"))
        now = written(met(onward), "edges")


def met(edges: DataFrame) -> DataFrame:
    """All edges of a node meet and are contracted, so each node leaves a partition once."""
    return edges.repartition("high").mapInArrow(contracted, EDGE)
