"""Writing partitioned tables, with the row count taken during the write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quakeframe.defaults import CALENDAR_PARTITIONS

def write_partitioned(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partitions: Sequence[str] = CALENDAR_PARTITIONS,
    options: dict[str, str] | None = None,
) -> int:
    """Write, and return the number of rows without a second pass.

    The rebalance hint gathers each partition's rows into files of the advisory size. A
    partition that holds much of the table is split over several tasks, and small ones
    share a task.
    """
    observed = Observation()
    (
        df.hint("rebalance", *partitions)
        .observe(observed, F.count(F.lit(1)).alias("row_count"))
        .write.format(fmt)
        .mode(mode)
        .options(**(options or {}))
        .partitionBy(*partitions)
        .save(path)
    )
    return observed.get["row_count"]
