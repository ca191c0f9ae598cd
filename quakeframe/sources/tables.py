"""Reading stored tables: whole, by key, and only where they exist."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Longer key lists become a table and a semi join instead of one huge IN predicate.
MAX_IN_LIST = 1_000


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on the file system it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; empty where the folder is missing."""
    if not table_exists(spark, path):
        return []
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in file_system.listStatus(hadoop_path)]


def table_scan(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A stored table, lazily; filters and column choices of the caller reach the scan."""
    return spark.read.format(fmt).load(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder if it is there."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def rename_path(spark: SparkSession, path: str, target: str) -> None:
    """Move a folder in one step; the target must not be there yet."""
    source, goal = (spark._jvm.org.apache.hadoop.fs.Path(x) for x in (path, target))
    if not source.getFileSystem(spark._jsc.hadoopConfiguration()).rename(source, goal):
        raise OSError(f"{path} was not moved to {target}")


def has_rows_written(spark: SparkSession, path: str) -> bool:
    """Whether a table folder holds more than markers of an empty write."""
    hidden = ("_", ".")
    return any(
        name == "_delta_log" or not name.startswith(hidden) for name in child_names(spark, path)
    )


def table_scan_if_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table, or None so that a job can be skipped."""
    return table_scan(spark, path, fmt) if has_rows_written(spark, path) else None


def key_scan(
    df: DataFrame,
    keys: Sequence[str] | DataFrame | None,
    key: str = "event_id",
) -> DataFrame:
    """Rows whose key is listed. None means every row, an empty list or table none.

    A short list becomes a pushed-down IN. Anything longer is a semi join, which the
    adaptive planner turns into a broadcast only after it has seen the size.
    """
    if keys is None:
        return df
    if isinstance(keys, DataFrame):
        return df.join(keys.select(key), key, "left_semi")
    wanted = list(dict.fromkeys(keys))
    if len(wanted) <= MAX_IN_LIST:
        return df.filter(F.col(key).isin(wanted))
    listed = df.sparkSession.createDataFrame([(value,) for value in wanted], f"{key} string")
    return df.join(listed, key, "left_semi")
