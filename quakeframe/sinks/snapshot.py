"""A snapshot of latest events on plain files, for formats without row-level merges.

``changes/batch_id=n`` holds the rows of batch n that replaced or added a row of the snapshot, each with
what it replaced: a hash of that row, its time and its place. ``base/version=n`` is the whole snapshot after
batch n in buckets by a hash of the id; a version writes only the buckets with changes since the
version before and names, in ``_buckets``, the version that holds each of the others. Writing a batch
costs only the batch and the stored rows of its ids. Readers merge the newest base with the later
batches; ``compact`` writes the next base.

A batch's folder is written as a whole, so a repeated batch replaces its own. A base is written
under a hidden name and switched on by one rename.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from quakeframe.operators.latest import dedupe_latest_rows
from quakeframe.operators.merge import KEY, merge_in_order, replaces
from quakeframe.schemas import FLAT_EVENT_COLUMNS, FLAT_EVENT_DDL
from quakeframe.sources.tables import child_names, drop_path, rename_path, table_exists

BEFORE_ALL = -1
BUCKETS = 64
BEFORE_DDL = "before_hash bigint, before_time_utc timestamp, before_place string"
CHANGES_DDL = f"{FLAT_EVENT_DDL}, {BEFORE_DDL}"
BUCKETS_DDL = "bucket int, version bigint"
HORIZON = "_horizon="


def _numbered(spark: SparkSession, path: str) -> list[int]:
    """Numbers of ``name=number`` folders, highest first."""
    named = [n for n in child_names(spark, path) if "=" in n and not n.startswith("_")]
    return sorted((int(n.split("=")[1]) for n in named), reverse=True)


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Versions of the base that can be read, newest first; others only hold buckets of later ones."""
    base = f"{path}/base"
    return [n for n in _numbered(spark, base) if table_exists(spark, f"{base}/version={n}/_buckets")]


def base_version(spark: SparkSession, path: str) -> int:
    """Batch of the newest base; -1 without one."""
    return next(iter(_versions(spark, path)), BEFORE_ALL)


def bucket_expr(buckets: int) -> Column:
    return F.pmod(F.xxhash64(KEY), F.lit(buckets)).cast("int")


def row_hash() -> Column:
    return F.xxhash64(*FLAT_EVENT_COLUMNS)


def _holders(spark: SparkSession, path: str, version: int) -> dict[int, int]:
    """For each bucket the version that holds it, or -1 where it is empty; one entry for each bucket."""
    rows = spark.read.schema(BUCKETS_DDL).parquet(f"{path}/base/version={version}/_buckets").collect()
    return {r.bucket: r.version for r in rows}


def _bucket_folder(path: str, bucket: int, version: int) -> str:
    return f"{path}/base/version={version}/bucket={bucket}"


def _read_buckets(spark: SparkSession, path: str, holders: dict[int, int]) -> DataFrame | None:
    folders = [_bucket_folder(path, b, v) for b, v in holders.items() if v != BEFORE_ALL]
    if len(set(holders.values())) == 1 and len(folders) > 1 and len(folders) == len(child_names(spark, folders[0].rsplit("/", 1)[0])) - 2:
        # All buckets of one version, whose folder has besides only its list and the mark of success.
        folders = [folders[0].rsplit("/", 1)[0]]
    if not folders:
        return None
    rows = spark.read.schema(FLAT_EVENT_DDL).option("basePath", f"{path}/base").parquet(*folders)
    return rows.select(*FLAT_EVENT_COLUMNS)


def _base(spark: SparkSession, path: str, version: int, buckets: list[int] | None = None) -> DataFrame | None:
    if version == BEFORE_ALL:
        return None
    holders = _holders(spark, path, version)
    rows = _read_buckets(spark, path, holders if buckets is None else {b: holders[b] for b in buckets})
    return None if rows is None else rows.withColumn("batch_id", F.lit(version).cast("bigint"))


def _batches(spark: SparkSession, path: str, after: int, before: int | None) -> list[int]:
    folder = f"{path}/changes"
    return [
        n
        for n in _numbered(spark, folder)
        if n > after and (before is None or n < before) and table_exists(spark, f"{folder}/batch_id={n}/_SUCCESS")
    ]


def read_changes(spark: SparkSession, path: str, after: int, before: int | None = None) -> DataFrame | None:
    """Effective rows of batches with what they replaced and their ``batch_id``; None without batches."""
    folder, batches = f"{path}/changes", _batches(spark, path, after, before)
    if not batches:
        return None
    return (
        spark.read.schema(f"{CHANGES_DDL}, batch_id bigint")
        .option("basePath", folder)
        .parquet(*[f"{folder}/batch_id={n}" for n in batches])
    )


def snapshot_rows(
    spark: SparkSession, path: str, before: int | None = None, only: DataFrame | None = None
) -> DataFrame | None:
    """The merged snapshot, or None where nothing is stored.

    ``before`` leaves out that batch and later ones; ``only`` holds the ids wanted.
    Only base rows whose id also occurs in the changes take part in the merge. The
    others pass without a shuffle when the ids of the changes are few enough for the
    adaptive planner to broadcast them.
    """
    version = base_version(spark, path)
    base, changes = _base(spark, path, version), read_changes(spark, path, version, before)
    if only is not None:
        ids = only.select(KEY)
        base = None if base is None else base.join(ids, KEY, "left_semi")
        changes = None if changes is None else changes.join(ids, KEY, "left_semi")
    if changes is None:
        return None if base is None else base.select(*FLAT_EVENT_COLUMNS)
    rows = changes.select(*FLAT_EVENT_COLUMNS, "batch_id")
    if base is None:
        return merge_in_order(rows, "batch_id").select(*FLAT_EVENT_COLUMNS)
    changed = changes.select(KEY)
    touched = base.join(changed, KEY, "left_semi")
    untouched = base.join(changed, KEY, "left_anti")
    merged = untouched.unionByName(merge_in_order(rows.unionByName(touched), "batch_id"))
    return merged.select(*FLAT_EVENT_COLUMNS)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The merged snapshot; empty where nothing is stored."""
    rows = snapshot_rows(spark, path)
    return spark.createDataFrame([], FLAT_EVENT_DDL) if rows is None else rows


def upsert_latest(
    spark: SparkSession, path: str, flat_rows: DataFrame, batch_id: int, arrival: str | None = None
) -> int | None:
    """Merge one batch, and return how many rows it inserted or updated.

    Batches must come in ascending order; a repeat of a batch is harmless, and gives None where the
    base holds it already.
    """
    version = base_version(spark, path)
    if batch_id < version:
        raise ValueError(f"batch {batch_id} is older than the stored snapshot {version}")
    if batch_id == version:
        return None
    newest = dedupe_latest_rows(flat_rows, arrival).select(*FLAT_EVENT_COLUMNS).persist(StorageLevel.MEMORY_AND_DISK)
    observed = Observation()
    try:
        (
            effective_rows(snapshot_rows(spark, path, before=batch_id, only=newest), newest)
            .observe(observed, F.count(F.lit(1)).alias("rows"))
            .write.mode("overwrite")
            .parquet(f"{path}/changes/batch_id={batch_id}")
        )
    finally:
        newest.unpersist()
    return observed.get["rows"]


def effective_rows(target: DataFrame | None, newest: DataFrame) -> DataFrame:
    """Rows of a batch that replace or add a row, with what they replace.

    The others would be merged in vain, and are no changes.
    """
    if target is None:
        return newest.selectExpr("*", *[f"cast(null as {x.split()[1]}) as {x.split()[0]}" for x in BEFORE_DDL.split(", ")])
    before = target.select(KEY, "updated_time_utc", "event_time_utc", "place", row_hash().alias("before_hash"))
    joined = newest.alias("source").join(before.alias("target"), F.col(f"source.{KEY}") == F.col(f"target.{KEY}"), "left")
    return joined.filter(F.col(f"target.{KEY}").isNull() | replaces()).select(
        *[F.col(f"source.{name}").alias(name) for name in FLAT_EVENT_COLUMNS],
        "before_hash",
        F.col("target.event_time_utc").alias("before_time_utc"),
        F.col("target.place").alias("before_place"),
    )


def changed_ids(spark: SparkSession, path: str, since: int, upto: int | None = None) -> DataFrame:
    """Ids whose row after batch ``upto`` (by default the last) differs from that after batch ``since``.

    Only the changes are read: the first one after ``since`` knows the row that was there, the last
    one is the row that is.
    """
    horizon = max((int(n.removeprefix(HORIZON)) for n in child_names(spark, f"{path}/changes") if n.startswith(HORIZON)), default=BEFORE_ALL)
    if since < horizon:
        raise ValueError(f"changes up to batch {horizon} are no longer kept")
    changes = read_changes(spark, path, since, None if upto is None else upto + 1)
    if changes is None:
        return spark.createDataFrame([], f"{KEY} string")
    first_and_last = changes.groupBy(KEY).agg(
        F.min_by("before_hash", "batch_id").alias("was"), F.max_by(row_hash(), "batch_id").alias("is")
    )
    return first_and_last.filter("was is null or was <> is").select(KEY)


def compact(spark: SparkSession, path: str, batch_id: int, keep_versions: int = 2, buckets: int = BUCKETS) -> int:
    """Write the snapshot up to ``batch_id`` as the new base, and return how many buckets were written.

    Buckets without changes stay where they are; ``buckets`` counts for the first base only. Of the
    older bases ``keep_versions`` minus one stay for readers that still use them; buckets that no
    kept base names, and the changes that every kept base already holds, are deleted.
    """
    version = base_version(spark, path)
    changes = read_changes(spark, path, version, batch_id + 1) if batch_id > version else None
    written: list[int] = []
    if changes is not None:
        known = _holders(spark, path, version) if version != BEFORE_ALL else dict.fromkeys(range(buckets), BEFORE_ALL)
        bucket = bucket_expr(len(known))
        written = sorted(r[0] for r in changes.select(bucket).distinct().collect())
        rows = changes.select(*FLAT_EVENT_COLUMNS, "batch_id")
        base = _base(spark, path, version, written)
        merged = merge_in_order(rows if base is None else rows.unionByName(base), "batch_id")
        staged = f"{path}/base/_staged-{uuid.uuid4().hex}"
        placed = merged.select(*FLAT_EVENT_COLUMNS, bucket.alias("bucket")).hint("rebalance", "bucket")
        # Sorted by time, so that a reader of some days skips most of a file.
        placed.sortWithinPartitions("bucket", "event_time_utc").write.partitionBy("bucket").parquet(staged)
        now = known | dict.fromkeys(written, batch_id)
        spark.createDataFrame(list(now.items()), BUCKETS_DDL).coalesce(1).write.parquet(f"{staged}/_buckets")
        drop_path(spark, f"{path}/base/version={batch_id}")
        rename_path(spark, staged, f"{path}/base/version={batch_id}")
    _clean(spark, path, keep_versions)
    return len(written)


def _clean(spark: SparkSession, path: str, keep_versions: int) -> None:
    for name in child_names(spark, f"{path}/base"):
        if name.startswith("_staged"):
            drop_path(spark, f"{path}/base/{name}")
    versions = _versions(spark, path)
    if len(versions) <= keep_versions - 1:
        return
    for old in versions[keep_versions:]:
        drop_path(spark, f"{path}/base/version={old}/_buckets")
    kept = versions[:keep_versions]
    used = {_bucket_folder(path, b, v) for n in kept for b, v in _holders(spark, path, n).items()}
    for old in _numbered(spark, f"{path}/base"):
        folder = f"{path}/base/version={old}"
        held = [f"{folder}/{n}" for n in child_names(spark, folder) if n.startswith("bucket=")]
        for name in held:
            if name not in used:
                drop_path(spark, name)
        if old not in kept and not used.intersection(held):
            drop_path(spark, folder)
    oldest = kept[-1]
    # Said before it is done, so that a reader never takes a part of the changes for all.
    spark.createDataFrame([], "n int").write.mode("overwrite").parquet(f"{path}/changes/{HORIZON}{oldest}")
    for batch in _numbered(spark, f"{path}/changes"):
        if batch <= oldest:
            drop_path(spark, f"{path}/changes/batch_id={batch}")
    for name in child_names(spark, f"{path}/changes"):
        if name.startswith(HORIZON) and int(name.removeprefix(HORIZON)) < oldest:
            drop_path(spark, f"{path}/changes/{name}")
