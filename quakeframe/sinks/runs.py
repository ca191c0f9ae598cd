"""A table of runs on plain files: a run is replaced as a whole, and old runs are folded together.

``run_key=<hash>/attempt=<n>-<id>`` holds the rows of a run that was written lately, by calendar day,
and ``fold=<first>-<last>`` the rows of all runs that compactions ``first`` to ``last`` took in, with a list of
them in ``_runs``. Everything is written under a hidden name and switched on by one rename, so
readers see what was there before or what is there after. What that leaves behind (an older attempt,
runs and folds that a new fold holds) is told from the names and lists, is never read again, and goes
with the next write if a crash kept it. The name of a run's folder is a hash, so a run id may be any text.

Of a run the newest attempt counts, also over rows of the run in a fold, and a newer fold over an older
one; so a replay of a run that was folded long ago replaces its rows and adds none. Compactions merge
folds as a binary counter carries, so there are about as many as the compactions have binary digits.

Use ``read_runs``; one writer at a time for a run, and one compaction at a time.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quakeframe.schemas import FLAT_EVENT_DDL
from quakeframe.sinks.tables import write_partitioned
from quakeframe.sources.tables import child_names, drop_path, rename_path, table_exists

RUN_COLUMN = "run_id"
RUN_ROWS_DDL = f"{FLAT_EVENT_DDL}, {RUN_COLUMN} string"
LIST_DDL = "run_key string, attempt string"
KEY_CHARS = 32


def run_key(run_id: str) -> str:
    return hashlib.sha256(run_id.encode()).hexdigest()[:KEY_CHARS]


def run_folder(path: str, run_id: str) -> str:
    return f"{path}/run_key={run_key(run_id)}"


@dataclass
class Stored:
    """What a table consists of at one moment, by folder names."""

    live: dict[str, str] = field(default_factory=dict)  # newest attempt of each run that is not in a fold
    folds: list[tuple[int, int]] = field(default_factory=list)  # oldest first
    leftovers: list[str] = field(default_factory=list)


def _attempts(names: list[str]) -> list[tuple[int, str]]:
    """(number, name) of a run's attempts, oldest first."""
    found = [n for n in names if n.startswith("attempt=")]
    return sorted((int(n.split("=")[1].split("-")[0]), n) for n in found)


def _lists(spark: SparkSession, path: str, folds: list[tuple[int, int]]) -> DataFrame:
    """(run_key, attempt, last) of all runs in folds."""
    out = spark.createDataFrame([], f"{LIST_DDL}, last int")
    for first, last in folds:
        listed = spark.read.schema(LIST_DDL).parquet(f"{path}/fold={first}-{last}/_runs")
        out = out.unionByName(listed.withColumn("last", F.lit(last)))
    return out


def stored(spark: SparkSession, path: str) -> Stored:
    """The parts of the table; reads names, and the folds' lists only for runs that have a folder too."""
    found = Stored()
    names = child_names(spark, path)
    spans = sorted(tuple(map(int, n.split("=")[1].split("-"))) for n in names if n.startswith("fold="))
    for first, last in spans:
        if any(a <= first and last <= b and (a, b) != (first, last) for a, b in spans):
            found.leftovers.append(f"{path}/fold={first}-{last}")
        else:
            found.folds.append((first, last))
    found.leftovers += [f"{path}/{n}" for n in names if n.startswith("_staged")]
    attempts = {n: _attempts(child_names(spark, f"{path}/{n}")) for n in names if n.startswith("run_key=")}
    folded: set[tuple[str, str]] = set()
    if found.folds and attempts:
        here = [(n.split("=")[1], name) for n, some in attempts.items() for _, name in some]
        there = spark.createDataFrame(here, LIST_DDL)
        folded = {(r.run_key, r.attempt) for r in there.join(_lists(spark, path, found.folds), ["run_key", "attempt"], "left_semi").collect()}
    for folder, some in attempts.items():
        key = folder.split("=")[1]
        if some and (key, some[-1][1]) not in folded:
            found.live[key] = some[-1][1]
        found.leftovers += [f"{path}/{folder}/{name}" for _, name in some if found.live.get(key) != name]
    return found


def _replaced(spark: SparkSession, path: str, parts: Stored) -> dict[int, list[str]]:
    """For each fold the runs in it that a run's folder or a newer fold replaces: replays only."""
    lists = _lists(spark, path, parts.folds)
    newest = lists.groupBy("run_key").agg(F.max("last").alias("newest"), F.count("*").alias("n"))
    live = spark.createDataFrame([(k,) for k in parts.live], "run_key string").withColumn("live", F.lit(True))
    several = newest.join(live, "run_key", "left").filter("n > 1 or live")
    out: dict[int, list[str]] = {last: [] for _, last in parts.folds}
    for r in lists.join(several, "run_key").filter("live or last < newest").collect():
        out[r["last"]].append(r.run_key)
    return out


def _rows(spark: SparkSession, path: str, parts: Stored, schema: str) -> DataFrame | None:
    tables = []
    folders = [f"{path}/run_key={k}/{name}" for k, name in parts.live.items()]
    if folders:
        rows = spark.read.schema(schema).option("basePath", path).parquet(*folders)
        tables.append(rows.drop("run_key", "attempt"))
    replaced = _replaced(spark, path, parts) if parts.folds else {}
    for first, last in parts.folds:
        rows = spark.read.schema(schema).parquet(f"{path}/fold={first}-{last}")
        if replaced[last]:
            rows = rows.filter(~F.substring(F.sha2(RUN_COLUMN, 256), 1, KEY_CHARS).isin(replaced[last]))
        tables.append(rows)
    out = None
    for rows in tables:
        out = rows if out is None else out.unionByName(rows)
    return out


def read_runs(spark: SparkSession, path: str, schema: str = RUN_ROWS_DDL) -> DataFrame | None:
    """The rows of all runs, with their ``run_id``; None where nothing was ever written."""
    return _rows(spark, path, stored(spark, path), schema)


def append_run(df: DataFrame, path: str, run_id: str | None = None) -> int:
    """Write rows as one run, by default a new one, and return their number.

    Repeating a run id replaces all rows of that run and no others, whatever days the new rows are
    on; a run repeated without rows is empty afterwards. ``df`` may read the table, also the run that it replaces.
    """
    spark = df.sparkSession
    run = uuid.uuid4().hex if run_id is None else run_id
    folder = run_folder(path, run)
    names = child_names(spark, folder)
    for name in names:
        if name.startswith("_staged"):
            drop_path(spark, f"{folder}/{name}")
    staged = f"{folder}/_staged-{uuid.uuid4().hex}"
    count = write_partitioned(df.withColumn(RUN_COLUMN, F.lit(run)), staged)
    older = _attempts(names)
    number = older[-1][0] + 1 if older else 1
    rename_path(spark, staged, f"{folder}/attempt={number}-{uuid.uuid4().hex[:8]}")
    for _, name in older:
        drop_path(spark, f"{folder}/{name}")
    return count


def _write_fold(
    spark: SparkSession, path: str, rows: DataFrame | None, runs: DataFrame, parts: Stored, first: int, last: int
) -> int:
    """Write a fold that takes in ``parts``, switch it on, and delete what it holds."""
    for folder in parts.leftovers:
        drop_path(spark, folder)
    staged = f"{path}/_staged-{uuid.uuid4().hex}"
    count = 0 if rows is None else write_partitioned(rows, staged)
    runs.coalesce(1).write.parquet(f"{staged}/_runs")
    rename_path(spark, staged, f"{path}/fold={first}-{last}")
    for key, name in parts.live.items():
        folder = f"{path}/run_key={key}"
        drop_path(spark, f"{folder}/{name}")
        if not child_names(spark, folder):
            drop_path(spark, folder)
    for a, b in parts.folds:
        if first <= a:
            drop_path(spark, f"{path}/fold={a}-{b}")
    return count


def _live_list(spark: SparkSession, parts: Stored) -> DataFrame:
    return spark.createDataFrame(list(parts.live.items()), LIST_DDL)


def compact_runs(spark: SparkSession, path: str, schema: str = RUN_ROWS_DDL) -> int:
    """Fold all runs that have a folder of their own into one, and return the rows written.

    Older folds go in as long as they took in no more compactions than the new one so far, so that each
    row is rewritten as often as the number of compactions has binary digits.
    """
    parts = stored(spark, path)
    if not parts.live:
        return 0
    last = parts.folds[-1][1] + 1 if parts.folds else 0
    first, kept = last, list(parts.folds)
    while kept and kept[-1][1] - kept[-1][0] + 1 <= last - first + 1:
        first = kept.pop()[0]
    merged = Stored(parts.live, parts.folds[len(kept) :], parts.leftovers)
    # A run counts once, by what is read of it.
    runs = _live_list(spark, parts)
    if merged.folds:
        runs = runs.unionByName(_lists(spark, path, merged.folds).drop("last")).dropDuplicates(["run_key", "attempt"])
    return _write_fold(spark, path, _rows(spark, path, merged, schema), runs, merged, first, last)


def replace_runs(df: DataFrame, path: str, run_id: str) -> int:
    """Replace the whole table by one run, by one rename."""
    spark = df.sparkSession
    parts = stored(spark, path)
    last = parts.folds[-1][1] + 1 if parts.folds else 0
    runs = spark.createDataFrame([*parts.live.items(), (run_key(run_id), "")], LIST_DDL)
    return _write_fold(spark, path, df.withColumn(RUN_COLUMN, F.lit(run_id)), runs, parts, 0, last)


def is_run_table(spark: SparkSession, path: str) -> bool:
    return any(n.startswith(("run_key=", "fold=")) for n in child_names(spark, path))


def has_runs(spark: SparkSession, path: str) -> bool:
    """Whether any run has rows."""
    parts = stored(spark, path)
    folders = [f"{path}/run_key={k}/{name}" for k, name in parts.live.items()]
    folders += [f"{path}/fold={a}-{b}" for a, b in parts.folds]
    return any(n.startswith("year=") for x in folders if table_exists(spark, x) for n in child_names(spark, x))
