"""Session settings every operator relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings, valid on a session somebody else created.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # HotSpot never compiles longer methods, and wide projections such as the tolerant parse have them:
    # such a stage runs operator by operator instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Settings a session only takes when it is created. Call sites of every column expression
# are not recorded, which makes building wide projections several times faster.
STATIC_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def create_session(
    app_name: str = "quakeframe",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build a session; the master is left to the launcher unless one is given."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for name, value in {**STATIC_CONF, **RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(name, value)
    return prepare_session(builder.getOrCreate())


def prepare_session(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on an existing session: UTC dates and adaptive plans."""
    for name, value in RUNTIME_CONF.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors see, as named by ``spark.checkpoint.dir``.

    A machine-local folder is made up only where everything runs on one machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="quakeframe-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a result that several steps read, and continue from the written table.

    The table outlives the loss of an executor, and later readers take only the columns they
    need. It stays in the shared folder, which is cleaned outside of this library.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
