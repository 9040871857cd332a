"""Session settings, shared folders and size-checked broadcasts.

* ``session_conf`` - the settings the operators are designed for (AQE with
  partition coalescing and skew-join splitting, UTC, no UI).
* ``shared_folder`` - a folder below the one that ``spark.checkpoint.dir``
  names, which all executors see; layers are written there as Parquet.
* ``broadcast_known`` - broadcast only a side of known rows and bytes; nothing
  here starts a job.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SESSION_CONF: dict[str, str] = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Remove reliable-checkpoint files once their DataFrame is garbage.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", app: str = "blotter", shuffle_partitions: int = 8,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings above (tests, bench and local runs).

    On a cluster pass the cluster's own master and size
    ``spark.sql.shuffle.partitions`` to the data (AQE coalesces downwards).
    """
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(SESSION_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster configured, if any."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None) or None


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Set ``fallback`` only when the session has no checkpoint folder (tests)."""
    d = checkpoint_dir(spark)
    if d:
        return d
    spark.sparkContext.setCheckpointDir(fallback)
    return spark.sparkContext.getCheckpointDir()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the session's shared checkpoint folder.

    Only a local session without one gets a folder of its own (tests, bench);
    on a cluster a missing setting is an error, since executors do not see one
    another's disks."""
    base = checkpoint_dir(spark)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="blotter-shared-"))
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def plan_bytes(df: DataFrame) -> int:
    """The planner's size estimate of ``df`` (for a table: the files' bytes of
    the columns read). Starts no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_known(df: DataFrame, rows: int | None, max_rows: int, max_bytes: int) -> DataFrame:
    """Hint a broadcast of ``df`` if its known row count and the planner's byte
    estimate are both within bounds; otherwise leave the choice to Spark."""
    if rows is not None and rows <= max_rows and plan_bytes(df) <= max_bytes:
        return F.broadcast(df)
    return df
