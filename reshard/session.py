"""Session settings, and where the engine may write shared files."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings the operators are written for. The number of shuffle partitions is left to the cluster:
# adaptive execution merges small ones, so it should be set high (several per core).
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.task.maxFailures": "10",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Column calls are made from here, so recording their call sites would only slow plan building down.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# Control data with more rows than this is not broadcast.
BROADCAST_ROWS = 200_000


def build_session(app: str = "reshard", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="reshard-")


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``, or a temporary one in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder()


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(rows: DataFrame) -> DataFrame:
    """Rows stored reliably, so that later stages never see a recomputed, differently placed copy."""
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(rows.sparkSession))
    return rows.checkpoint(eager=True)


def broadcast_if_small(rows: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast control data after counting it; above the bound the planner joins by shuffle."""
    small = rows.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(rows) if small else rows
