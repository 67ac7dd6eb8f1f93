"""What the streams share: starting them, pausing, and tables that may not have been written yet."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

Gate = Callable[[], bool]
# Adds the flag ``held`` to rows with a shard.
Hold = Callable[[DataFrame], DataFrame]


def wait_while(paused: Gate | None, pause_seconds: float = 1.0) -> None:
    """Hold the batch back as long as the gate says so."""
    while paused is not None and paused():
        time.sleep(pause_seconds)


def start_batches(
    events: DataFrame, process: Callable[[DataFrame, int], None], checkpoint: str, every: str | None, mode: str = "append"
) -> StreamingQuery:
    writer = events.writeStream.foreachBatch(process).outputMode(mode).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, asked of the file system: a failed read would be reported to query listeners."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()).exists(place)


def stored(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """A table that may not have been written yet; with a schema no file has to be opened for it."""
    if not exists(spark, path):
        return None
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
