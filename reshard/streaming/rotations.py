"""Log files of a stream whose log names them by rotations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reshard.operators.changes import assign_log_file, rotations
from reshard.streaming.files import stored

ROTATIONS = "source string, seq bigint, log_file string"


class Rotations:
    """Remembers all rotations of a log, one folder per micro-batch below ``path``.

    There is one rotation per log file; all are kept, as a late file may hold events from before the last of them.
    """

    def __init__(self, path: str) -> None:
        self.path = path.rstrip("/")

    def _at(self, batch_id: int) -> str:
        return f"{self.path}/batch_id={batch_id}"

    def known(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """Rotations of all batches before this one."""
        return stored(spark, self._at(batch_id - 1), ROTATIONS)

    def place(self, events: DataFrame, batch_id: int, remember: bool = True) -> DataFrame:
        """Events of a batch with their log file, NULL before the first rotation of their source. Safe to repeat."""
        known = self.known(events.sparkSession, batch_id)
        if remember:
            points = rotations(events) if known is None else known.unionByName(rotations(events))
            points.distinct().coalesce(1).write.mode("overwrite").parquet(self._at(batch_id))
        return assign_log_file(events, known)
