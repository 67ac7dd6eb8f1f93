"""Checks on the log itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reshard.functions.positions import (
    file_distance,
    file_number,
    file_number_width,
    is_detached,
    next_file,
    previous_file,
)
from reshard.operators.ordered import with_previous


def log_gap_audit(changes: DataFrame, numeric_order: bool = False, partitions: int | None = None) -> DataFrame:
    """Per source and log file: distance to the file before, expected neighbours, gap, backward steps.

    Files are ordered by name; ``numeric_order`` uses their number instead. The file list is small (one
    row per file), and offsets are compared inside ranges of a file.
    """
    stepped = with_previous(
        changes.select("source", "log_file", "seq", "log_pos"),
        ["source", "log_file"], "seq", "log_pos", "_before", partitions=partitions,
    )
    files = stepped.groupBy("source", "log_file").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("log_pos") < F.col("_before")).alias("backward_steps"),
    )
    name = F.col("log_file")
    order = [file_number(name), name] if numeric_order else [name]
    before = F.lag("log_file").over(Window.partitionBy("source").orderBy(*order))
    listed = files.withColumn("before_file", before)
    distance = file_distance(F.col("before_file"), name)
    return listed.select(
        "source",
        "log_file",
        file_number(name).alias("file_number"),
        file_number_width(name).alias("number_width"),
        "before_file",
        F.when(F.col("before_file").isNotNull(), distance).alias("distance"),
        previous_file(name).alias("expected_previous"),
        next_file(name).alias("expected_next"),
        F.when(F.col("before_file").isNotNull(), distance != 1).otherwise(False).alias("gap"),
        is_detached(name).alias("detached"),
        "rows",
        "backward_steps",
    )
