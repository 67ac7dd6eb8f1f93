"""Values that hold from one point to the next, looked up for rows in between; and sets of position ranges.

The look-up follows where the points are: they are cut into buckets at quantiles, so one far-off point moves no border, and a row
meets the few points of its bucket only. Rows are not shuffled while the points are few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reshard.functions.positions import position
from reshard.functions.search import count_up_to
from reshard.operators.ordered import with_previous, with_running_max, with_running_total
from reshard.session import broadcast_if_small

# Buckets of points at most, and how exact their borders are.
BUCKETS = 4096
ACCURACY = 8 * BUCKETS


def as_of(
    rows: DataFrame, points: DataFrame, by: str, at: str, value: str, max_broadcast_rows: int = 1_000_000
) -> DataFrame:
    """Add the ``value`` of the last point at or before each row, of the same ``by``; NULL before the first.

    Points are (by, at, value); of several at the same place the one with the largest value holds. Rows whose ``by`` or ``at`` is
    NULL get NULL. Above ``max_broadcast_rows`` pieces the rows are joined by (by, bucket), so one ``by`` with a third of the
    rows is spread over as many tasks as it has buckets.
    """
    points = points.select(by, at, value).where(F.col(by).isNotNull() & F.col(at).isNotNull())
    grid = F.array(*[F.lit(i / BUCKETS) for i in range(1, BUCKETS)])
    first = points.agg(
        F.count("*").alias("n"),
        F.approx_count_distinct(by).alias("k"),
        F.percentile_approx(at, grid, F.lit(ACCURACY)).alias("marks"),
    ).first()
    kind = points.schema[value].dataType
    if not first["n"]:
        return rows.withColumn(value, F.lit(None).cast(kind))
    # About one point per ``by`` and bucket, so there are about twice as many pieces as points.
    wanted = max(1, min(BUCKETS, first["n"] // max(1, first["k"])))
    marks = sorted({first["marks"][i * BUCKETS // wanted - 1] for i in range(1, wanted)})
    borders = F.lit(marks) if marks else F.array().cast("array<bigint>")

    def bucket(place: Column) -> Column:
        return count_up_to(place, borders, len(marks))

    pieces = points.groupBy(by, at).agg(F.max(value).alias(value))
    pieces = pieces.withColumn("_to", F.lead(at).over(Window.partitionBy(by).orderBy(at)))
    last = F.coalesce(bucket(F.col("_to") - 1), F.lit(len(marks)))
    pieces = pieces.select(
        F.col(by).alias("_by"), F.col(at).alias("_from"), "_to", F.col(value).alias("_value"),
        F.explode(F.sequence(bucket(F.col(at)), last)).alias("_piece"),
    )
    if 3 * (first["n"] + first["k"]) <= max_broadcast_rows:
        pieces = F.broadcast(pieces)
    # The row is packed, so that its columns may have any names.
    left = rows.drop(value).select(
        F.struct("*").alias("_row"), F.col(by).alias("_own"), F.col(at).alias("_place"), bucket(F.col(at)).alias("_bucket")
    )
    here = (F.col("_own") == F.col("_by")) & (F.col("_bucket") == F.col("_piece"))
    within = (F.col("_place") >= F.col("_from")) & (F.col("_to").isNull() | (F.col("_place") < F.col("_to")))
    return left.join(pieces, here & within, "left").select("_row.*", F.col("_value").alias(value))


def merge_ranges(ranges: DataFrame, partitions: int | None = None) -> DataFrame:
    """Position ranges (source, after, upto), each from behind ``after`` up to ``upto``, as the fewest ranges with the same positions.

    Ranges that overlap or touch become one. The result can be merged again with others, in any grouping and order. Ranges
    that hold nothing are dropped. No source is in one task, so it may have any number of ranges.
    """
    real = ranges.select("source", "after", "upto").where(F.col("after") < F.col("upto"))
    once = real.groupBy("source", "after").agg(F.max("upto").alias("upto"))
    reached = with_running_max(once, ["source"], "after", "upto", "_reached", partitions)
    opens = F.col("_reached").isNull() | (F.col("after") > F.col("_reached"))
    marked = reached.withColumn("_opens", opens.cast("int"))
    numbered = with_running_total(marked, ["source"], "after", "_opens", "_island", partitions)
    merged = numbered.groupBy("source", "_island").agg(F.min("after").alias("after"), F.max("upto").alias("upto"))
    return merged.drop("_island")


def gaps(merged: DataFrame, partitions: int | None = None) -> DataFrame:
    """What lies between merged ranges of a source: (source, after, upto) not covered though something behind it is."""
    before = with_previous(merged, ["source"], "after", "upto", "_before", partitions=partitions)
    return before.where(F.col("_before").isNotNull()).select("source", F.col("_before").alias("after"), F.col("after").alias("upto"))


def skip_ranges(changes: DataFrame, merged: DataFrame) -> DataFrame:
    """Changes whose position is in none of the merged ranges: a late file that was never applied stays.

    Ranges are cut by the log files that occur among the changes, so a change meets the ranges of its own file only.
    """
    files = changes.select("source", "log_file").distinct()
    spans = merged.select(F.col("source").alias("_source"), "after", "upto")
    first, last = F.col("after.log_file"), F.col("upto.log_file")
    inside = (F.col("source") == F.col("_source")) & (F.col("log_file") >= first) & (F.col("log_file") <= last)
    pieces = files.join(broadcast_if_small(spans), inside).select(
        F.col("source").alias("_source"), F.col("log_file").alias("_file"),
        F.when(F.col("log_file") == first, F.col("after.log_pos")).alias("_after"),
        F.when(F.col("log_file") == last, F.col("upto.log_pos")).alias("_upto"),
    )
    here = (F.col("source") == F.col("_source")) & (F.col("log_file") == F.col("_file"))
    behind = F.col("_after").isNull() | (F.col("log_pos") > F.col("_after"))
    before = F.col("_upto").isNull() | (F.col("log_pos") <= F.col("_upto"))
    return changes.join(broadcast_if_small(pieces), here & behind & before, "left_anti")


def read_range(source: Column, after_file: Column, after_pos: Column, upto_file: Column, upto_pos: Column) -> list[Column]:
    """Columns of a range, from files and offsets."""
    return [source.alias("source"), position(after_file, after_pos).alias("after"), position(upto_file, upto_pos).alias("upto")]
