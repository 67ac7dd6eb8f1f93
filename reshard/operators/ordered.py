"""Order-dependent operators that do not need one task per group.

A window over a group puts the whole group in one task, and one group may hold a third of all rows. Here rows are
range-partitioned on (group, order), which follows their real distribution; the work is done inside the partitions, and a
small summary (one row per group and partition) carries the state across their borders. NULL is a group like others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reshard.session import BROADCAST_ROWS, broadcast_if_small, checkpointed


def _placed(rows: DataFrame, group: list[str], order: list[str], partitions: int | None = None) -> DataFrame:
    """Rows in ranges of (group, order), with the range as ``_part`` and the place in it as ``_at``.

    They are checkpointed once placed, because summaries and rows must come from the same placement even when a task is
    run again. Calling this runs a job.
    """
    keys = [*group, *order]
    ranged = rows.repartitionByRange(partitions, *keys) if partitions else rows.repartitionByRange(*keys)
    marked = ranged.sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    return checkpointed(marked).withColumn("_part", F.shiftright("_at", 33))


def _with_summary(rows: DataFrame, summary: DataFrame, group: list[str], few: bool = False) -> DataFrame:
    """Join on (group, partition); NULL groups meet too. ``few``: the summary is known to be small."""
    renamed = summary.select(*[F.col(c).alias(f"_s_{c}") for c in (*group, "_part")], *[c for c in summary.columns if c not in (*group, "_part")])
    same = F.col("_part") == F.col("_s__part")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    renamed = F.broadcast(renamed) if few else broadcast_if_small(renamed)
    return rows.join(renamed, same, "left").drop(*[f"_s_{c}" for c in (*group, "_part")])


def with_previous(
    rows: DataFrame,
    group: list[str],
    order: str,
    value: str,
    name: str,
    default: Column | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Value of the row before, per group in ``order``; the same as ``lag`` over the whole group."""
    placed = _placed(rows, group, [order], partitions)
    last = placed.groupBy(*group, "_part").agg(F.max_by(F.struct(F.col(value).alias("v")), "_at").alias("_last"))
    between = Window.partitionBy(*group).orderBy("_part")
    carried = last.select(*group, "_part", F.lag("_last").over(between)["v"].alias("_carried"))
    within = Window.partitionBy("_part", *group).orderBy("_at")
    marked = placed.withColumns({"_is_first": F.row_number().over(within) == 1, "_near": F.lag(value).over(within)})
    before = F.when(F.col("_is_first"), F.col("_carried")).otherwise(F.col("_near"))
    if default is not None:
        before = F.coalesce(before, default)
    return _with_summary(marked, carried, group).withColumn(name, before).drop("_part", "_at", "_is_first", "_near", "_carried")


def with_running_total(
    rows: DataFrame, group: list[str], order: str, value: str, name: str, partitions: int | None = None
) -> DataFrame:
    """Sum of ``value`` up to and including each row, per group in ``order``."""
    placed = _placed(rows, group, [order], partitions)
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        placed.groupBy(*group, "_part")
        .agg(F.sum(value).alias("_sum"))
        .select(*group, "_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_carried"))
    )
    within = Window.partitionBy("_part", *group).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    return (
        _with_summary(placed.withColumn("_near", F.sum(value).over(within)), carried, group)
        .withColumn(name, F.col("_near") + F.col("_carried"))
        .drop("_part", "_at", "_near", "_carried")
    )


def with_running_max(
    rows: DataFrame, group: list[str], order: str, value: str, name: str, partitions: int | None = None
) -> DataFrame:
    """Largest ``value`` of all rows before each row, per group in ``order``; NULL for the first."""
    placed = _placed(rows, group, [order], partitions)
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    tops = placed.groupBy(*group, "_part").agg(F.max(value).alias("_top"))
    carried = tops.select(*group, "_part", F.max("_top").over(earlier).alias("_carried"))
    within = Window.partitionBy("_part", *group).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    marked = placed.withColumn("_near", F.max(value).over(within))
    return _with_summary(marked, carried, group).withColumn(name, F.greatest("_near", "_carried")).drop("_part", "_at", "_near", "_carried")


def with_row_number(
    rows: DataFrame, group: list[str], order: list[str], name: str = "row_no", max_groups: int | None = None
) -> DataFrame:
    """1-based place of each row in its group, for groups of any size.

    A large group spreads over many tasks. ``max_groups`` is a known bound on the number of groups. Building the result
    runs a job, since the rows are placed first.
    """
    placed = _placed(rows, group, order)
    runs = placed.groupBy("_part", *group).agg(F.min("_at").alias("_from"), F.count("*").alias("_rows"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = runs.select(
        "_part", *group, (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_from") + 1).alias("_shift")
    )
    # One row per partition plus one per group: small when the groups are known to be few.
    few = max_groups is not None and max_groups <= BROADCAST_ROWS
    out = _with_summary(placed, shifts, group, few)
    return out.withColumn(name, F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")
