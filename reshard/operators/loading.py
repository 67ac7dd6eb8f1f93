"""First load of a table: deduplicate, order and batch the routed snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reshard.operators.ordered import with_row_number
from reshard.spec import TableSpec

_FIXED_WIDTH = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz")


def _fixed_width(kind: str) -> bool:
    return kind in _FIXED_WIDTH or kind.startswith("decimal")


def first_wins(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per target key: the one with the lowest snapshot id.

    Copies are folded before the shuffle. With fixed-width columns the fold is a hash aggregation; other
    columns are carried in one struct, which Spark folds after sorting.
    """
    values, kinds = spec.values, dict(rows.dtypes)
    if not values:
        return rows.select(*spec.identity).distinct()
    grouped = rows.groupBy(*spec.identity)
    if all(_fixed_width(kinds[c]) for c in [*values, spec.snapshot_id]):
        return grouped.agg(*[F.min_by(v, spec.snapshot_id).alias(v) for v in values])
    first = F.min(F.struct(F.col(spec.snapshot_id).alias("_order"), F.struct(*values).alias("_values")))
    return grouped.agg(first.alias("_first")).select(*spec.identity, "_first._values.*")


def insert_ignore(rows: DataFrame, spec: TableSpec, target: DataFrame | None = None) -> DataFrame:
    """Rows that a load which skips existing keys adds to the target."""
    first = first_wins(rows, spec)
    if target is not None:
        first = first.join(target.select(*spec.identity), spec.identity, "left_anti")
    return first


def reorder(rows: DataFrame, spec: TableSpec, partitions: int | None = None) -> DataFrame:
    """Rows in (shard, target key) order. The range covers the key too, so a large shard is split."""
    keys = ["shard", *spec.order]
    placed = rows.repartitionByRange(partitions, *keys) if partitions else rows.repartitionByRange(*keys)
    return placed.sortWithinPartitions(*keys)


def number_in_shard(rows: DataFrame, spec: TableSpec, order: tuple[str, ...] = ()) -> DataFrame:
    """Place of every row in its shard, from 1: in load order, or in another ``order``."""
    return with_row_number(rows, ["shard"], list(order or spec.order), max_groups=spec.table_count)


def load_batches(rows: DataFrame, batch_rows: int = 2000, run: int = 10_000) -> DataFrame:
    """Write batches per shard; the last one may be short.

    Batches are listed in runs that are spread over tasks, as a large shard can have very many.
    """
    counts = rows.groupBy("shard").agg(F.count("*").alias("_rows"))
    last = F.ceil(F.col("_rows") / F.lit(batch_rows)) - 1
    runs = counts.select(
        "shard", "_rows", last.alias("_last"), F.explode(F.sequence(F.lit(0).cast("bigint"), last, F.lit(run).cast("bigint"))).alias("_from")
    ).repartition("shard", "_from")
    to = F.least(F.col("_last"), F.col("_from") + (run - 1))
    return runs.select("shard", "_rows", F.explode(F.sequence("_from", to)).alias("batch_no")).select(
        "shard", "batch_no", F.least(F.lit(batch_rows), F.col("_rows") - F.col("batch_no") * batch_rows).alias("batch_rows")
    )


def first_of_batches(
    rows: DataFrame, spec: TableSpec, batch_rows: int = 2000, order: tuple[str, ...] = ()
) -> DataFrame:
    """The first row of each write batch of each shard: what a dry run prints.

    Snapshot rows are taken in load order, operations in log order with ``order=("pos",)``.
    """
    numbered = number_in_shard(rows, spec, order)
    return numbered.where((F.col("row_no") - 1) % batch_rows == 0).withColumn(
        "batch_no", F.floor((F.col("row_no") - 1) / F.lit(batch_rows))
    ).drop("row_no")


def first_of_shards(rows: DataFrame, spec: TableSpec, order: tuple[str, ...] = ()) -> DataFrame:
    """The first row of each shard only; folds before the shuffle and needs no numbering."""
    order = order or spec.order
    rest = [c for c in rows.columns if c != "shard" and c not in order]
    first = rows.groupBy("shard").agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return first.select("shard", "_first.*").select(*rows.columns)
