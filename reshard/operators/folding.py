"""Net effect of ordered changes, and its merge into the target.

For every key two facts are enough, because images are full rows and an update of a missing row does
nothing: the last operation that is not an update (``base``), and the last image (``image``). Both are
maxima over positions, so they fold in any grouping and any arrival order: partial aggregation before
the shuffle, facts of facts, late deltas. The image is kept even when the net effect is a removal,
as an older insert may still arrive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reshard.functions.positions import position
from reshard.operators.routing import REMOVE, REVISE, UPSERT
from reshard.spec import TableSpec


def change_facts(operations: DataFrame, spec: TableSpec) -> DataFrame:
    """Operations (one key each) -> one row of facts per key. The key itself is not repeated in the image."""
    op = F.col("op")
    pos = F.col("pos").alias("_pos")
    values = [F.col("vals").getField(n).alias(n) for n in spec.values]
    return operations.groupBy(*spec.identity).agg(
        F.max(F.when(op != REVISE, F.struct(pos, op.alias("_op")))).alias("base"),
        F.max(F.when(op != REMOVE, F.struct(pos, *values))).alias("image"),
    )


def fold_facts(facts: DataFrame, spec: TableSpec) -> DataFrame:
    """Facts from several reads of the log -> one row of facts per key."""
    return facts.groupBy(*spec.identity).agg(F.max("base").alias("base"), F.max("image").alias("image"))


def merge_facts(base: DataFrame, later: DataFrame, spec: TableSpec) -> DataFrame:
    """Like ``fold_facts`` for two sides with one row per key; a bucketed base is then not shuffled."""
    late = later.select(*spec.identity, F.col("base").alias("_base"), F.col("image").alias("_image"))
    return base.join(late, spec.identity, "full_outer").select(
        *spec.identity, F.greatest("base", "_base").alias("base"), F.greatest("image", "_image").alias("image")
    )


def row_facts(rows: DataFrame, pos: Column, spec: TableSpec) -> DataFrame:
    """Existing rows as facts: inserted at a position before all changes that follow."""
    return rows.select(
        *spec.identity,
        F.struct(pos.alias("_pos"), F.lit(UPSERT).alias("_op")).alias("base"),
        F.struct(pos.alias("_pos"), *spec.values).alias("image"),
    )


def forget_absent(facts: DataFrame, passed: Column) -> DataFrame:
    """Drop facts of keys that do not exist and were last touched at or before the ``passed`` position.

    Right as long as changes up to that position are not folded again.
    """
    last = F.greatest("base._pos", "image._pos")
    absent = F.coalesce(F.col("base._op"), F.lit(REVISE)) != UPSERT
    gone = absent & (position(last.getField("log_file"), last.getField("log_pos")) <= passed)
    return facts.where(~F.coalesce(gone, F.lit(False)))


def net_operation(facts: DataFrame, spec: TableSpec) -> DataFrame:
    """Facts -> one operation per key: upsert, remove, or revise if present."""
    op = F.coalesce(F.col("base._op"), F.lit(REVISE))
    image = [F.col(k).alias(k) if k in spec.key else F.col("image").getField(k).alias(k) for k in spec.names]
    return facts.select(
        *spec.identity,
        op.alias("op"),
        F.when(op != REMOVE, F.struct(*image)).alias("vals"),
        F.greatest("base._pos", "image._pos").alias("pos"),
    )


def compact_changes(operations: DataFrame, spec: TableSpec) -> DataFrame:
    return net_operation(change_facts(operations, spec), spec)


def apply_changes(target: DataFrame, changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Target rows after the compacted changes: upsert, update if present, remove.

    Both sides hold a key at most once, so no key can be hot in this join; the compacted side is already
    partitioned on the join columns.
    """
    changed = changes.select(*spec.identity, F.col("op").alias("_op"), F.col("vals").alias("_vals"))
    existing = target.select(*spec.identity, *spec.values, F.lit(True).alias("_present"))
    merged = existing.join(changed, spec.identity, "full_outer")
    keeps = F.col("_op").isNull() | (F.col("_op") == UPSERT) | ((F.col("_op") == REVISE) & F.col("_present").isNotNull())

    def value(name: str) -> Column:
        return F.when(F.col("_op").isNull(), F.col(name)).otherwise(F.col("_vals").getField(name)).alias(name)

    return merged.where(keeps).select(*spec.identity, *[value(n) for n in spec.values])


def state_rows(facts: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows that exist after the facts alone, starting from an empty target."""
    present = net_operation(facts, spec).where(F.col("op") == UPSERT)
    return present.select(*spec.identity, *[F.col("vals").getField(n).alias(n) for n in spec.values])
