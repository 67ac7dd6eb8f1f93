"""Which shard a row or change goes to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reshard.functions.events import DELETE, INSERT, UPDATE
from reshard.functions.hashing import database_alias, hash_key, shard_index
from reshard.functions.positions import change_position
from reshard.session import broadcast_if_small
from reshard.spec import SPLIT, TableSpec

# Kinds of routed operation.
INSERT_IGNORE = "N"
UPSERT = "I"
REVISE = "U"
REMOVE = "D"


def shard_of(key: Column, spec: TableSpec) -> Column:
    return shard_index(hash_key(key, _type_of(spec.column(spec.shard_by))), spec.shard_num, spec.location)


def keep_shards(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Drop the shards the table's own filter refuses. Runs before any shuffle."""
    return rows.where(spec.shard_filter(F.col("shard"))) if spec.shard_filter else rows


def route_snapshot(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Add the shard of every snapshot row and drop filtered shards. The key must not be NULL."""
    return keep_shards(rows.withColumn("shard", shard_of(F.col(spec.shard_by), spec)), spec)


def snapshot_rejects(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Snapshot rows with an incomplete key, which cannot be routed."""
    return rows.where(F.greatest(*[F.col(k).isNull().cast("int") for k in spec.key], F.lit(0)) == 1)


def snapshot_accepted(rows: DataFrame, spec: TableSpec) -> DataFrame:
    return rows.dropna("any", subset=list(spec.key))


def snapshot_complete(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """All rows; the job fails at the first one with an incomplete key."""
    missing = F.raise_error(F.lit(f"a row of {spec.table} has no complete key"))
    return rows.withColumns(
        {k: F.when(F.col(k).isNull(), missing.cast(rows.schema[k].dataType)).otherwise(F.col(k)) for k in spec.key}
    )


def _operation(op: str, key_image: Column, values: Column | None, sub: int, spec: TableSpec, shard: Column) -> Column:
    empty = F.lit(None).cast("struct<" + ",".join(f"{c.name}:{_type_of(c)}" for c in spec.columns) + ">")
    return F.struct(
        F.lit(op).alias("op"),
        F.lit(sub).alias("sub"),
        shard.alias("shard"),
        *[key_image.getField(k).alias(k) for k in spec.key],
        (empty if values is None else values).alias("vals"),
    )


def _type_of(column) -> str:
    if column.charset == "latin1":
        return "string"
    if column.unsigned:
        return {64: "decimal(20,0)", 32: "bigint"}.get(column.bits, "int")
    return column.type


def _finish(changes: DataFrame, operations: Column, spec: TableSpec) -> DataFrame:
    routed = changes.select(
        *(["source"] if "source" in changes.columns else []),
        "log_file",
        "log_pos",
        "row_idx",
        F.inline(operations),
    ).withColumn("pos", change_position(F.col("log_file"), F.col("log_pos"), F.col("row_idx"), F.col("sub")))
    return keep_shards(routed.drop("log_file", "log_pos", "row_idx", "sub"), spec)


def route_changes(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """One operation per change: insert and update go to the shard of the new key, delete to the old one.

    The key columns hold the key the operation looks for: the old key of an update or delete.
    """
    before, after = F.col("before"), F.col("after")
    new_shard, old_shard = shard_of(after.getField(spec.shard_by), spec), shard_of(before.getField(spec.shard_by), spec)
    one = (
        F.when(F.col("dml") == INSERT, _operation(UPSERT, after, after, 0, spec, new_shard))
        .when(F.col("dml") == UPDATE, _operation(REVISE, before, after, 0, spec, new_shard))
        .when(F.col("dml") == DELETE, _operation(REMOVE, before, None, 0, spec, old_shard))
    )
    return _finish(changes, F.array(one), spec)


def key_moved(spec: TableSpec) -> Column:
    same = F.lit(True)
    for name in spec.key:
        same = same & (F.col("before").getField(name) == F.col("after").getField(name))
    return ~same


def split_key_moves(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Like ``route_changes``, but an update that changes the key deletes the old row and inserts the new.

    Each operation then concerns exactly one key, which is what folding needs.
    """
    before, after = F.col("before"), F.col("after")
    new_shard, old_shard = shard_of(after.getField(spec.shard_by), spec), shard_of(before.getField(spec.shard_by), spec)
    insert = _operation(UPSERT, after, after, 0, spec, new_shard)
    update = _operation(REVISE, before, after, 0, spec, new_shard)
    delete = _operation(REMOVE, before, None, 0, spec, old_shard)
    moved_in = _operation(UPSERT, after, after, 1, spec, new_shard)
    if spec.on_key_move != SPLIT:
        changes = changes.where((F.col("dml") != UPDATE) | (new_shard == old_shard))
    operations = (
        F.when(F.col("dml") == INSERT, F.array(insert))
        .when(F.col("dml") == DELETE, F.array(delete))
        .when(key_moved(spec), F.array(delete, moved_in))
        .otherwise(F.array(update))
    )
    return _finish(changes, operations, spec)


def key_move_audit(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Updates that change the shard, counted per old and new shard."""
    return (
        changes.where(F.col("dml") == UPDATE)
        .select(
            shard_of(F.col("before").getField(spec.shard_by), spec).alias("old_shard"),
            shard_of(F.col("after").getField(spec.shard_by), spec).alias("new_shard"),
        )
        .where(F.col("old_shard") != F.col("new_shard"))
        .groupBy("old_shard", "new_shard")
        .agg(F.count("*").alias("moves"))
    )


def with_database(rows: DataFrame, directory: DataFrame, spec: TableSpec) -> DataFrame:
    """Add database, host and port of every row's shard.

    Only the aliases the table can use are joined, each once, so at most one row per database is broadcast.
    """
    databases = -(-spec.table_count // spec.replication)
    used = rows.sparkSession.range(databases).select(
        F.concat(F.lit("shard"), F.col("id").cast("string")).alias("alias")
    )
    others = [F.first(c).alias(c) for c in directory.columns if c != "alias"]
    places = directory.join(F.broadcast(used), "alias", "left_semi").groupBy("alias").agg(*others)
    return rows.withColumn("alias", database_alias(F.col("shard"), spec.replication)).join(
        broadcast_if_small(places), "alias", "left"
    )


