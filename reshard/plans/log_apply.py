"""From log events to the changed target, in one batch job."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reshard.functions.positions import change_position
from reshard.operators.changes import (
    Rejects,
    expand_row_images,
    hand_over,
    match_tables,
    placed_in_log,
    project_changes,
    routable,
)
from reshard.operators.folding import apply_changes, change_facts, compact_changes, fold_facts, row_facts, state_rows
from reshard.operators.routing import split_key_moves
from reshard.operators.routing import route_snapshot, snapshot_accepted, snapshot_complete, snapshot_rejects
from reshard.plans.batch_load import load_rows
from reshard.sinks.database import Connect, write_operations
from reshard.sinks.files import read_shards, write_shards
from reshard.session import broadcast_if_small
from reshard.sources.changelog import after
from reshard.spec import TableSpec


def typed_changes(events: DataFrame, spec: TableSpec) -> DataFrame:
    """Events of the wanted tables as typed changes; ``reason`` marks the ones that cannot be routed."""
    return project_changes(expand_row_images(match_tables(events, spec)), spec)


def single_key_operations(events: DataFrame, spec: TableSpec, rejects: Rejects = None) -> DataFrame:
    """Operations of the wanted tables, each on one key, with filtered shards already gone.

    Changes that cannot be routed go to ``rejects``; without one the job fails at the first of them.
    """
    return split_key_moves(routable(placed_in_log(typed_changes(events, spec)), rejects), spec)


def only_shards(rows: DataFrame, shards: Collection[int] | None) -> DataFrame:
    return rows if shards is None else rows.where(F.col("shard").isin(*shards))


def touched_shards(events: DataFrame, spec: TableSpec, rejects: Rejects = None) -> list[int]:
    """Shards these events change; at most one number per shard."""
    return sorted(r["shard"] for r in single_key_operations(events, spec, rejects).select("shard").distinct().collect())


def apply_log(
    target: DataFrame,
    events: DataFrame,
    spec: TableSpec,
    rejects: Rejects = None,
    shards: Collection[int] | None = None,
) -> DataFrame:
    """Target rows after the events. ``shards`` limits both sides before they meet, down to the files of the target."""
    operations = only_shards(single_key_operations(events, spec, rejects), shards)
    return apply_changes(only_shards(target, shards), compact_changes(operations, spec), spec)


def apply_log_to_shards(
    old_path: str,
    events: DataFrame,
    spec: TableSpec,
    new_path: str,
    rejects: Rejects = None,
    shards: Collection[int] | None = None,
) -> None:
    """Shard folders after these events, written beside the old ones, which stay as they are.

    With ``shards`` (as from ``touched_shards``) only those are read and written; the other folders stay valid.
    """
    target = read_shards(events.sparkSession, old_path)
    write_shards(apply_log(target, events, spec, rejects, shards), spec, new_path)


def apply_log_to_databases(
    events: DataFrame, spec: TableSpec, connect: Connect, rejects: Rejects = None, **options
) -> None:
    """Net changes of these events, run on the shard databases."""
    operations = single_key_operations(events, spec, rejects)
    write_operations(compact_changes(operations, spec), spec, connect, **options)


def bootstrap_state(
    snapshot: DataFrame, events: DataFrame, starts: DataFrame, spec: TableSpec, rejects: Rejects = None
) -> DataFrame:
    """Snapshot, then the log behind ``starts`` (source, start position); all of it for sources without a start.

    The start must not be later than the moment the snapshot began: applying older changes again is
    harmless, missing newer ones is not. ``rejects`` gets refused rows of the snapshot and refused changes; a path is
    a folder with one part for each.
    """
    of_rows, of_log = (f"{rejects}/{p}" if isinstance(rejects, str) else rejects for p in ("snapshot", "log"))
    rows = load_rows(snapshot, spec, rejects=of_rows)
    return apply_log(rows, after(events, starts, keep_unknown=True), spec, of_log)


def bootstrap_chunks(
    chunks: DataFrame, marks: DataFrame, events: DataFrame, spec: TableSpec, rejects: Rejects = None, chunk: str = "chunk"
) -> DataFrame:
    """Snapshot and log in one, where each chunk of the snapshot was read at a time of its own, while the log went on.

    ``marks`` (chunk, and source with the spec's source column, ``low``) has a log position from before the chunk was read. A row counts
    as inserted there: changes behind the mark win over what the chunk has, since it may or may not have seen them, and
    changes up to it are in the chunk. So the log is needed from the first mark on only, the chunks can be read in any
    order and again, and no table is locked.

    A chunk read twice gives the row with the later mark. Chunks without a mark, and rows without a complete key, are refused:
    they go to ``rejects``, or fail the job.
    """
    of_rows, of_log = (f"{rejects}/{p}" if isinstance(rejects, str) else rejects for p in ("snapshot", "log"))
    if rejects is not None:
        hand_over(snapshot_rejects(chunks, spec), of_rows)
        rows = snapshot_accepted(chunks, spec)
    else:
        rows = snapshot_complete(chunks, spec)
    keys = [chunk, *([spec.source] if spec.source else [])]
    placed = route_snapshot(rows, spec).join(broadcast_if_small(marks.select(*keys, "low")), keys, "left")
    if rejects is not None:
        hand_over(placed.where(F.col("low").isNull()).drop("low"), of_rows)
        placed = placed.where(F.col("low").isNotNull())
    text = F.concat(F.lit("no mark for chunk "), F.coalesce(F.col(chunk).cast("string"), F.lit("NULL")))
    known = F.when(F.col("low").isNull(), F.raise_error(text).cast("string")).otherwise(F.col("low.log_file"))
    at = change_position(known, F.col("low.log_pos"), F.lit(2**31 - 1))
    if spec.snapshot_id in placed.columns:  # of rows with the same key in one read the first id is kept, as in every load
        values = F.min_by(F.struct(*spec.values), spec.snapshot_id).alias("_values")
        placed = placed.groupBy(*spec.identity, at.alias("_read")).agg(values).select(*spec.identity, "_read", "_values.*")
    else:
        placed = placed.select(*spec.identity, at.alias("_read"), *spec.values)
    facts = row_facts(placed, F.col("_read"), spec)
    return state_rows(fold_facts(facts.unionByName(change_facts(single_key_operations(events, spec, of_log), spec)), spec), spec)
