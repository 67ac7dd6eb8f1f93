"""First load: read, route, filter, deduplicate, order, write."""

from __future__ import annotations

from pyspark.sql import DataFrame

from reshard.operators.changes import Rejects, hand_over
from reshard.operators.loading import insert_ignore
from reshard.operators.reports import snapshot_operations
from reshard.operators.routing import route_snapshot, snapshot_accepted, snapshot_complete, snapshot_rejects
from reshard.sinks.database import Connect, write_operations
from reshard.sinks.files import write_shards
from reshard.spec import TableSpec


def load_rows(
    snapshot: DataFrame, spec: TableSpec, target: DataFrame | None = None, rejects: Rejects = None
) -> DataFrame:
    """Rows the load adds to the shards. Rows without a complete key go to ``rejects``, or fail the job without one."""
    if rejects is not None:
        hand_over(snapshot_rejects(snapshot, spec), rejects)
        rows = snapshot_accepted(snapshot, spec)
    else:
        rows = snapshot_complete(snapshot, spec)
    return insert_ignore(route_snapshot(rows, spec), spec, target)


def batch_load(
    snapshot: DataFrame, spec: TableSpec, path: str, mode: str = "errorifexists", rejects: Rejects = None
) -> None:
    write_shards(load_rows(snapshot, spec, rejects=rejects), spec, path, mode)


def load_databases(
    snapshot: DataFrame, spec: TableSpec, connect: Connect, rejects: Rejects = None, **options
) -> None:
    """The same load into shard databases, with statements that skip existing keys."""
    rows = load_rows(snapshot, spec, rejects=rejects)
    write_operations(snapshot_operations(rows, spec), spec, connect, **options)
