"""Writing operations to shard databases through any DB-API driver."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from contextlib import suppress
from dataclasses import dataclass, replace
from itertools import groupby
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from reshard.operators.routing import INSERT_IGNORE, REMOVE, REVISE
from reshard.operators.reports import statement
from reshard.spec import TableSpec

Connect = Callable[[int], Any]


@dataclass(frozen=True)
class Ledger:
    """A table in each shard database that tells which parts of which batch it has: (stream, part, batch_id).

    The entry of a part is written in the same transaction as its rows, so a part that is tried again after a lost answer, a
    lost task or a restart is either not there at all or left alone. Rows are dealt to ``parts`` by a hash of their key, so that
    a part has the same rows whichever task runs it.
    """

    stream: str
    parts: int = 64
    table: str = "applied_batches"
    batch_id: int = 0

    def at(self, batch_id: int) -> Ledger:
        return replace(self, batch_id=batch_id)

    def has(self, cursor: Any, part: int, marker: str) -> bool:
        """Whether the database has this part of this batch, or of a later one."""
        asked = f"select batch_id from {self.table} where stream=? and part=?".replace("?", marker)
        cursor.execute(asked, [self.stream, part])
        found = cursor.fetchone()
        return found is not None and found[0] >= self.batch_id

    def enter(self, cursor: Any, part: int, marker: str) -> None:
        entered = f"replace into {self.table} (stream, part, batch_id) values (?, ?, ?)".replace("?", marker)
        cursor.execute(entered, [self.stream, part, self.batch_id])


def _batches(rows: Iterable[Row], size: int) -> Iterator[tuple[int, list[Row]]]:
    for shard, group in groupby(rows, key=lambda r: r["shard"]):
        batch: list[Row] = []
        for row in group:
            batch.append(row)
            if len(batch) == size:
                yield shard, batch
                batch = []
        if batch:
            yield shard, batch


def _arguments(row: Row, spec: TableSpec) -> list[Any]:
    image = [] if row["op"] == REMOVE else [row["vals"][n] for n in spec.names]
    old_key = [row[k] for k in spec.key] if row["op"] in (REMOVE, REVISE) else []
    return image + old_key


def _parts(rows: Iterable[Row]) -> Iterator[tuple[int, list[Row]]]:
    """Rows by shard and part of the ledger: each part is one transaction."""
    for (shard, _), group in groupby(rows, key=lambda r: (r["shard"], r["_part"])):
        yield shard, list(group)


def _execute(connection: Any, batch: list[Row], spec: TableSpec, marker: str, ledger: Ledger | None = None) -> None:
    cursor = connection.cursor()
    if ledger is not None:
        if ledger.has(cursor, batch[0]["_part"], marker):
            return
        ledger.enter(cursor, batch[0]["_part"], marker)
    if all(row["op"] == INSERT_IGNORE for row in batch):
        flat = [value for row in batch for value in _arguments(row, spec)]
        cursor.execute(statement(INSERT_IGNORE, spec, len(batch)).replace("?", marker), flat)
    else:
        for row in batch:
            cursor.execute(statement(row["op"], spec).replace("?", marker), _arguments(row, spec))
    connection.commit()


def write_operations(
    operations: DataFrame,
    spec: TableSpec,
    connect: Connect,
    batch_rows: int = 2000,
    attempts: int = 10,
    wait_seconds: float = 1.0,
    marker: str = "?",
    tasks: int | None = None,
    ledger: Ledger | None = None,
) -> None:
    """Run operations on their shards, one transaction per batch, in key order within a shard.

    Operations should be compacted, one per key; every statement may be repeated without harm, so failed
    batches and failed tasks are simply tried again. Rows that insert-ignore go out as one statement per
    batch. A large shard is spread over several tasks, each with its own connection; ``tasks`` bounds them.

    With a ``ledger`` a transaction is one of its parts, and parts that a database has already are not run again. Give it
    as many parts as leave about ``batch_rows`` rows to each.
    """
    keys = ["shard", *spec.order_of("vals")]
    if ledger is None:
        placed = operations.repartitionByRange(tasks, *keys) if tasks else operations.repartitionByRange(*keys)
    else:
        part = F.pmod(F.xxhash64(*spec.key), F.lit(ledger.parts)).cast("int")
        operations, keys = operations.withColumn("_part", part), ["shard", "_part", *spec.order_of("vals")]
        # A part must not be spread over tasks.
        placed = operations.repartition(tasks, "shard", "_part") if tasks else operations.repartition("shard", "_part")
    ordered = placed.sortWithinPartitions(*keys)

    def run(rows: Iterator[Row]) -> None:
        shard_open, connection = None, None
        try:
            for shard, batch in _batches(rows, batch_rows) if ledger is None else _parts(rows):
                for attempt in range(1, attempts + 1):
                    try:
                        if connection is None or shard != shard_open:
                            _quietly(connection, "close")
                            connection = None
                            connection, shard_open = connect(shard), shard
                        _execute(connection, batch, spec, marker, ledger)
                        break
                    except Exception:
                        # A connection that failed may be dead: the next attempt opens another.
                        _quietly(connection, "rollback")
                        _quietly(connection, "close")
                        connection = None
                        if attempt == attempts:
                            raise
                        time.sleep(wait_seconds)
        finally:
            _quietly(connection, "close")

    ordered.foreachPartition(run)


def _quietly(connection: Any, step: str) -> None:
    """Roll back or close what may be broken already."""
    if connection is not None:
        with suppress(Exception):
            getattr(connection, step)()
