"""Several listeners on one log."""

from __future__ import annotations

import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reshard.functions.events import table_matches
from reshard.operators.reports import last_position
from reshard.streaming.files import start_batches, stored
from reshard.streaming.rotations import Rotations


@dataclass(frozen=True)
class Listener:
    """Wants the changes of matching tables. ``wait=False`` lets it run beside the others."""

    name: str
    database_pattern: str
    table_pattern: str
    handler: Callable[[DataFrame, int], None] | None = None
    wait: bool = True

    def __post_init__(self) -> None:
        if not self.database_pattern or not self.table_pattern:
            raise ValueError("a listener needs a database and a table pattern")

    def matches(self) -> Column:
        return table_matches(F.col("database_name"), F.col("table_name"), self.database_pattern, self.table_pattern)


def notify(changes: DataFrame, listeners: list[Listener], batch_id: int = 0) -> None:
    """Hand each listener its part of one batch; returns when all are done, so no failure is lost."""
    changes = changes.persist()
    try:
        with ThreadPoolExecutor(max_workers=max(1, len(listeners))) as pool:
            running = []
            for listener in listeners:
                part = changes.where(listener.matches())
                if listener.wait:
                    listener.handler(part, batch_id)
                else:
                    running.append(pool.submit(listener.handler, part, batch_id))
            for one in running:
                one.result()
    finally:
        changes.unpersist()


def listen(
    changes: DataFrame, listeners: list[Listener], checkpoint: str, every: str | None = "2 seconds", rotating: bool = False
) -> StreamingQuery:
    """Fan a stream out to the listeners. Events of a ``rotating`` log, which names its files by rotations only, get their file."""
    turns = Rotations(f"{checkpoint}-rotations")

    def run(batch: DataFrame, batch_id: int) -> None:
        notify(turns.place(batch, batch_id) if rotating else batch, listeners, batch_id)

    return start_batches(changes, run, checkpoint, every)


def listen_each(
    changes: DataFrame, listeners: list[Listener], checkpoint: str, every: str | None = "2 seconds"
) -> dict[str, StreamingQuery]:
    """Fan a stream out so that each listener goes at its own pace: a query per listener, with a checkpoint below its name.

    A listener that fails stops alone. The others go on, and do not get their batches again when it is started again; it
    goes on with the batch it failed at. The log is read once per listener, of which only the matching rows leave
    the scan. After each batch, and so at most once per batch that is handled, the listener's progress is stored.
    """
    names = [one.name for one in listeners]
    if len(set(names)) != len(names) or not all(re.fullmatch(r"[\w-]+", n) for n in names):
        raise ValueError("listeners need different names of letters, digits, _ and -")

    def run(listener: Listener) -> Callable[[DataFrame, int], None]:
        def handle(part: DataFrame, batch_id: int) -> None:
            part = part.persist()
            try:
                listener.handler(part, batch_id)
                _progress(part).write.mode("overwrite").parquet(f"{checkpoint}/{listener.name}/handled/batch_id={batch_id}")
            finally:
                part.unpersist()

        return handle

    return {
        one.name: start_batches(changes.where(one.matches()), run(one), f"{checkpoint}/{one.name}/checkpoint", every)
        for one in listeners
    }


def _progress(part: DataFrame) -> DataFrame:
    rows = part.groupBy("source").agg(F.count("*").alias("rows"))
    return last_position(part).join(rows, "source").coalesce(1)


def listener_positions(spark: SparkSession, listeners: list[Listener], checkpoint: str) -> DataFrame:
    """listener, source, log_file, log_pos, rows: how far each listener has come, and what it has handled."""
    parts = [spark.createDataFrame([], "listener string, source string, log_file string, log_pos bigint, rows bigint")]
    for one in listeners:
        handled = stored(spark, f"{checkpoint}/{one.name}/handled", "source string, log_file string, log_pos bigint, rows bigint")
        if handled is not None:
            told = handled.groupBy("source").agg(F.max(F.struct("log_file", "log_pos")).alias("at"), F.sum("rows").alias("rows"))
            parts.append(told.select(F.lit(one.name).alias("listener"), "source", "at.log_file", "at.log_pos", "rows"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def listener_counts(changes: DataFrame, listeners: list[Listener]) -> DataFrame:
    """Matching changes per listener, counted in one pass over the log."""
    counts = changes.agg(*[F.count_if(listener.matches()).alias(f"n{i}") for i, listener in enumerate(listeners)])
    pairs = [F.struct(F.lit(one.name).alias("listener"), F.col(f"n{i}").alias("rows")) for i, one in enumerate(listeners)]
    return counts.select(F.inline(F.array(*pairs)))
