"""Continuous apply with the fold kept in Spark's state store.

The facts of a key are two maxima, so a streaming aggregation in update mode is the whole fold: a micro-batch reads and
writes the state of the keys it touches and hands on their facts, folded with everything before. No earlier batch and no
base is read again, late files and repeated batches change nothing that is already right, and what comes out of a batch
is the truth about its keys, so writing it twice does no harm.

The state lies below the checkpoint, where ``StateFold.facts`` reads it as a table. With RocksDB it may be larger than the
memory of the executors.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reshard.operators.changes import Rejects, accepted, hand_over, placed_in_log, rejected, routable
from reshard.operators.folding import change_facts, fold_facts, net_operation, state_rows
from reshard.operators.routing import split_key_moves
from reshard.plans.log_apply import typed_changes
from reshard.sinks.database import Connect, Ledger, write_operations
from reshard.spec import TableSpec
from reshard.streaming.files import Gate, Hold, start_batches, stored, wait_while

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SETTING = "spark.sql.streaming.stateStore.providerClass"

# Gets the facts of the keys that a batch has touched, and its number.
Handle = Callable[[DataFrame, int], None]


def folded_stream(events: DataFrame, spec: TableSpec, skip_refused: bool = False) -> DataFrame:
    """Stream of facts per key, to be written in update mode. Changes that cannot be routed fail the stream, or are left out."""
    changes = placed_in_log(typed_changes(events, spec))
    changes = accepted(changes) if skip_refused else routable(changes)
    return change_facts(split_key_moves(changes, spec), spec)


def refused_stream(events: DataFrame, spec: TableSpec) -> DataFrame:
    """Stream of the changes that ``folded_stream`` leaves out, with the reason."""
    return rejected(placed_in_log(typed_changes(events, spec)))


class StateFold:
    """Folds a change log in the state store; the number of shuffle partitions at the first start is that of the state."""

    def __init__(self, spec: TableSpec, checkpoint: str, paused: Gate | None = None, pause_seconds: float = 1.0) -> None:
        self.spec, self.checkpoint = spec, checkpoint.rstrip("/")
        self.paused, self.pause_seconds = paused, pause_seconds

    def start(self, events: DataFrame, handle: Handle, every: str | None = "2 seconds", skip_refused: bool = False) -> StreamingQuery:
        """Start the stream; without ``every`` it takes what is there and stops. A batch may come again after a crash."""
        events.sparkSession.conf.set(SETTING, PROVIDER)

        def run(facts: DataFrame, batch_id: int) -> None:
            wait_while(self.paused, self.pause_seconds)
            handle(facts, batch_id)

        return start_batches(folded_stream(events, self.spec, skip_refused), run, self.checkpoint, every, mode="update")

    def facts(self, spark: SparkSession) -> DataFrame:
        """Facts of all keys as of the last finished batch, read from the state store."""
        state = spark.read.format("statestore").load(self.checkpoint)
        kinds = dict(state.select("value.*").toDF("base", "image").dtypes)
        parts = state.select("key.*", F.col("value").cast(f"struct<base:{kinds['base']},image:{kinds['image']}>").alias("_value"))
        return parts.select(*self.spec.identity, "_value.base", "_value.image")

    def current(self, spark: SparkSession) -> DataFrame:
        """Rows of all shards as of the last finished batch."""
        return state_rows(self.facts(spark), self.spec)


class FoldedDatabases:
    """Applies a change log to shard databases; the databases hold the rows, the state store what is needed to order changes.

    ``hold`` marks shards that must wait. Facts of held keys stay in ``<checkpoint>-waiting``, one folder per batch, and go out
    with the first batch or ``release`` after they are due. ``rejects`` gets changes that cannot be routed, by a stream
    of its own (``refused_query``) with a checkpoint of its own, and when that one fails, so does the next batch; without
    ``rejects`` such changes fail the stream. A ``ledger`` keeps finished parts of a batch from being run again.
    """

    def __init__(
        self, spec: TableSpec, connect: Connect, checkpoint: str, paused: Gate | None = None, pause_seconds: float = 1.0,
        hold: Hold | None = None, rejects: Rejects = None, ledger: Ledger | None = None, **options,
    ) -> None:
        self.spec, self.connect, self.checkpoint, self.options = spec, connect, checkpoint.rstrip("/"), options
        self.fold = StateFold(spec, self.checkpoint, paused, pause_seconds)
        self.hold, self.rejects, self.ledger = hold, rejects, ledger
        self.refused_query: StreamingQuery | None = None
        # A release must not write facts that a running batch is about to replace.
        self._writing = threading.Lock()

    def start(self, events: DataFrame, every: str | None = "2 seconds") -> StreamingQuery:
        if self.rejects is not None:
            refused = refused_stream(events, self.spec)
            self.refused_query = start_batches(
                refused, lambda part, n: hand_over(part, self.rejects, n), f"{self.checkpoint}-rejects", every
            )
        return self.fold.start(events, self.process, every, skip_refused=self.rejects is not None)

    def _waiting(self, batch_id: int) -> str:
        return f"{self.checkpoint}-waiting/batch_id={batch_id}"

    def process(self, facts: DataFrame, batch_id: int) -> None:
        """Write what is due of the touched keys and of those that waited. Safe to repeat."""
        failed = self.refused_query.exception() if self.refused_query is not None else None
        if failed is not None:
            raise failed
        with self._writing:
            if self.hold is None and stored(facts.sparkSession, self._waiting(batch_id - 1)) is None:
                return self._write(facts, batch_id)
            facts = self._with_waiting(facts, batch_id).persist()
            try:
                marked = self._marked(facts)
                marked.where("held").drop("held").write.mode("overwrite").parquet(self._waiting(batch_id))
                self._write(marked.where("NOT held").drop("held"), batch_id)
            finally:
                facts.unpersist()

    def _with_waiting(self, facts: DataFrame, batch_id: int) -> DataFrame:
        before = stored(facts.sparkSession, self._waiting(batch_id - 1))
        return facts if before is None else fold_facts(facts.unionByName(before), self.spec)

    def _marked(self, facts: DataFrame) -> DataFrame:
        if self.hold is None:
            return facts.withColumn("held", F.lit(False))
        parts = [*self.spec.identity, "base", "image"]
        return self.hold(facts).select(*parts, F.coalesce("held", F.lit(False)).alias("held"))

    def _write(self, facts: DataFrame, batch_id: int | None) -> None:
        ledger = None if self.ledger is None or batch_id is None else self.ledger.at(batch_id)
        write_operations(net_operation(facts, self.spec), self.spec, self.connect, ledger=ledger, **self.options)

    def release(self, spark: SparkSession) -> None:
        """Write what waits and is due by now, without a new batch. What is written stays in its folder until the next batch,
        which writes it again: that does no harm, and nothing is lost if this is cut short."""
        with self._writing:
            folders = stored(spark, f"{self.checkpoint}-waiting")
            last = None if folders is None else folders.agg(F.max("batch_id")).first()[0]
            newest = self._last_waiting(spark)
            if last is None or newest is None or newest != last:
                return
            facts = folders.where(F.col("batch_id") == last).drop("batch_id")
            self._write(self._marked(facts).where("NOT held").drop("held"), None)

    def _last_waiting(self, spark: SparkSession) -> int | None:
        """Newest folder of waiting facts; one without rows counts, as nothing waits then."""
        context = spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(f"{self.checkpoint}-waiting")
        files = folder.getFileSystem(context._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
        return max((int(n.partition("=")[2]) for n in names if n.startswith("batch_id=")), default=None)
