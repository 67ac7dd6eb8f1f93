"""Continuous apply: every micro-batch of the log becomes one folder of folded changes.

Layout below the state path:

    delta/batch_id=B/      facts per key of micro-batch B; written again in full when B is repeated
    rejects/batch_id=B/    changes that could not be routed; no folder when there were none
    held/batch_id=B/       facts of all keys whose shard is held back after batch B
    released/batch_id=B/   facts that were held and became due without a new batch, after batch B; one folder per call in it
    sent/batch_id=B/       calls of release whose facts a database stream has written by the end of batch B
    positions/batch_id=B/  newest position per source so far; written last, so it also marks B as complete
    rotations/batch_id=B/  all rotations so far, for logs that name their file by rotations only
    base/upto=B/           facts per key of all batches up to B, from a compaction; -1 is a loaded snapshot
    compactions/upto=B/    marks that base as complete
    forgotten/upto=B/      positions up to which removed keys were forgotten; changes up to there are skipped
    checkpoint/            progress of the stream

The current rows are the fold of the newest base and the deltas behind it. The fold orders by log position,
so repeated batches and late files change nothing that is already right. Folders of batches before the
newest base are not read any more; ``vacuum`` removes them, but for the last ones that later batches build on.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Collection
from hashlib import sha256

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reshard.functions.positions import change_position, position
from reshard.operators.changes import (
    Rejects,
    accepted,
    hand_over,
    placed_in_log,
    rejected,
    skip_applied,
)
from reshard.operators.folding import (
    change_facts,
    fold_facts,
    forget_absent,
    merge_facts,
    net_operation,
    row_facts,
    state_rows,
)
from reshard.operators.loading import first_of_shards
from reshard.operators.reports import last_position, render_statements
from reshard.operators.routing import split_key_moves
from reshard.plans.log_apply import only_shards, typed_changes
from reshard.session import broadcast_if_small, checkpointed
from reshard.sinks.database import Connect, write_operations
from reshard.spec import TableSpec
from reshard.streaming.files import Gate, Hold, start_batches, stored as _stored, wait_while
from reshard.streaming.rotations import Rotations
from reshard.streaming.state_fold import FoldedDatabases

POSITIONS = "source string, log_file string, log_pos bigint"
CALLS = "call string"


class StreamApply:
    """Applies a change log to the state below ``path``."""

    def __init__(
        self,
        spec: TableSpec,
        path: str,
        paused: Gate | None = None,
        pause_seconds: float = 1.0,
        rotating: bool = False,
        buckets: int | None = None,
        preview: Callable[[DataFrame, int], None] | None = None,
        progress: Callable[[int, dict], None] | None = None,
        hold: Hold | None = None,
        compact_every: int | None = None,
    ) -> None:
        """``paused`` is asked before every batch. ``rotating`` logs name their file by rotation events only.

        ``buckets`` (at least the number of shuffle partitions) keeps the base in buckets of its keys, so that
        reading and compacting shuffle the deltas only; without it the base is kept in shard order.
        ``preview`` makes a dry run: it gets the first operation of every shard, and nothing is stored; it has a
        checkpoint of its own, so that a later run reads the same log again.
        ``progress`` is told after every batch how many changes it had, how many were rejected, and how many
        operations went to each database; the counts are taken along the way.
        ``hold`` marks shards that must wait, as ``throttle_split`` does for hosts whose replicas are behind. Their
        changes are kept and folded with later ones until they are due; all others go on.
        ``compact_every`` so many batches the deltas are folded into a new base and what that makes obsolete is removed, so
        that neither the folders nor what a read has to fold grow with the age of the stream. Give it to streams that
        nobody else reads an older base of.
        """
        self.spec, self.path = spec, path.rstrip("/")
        self.paused, self.pause_seconds, self.rotating = paused, pause_seconds, rotating
        self.buckets, self.preview, self.progress, self.hold = buckets, preview, progress, hold
        self.compact_every = compact_every

    def _at(self, part: str, batch_id: int) -> str:
        return f"{self.path}/{part}/batch_id={batch_id}"

    def process(self, events: DataFrame, batch_id: int) -> None:
        """Fold one micro-batch and store it. Safe to repeat."""
        wait_while(self.paused, self.pause_seconds)
        spark = events.sparkSession
        events = self._placed(events, batch_id)
        if self.preview is not None:
            operations = split_key_moves(accepted(self._changes(events)), self.spec)
            first = first_of_shards(operations, self.spec, ("pos",))
            return self.preview(render_statements(first, self.spec), batch_id)
        events = events.persist()
        try:
            changes = self._changes(events)
            counted, done = self._observed(changes)
            facts = change_facts(done, self.spec)
            if self.hold is None:
                # The fold leaves the facts partitioned by key, so they are only sorted, not shuffled again.
                facts = facts.sortWithinPartitions("shard", *self.spec.order_of("image"))
                facts.write.mode("overwrite").parquet(self._at("delta", batch_id))
            else:
                self._split(facts, self._at("held", batch_id - 1), self._at("delta", batch_id), self._at("held", batch_id))
            if counted[0].get["rejected"]:
                rejected(changes).write.mode("overwrite").parquet(self._at("rejects", batch_id))
            read = events.where(F.col("rows").isNotNull() & F.col("log_file").isNotNull())
            read = read.select("source", "log_file", "log_pos")
            before = _stored(spark, self._at("positions", batch_id - 1), POSITIONS)
            newest = last_position(read if before is None else read.unionByName(before))
            newest.coalesce(1).write.mode("overwrite").parquet(self._at("positions", batch_id))
            if self.progress is not None:
                self.progress(batch_id, {name: value for one in counted for name, value in one.get.items()})
        finally:
            events.unpersist()

    def _changes(self, events: DataFrame) -> DataFrame:
        return placed_in_log(typed_changes(events, self.spec))

    def _placed(self, events: DataFrame, batch_id: int) -> DataFrame:
        """Events with their log file, without those that lie before what was forgotten."""
        spark = events.sparkSession
        if self.rotating:
            events = Rotations(f"{self.path}/rotations").place(events, batch_id, remember=self.preview is None)
        passed = self._forgotten(spark)
        return events if passed is None else skip_applied(events, passed)

    def _split(self, facts: DataFrame, held_before: str, due_path: str, held_path: str) -> None:
        """Store what is due and what is held, of new facts and of those held so far."""
        before = _stored(facts.sparkSession, held_before)
        if before is not None:
            facts = fold_facts(facts.unionByName(before), self.spec)
        marked = self.hold(facts).withColumn("held", F.coalesce("held", F.lit(False)))
        parts = [*self.spec.identity, "base", "image"]
        marked = marked.select(*parts, "held").persist()
        try:
            marked.where("NOT held").select(*parts).write.mode("overwrite").parquet(due_path)
            marked.where("held").select(*parts).write.mode("overwrite").parquet(held_path)
        finally:
            marked.unpersist()

    def moved(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """Net operations of the keys whose fold went forward with this batch, and of those released but not yet sent.

        Earlier facts are cut down to these keys before they are folded, and read from the shards of these keys only.
        """
        identity, parts = self.spec.identity, [*self.spec.identity, "base", "image"]
        new = spark.read.parquet(self._at("delta", batch_id)).select(*parts)
        unsent = self.unsent(spark, batch_id)
        if unsent is not None:
            new = fold_facts(new.unionByName(unsent.select(*parts)), self.spec)
        new = new.persist()
        try:
            shards = [r["shard"] for r in new.select("shard").distinct().collect()]
            keys = broadcast_if_small(new.select(*identity))
            before = self.facts(spark, batch_id - 1, shards, keys) if batch_id > 0 or self._base(spark)[1] is not None else None
            if before is None:
                return net_operation(checkpointed(new), self.spec)
            old = before.select(*identity, F.col("base").alias("_base"), F.col("image").alias("_image"), F.lit(True).alias("_known"))
            again = [] if unsent is None else [unsent.select(*identity).distinct().withColumn("_unsent", F.lit(True))]
            both = new.join(old, identity, "left")
            for marks in again:
                both = both.join(marks, identity, "left")
            base, image = F.greatest("base", "_base"), F.greatest("image", "_image")
            went_on = ~(base.eqNullSafe(F.col("_base")) & image.eqNullSafe(F.col("_image")))
            if again:
                went_on = went_on | F.coalesce("_unsent", F.lit(False))
            moved = both.where(went_on).select(*identity, base.alias("base"), image.alias("image"))
            return net_operation(checkpointed(moved), self.spec)
        finally:
            new.unpersist()

    def _calls(self, spark: SparkSession) -> DataFrame | None:
        """Facts of all calls of release, with the call they came from."""
        released = _stored(spark, f"{self.path}/released")
        return released if released is None or "call" in released.columns else released.withColumn("call", F.lit(""))

    def unsent(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """Released facts that no batch before this one has sent to databases."""
        released, sent = self._calls(spark), _stored(spark, self._at("sent", batch_id - 1), CALLS)
        if released is None or sent is None:
            return released
        return released.join(F.broadcast(sent), "call", "left_anti")

    def mark_sent(self, spark: SparkSession, batch_id: int, sent: list[str]) -> None:
        """Remember the calls of release whose facts are in the databases after this batch."""
        rows = spark.createDataFrame([(c,) for c in sent], CALLS)
        rows.coalesce(1).write.mode("overwrite").parquet(self._at("sent", batch_id))

    def release_calls(self, spark: SparkSession) -> list[str]:
        """Names of all calls of release so far that had something to release; few, as each is made by hand."""
        released = self._calls(spark)
        return [] if released is None else [r["call"] for r in released.select("call").distinct().collect()]

    def release(self, spark: SparkSession) -> None:
        """Ask ``hold`` again about what is held, without waiting for a new batch. Safe to repeat: what was released before
        is not released again."""
        last = self.last_batch(spark)
        held = None if last is None else _stored(spark, self._at("held", last))
        if held is None:
            return
        parts = [*self.spec.identity, "base", "image"]
        marked = held if self.hold is None else self.hold(held).where(~F.coalesce("held", F.lit(False)))
        due = marked.select(*parts)
        before = self._calls(spark)
        if before is not None:
            known = before.where(F.col("batch_id") == last).select(*parts).alias("k")
            same = [F.col(f"d.{c}").eqNullSafe(F.col(f"k.{c}")) for c in parts]
            due = due.alias("d").join(known, same, "left_anti")
        # What is released stays among the held facts of its batch: folding it twice is harmless, losing it is not.
        due = due.persist()
        try:
            if not due.isEmpty():
                due.write.parquet(f"{self._at('released', last)}/call={uuid.uuid4().hex}")
        finally:
            due.unpersist()

    def _observed(self, changes: DataFrame) -> tuple[list[Observation], DataFrame]:
        """Single-key operations, with counters attached that fill up along the way."""
        read, pushed = Observation(), Observation()
        refused = F.count_if(F.col("reason").isNotNull()).alias("rejected")
        changes = changes.observe(read, F.count("*").alias("changes"), refused)
        operations = split_key_moves(accepted(changes), self.spec)
        if self.progress is None:
            return [read], operations
        database = F.floor(F.col("shard") / self.spec.replication)
        databases = -(-self.spec.table_count // self.spec.replication)
        per_database = [F.count_if(database == i) for i in range(databases)]
        return [read, pushed], operations.observe(pushed, F.array(*per_database).alias("pushed"))

    def start(self, events: DataFrame, every: str | None = "2 seconds") -> StreamingQuery:
        """Start the stream; without ``every`` it takes what is there and stops."""
        checkpoint = "checkpoint" if self.preview is None else "preview-checkpoint"

        def run(batch: DataFrame, batch_id: int) -> None:
            self.process(batch, batch_id)
            self.tidy(batch.sparkSession, batch_id)

        return start_batches(events, run, f"{self.path}/{checkpoint}", every)

    def tidy(self, spark: SparkSession, batch_id: int) -> None:
        """After every ``compact_every`` batches: compact, and remove what is obsolete. For when nothing else reads the batch."""
        if self.compact_every and self.preview is None and (batch_id + 1) % self.compact_every == 0:
            self.compact(spark)
            self.vacuum(spark)

    def seed(self, rows: DataFrame, starts: DataFrame | tuple[str, int]) -> None:
        """Begin with loaded rows, taken to be as old as the log position from which changes are read.

        ``starts`` is (source, start) with the spec's source column, or one (file, offset) without it.
        """
        if self.spec.source:
            placed = rows.join(broadcast_if_small(starts), self.spec.source, "left")
            log_file, log_pos = F.coalesce("start.log_file", F.lit("")), F.coalesce("start.log_pos", F.lit(0))
        else:
            placed, log_file, log_pos = rows, F.lit(starts[0]), F.lit(starts[1])
        self._store_base(row_facts(placed, change_position(log_file, log_pos, F.lit(-1)), self.spec), -1)

    def _store_base(self, facts: DataFrame, upto: int) -> None:
        path, identity = f"{self.path}/base/upto={upto}", self.spec.identity
        if self.buckets:
            placed = facts.repartition(self.buckets, *identity).write.bucketBy(self.buckets, *identity)
            placed.sortBy(*identity).mode("overwrite").option("path", path).saveAsTable(self._table(upto))
        else:
            keys = ["shard", *self.spec.order_of("image")]
            ordered = facts.repartitionByRange(*keys).sortWithinPartitions(*keys)
            ordered.write.mode("overwrite").parquet(path)
        done = facts.sparkSession.range(1).select(F.lit(self.buckets).cast("int").alias("buckets"))
        done.write.mode("overwrite").parquet(f"{self.path}/compactions/upto={upto}")

    def _table(self, upto: int) -> str:
        """Catalog name of a bucketed base; the catalog may be forgetful, the files are what counts."""
        return f"reshard_{sha256(self.path.encode()).hexdigest()[:32]}_{upto + 1}"

    def _base(self, spark: SparkSession) -> tuple[int, DataFrame | None]:
        done = _stored(spark, f"{self.path}/compactions", "buckets int, upto int")
        last = None if done is None else done.orderBy(F.desc("upto")).first()
        if last is None:
            return -1, None
        upto, buckets, path = last["upto"], last["buckets"], f"{self.path}/base/upto={last['upto']}"
        files = spark.read.parquet(path)
        if not buckets:
            return upto, files
        if not spark.catalog.tableExists(self._table(upto)):
            columns = ", ".join(f"`{name}` {kind}" for name, kind in files.dtypes)
            keys = ", ".join(f"`{k}`" for k in self.spec.identity)
            spark.sql(
                f"CREATE TABLE {self._table(upto)} ({columns}) USING parquet "
                f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{path}'"
            )
        return upto, spark.table(self._table(upto))

    def facts(
        self, spark: SparkSession, upto: int | None = None, shards: Collection[int] | None = None, keys: DataFrame | None = None
    ) -> DataFrame | None:
        """Folded facts of all complete batches, or of those up to ``upto``.

        ``shards`` limits what is read, ``keys`` (rows with the identity) what is folded.
        """

        def wanted(facts: DataFrame) -> DataFrame:
            facts = only_shards(facts, shards)
            return facts if keys is None else facts.join(keys, self.spec.identity, "left_semi")

        last = self.last_batch(spark)
        from_base, base = self._base(spark)
        base = None if base is None else wanted(base)
        if last is None:
            return base
        last = last if upto is None else min(last, upto)
        parts = [*self.spec.identity, "base", "image"]
        # A batch may have released facts after it was complete, and a base may have been made in between.
        later = [(_stored(spark, f"{self.path}/delta"), from_base + 1), (self._calls(spark), from_base)]
        found = [wanted(f.where(F.col("batch_id").between(first, last)).select(*parts)) for f, first in later if f is not None]
        if not found:
            return base
        deltas = found[0] if len(found) == 1 else found[0].unionByName(found[1])
        deltas = fold_facts(deltas, self.spec)
        return deltas if base is None else merge_facts(base, deltas, self.spec)

    def current(self, spark: SparkSession, shards: Collection[int] | None = None) -> DataFrame | None:
        """Rows of all shards, or of some, as of the last complete batch; None before the first."""
        facts = self.facts(spark, shards=shards)
        return None if facts is None else state_rows(facts, self.spec)

    def last_batch(self, spark: SparkSession) -> int | None:
        stored = _stored(spark, f"{self.path}/positions", f"{POSITIONS}, batch_id int")
        return None if stored is None else stored.agg(F.max("batch_id")).first()[0]

    def positions(self, spark: SparkSession) -> DataFrame | None:
        """Newest applied position per source."""
        last = self.last_batch(spark)
        return None if last is None else spark.read.parquet(self._at("positions", last))

    def rejects(self, spark: SparkSession) -> DataFrame | None:
        return _stored(spark, f"{self.path}/rejects")

    def _forgotten(self, spark: SparkSession) -> DataFrame | None:
        stored = _stored(spark, f"{self.path}/forgotten", POSITIONS)
        return None if stored is None else last_position(stored)

    def compact(self, spark: SparkSession, forget: DataFrame | None = None) -> int | None:
        """Fold everything so far into a new base.

        Removed keys stay as facts, so that late changes still fit. ``forget`` (source, log_file, log_pos)
        drops those that were last touched at or before a position no late change will come from.
        """
        upto = self.last_batch(spark)
        if upto is None or upto == self._base(spark)[0]:
            return None
        facts = self.facts(spark, upto)
        if forget is not None:
            here = position(F.col("log_file"), F.col("log_pos")).alias("_passed")
            if self.spec.source:
                passed = broadcast_if_small(forget.select(F.col("source").alias(self.spec.source), here))
                facts = forget_absent(facts.join(passed, self.spec.source, "left"), F.col("_passed")).drop("_passed")
            else:
                facts = forget_absent(facts, forget.select(here).scalar())
            forget.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/forgotten/upto={upto}")
        self._store_base(facts, upto)
        return upto

    def vacuum(self, spark: SparkSession) -> int:
        """Remove what the newest base has made obsolete; returns how many folders went.

        Not to be run while somebody reads an older base. Rejects stay, as nobody else keeps them.
        """
        upto, _ = self._base(spark)
        last = self.last_batch(spark)
        keep = upto if last is None else min(upto, last - 1)
        old = [("delta", "batch_id", upto), ("base", "upto", upto - 1), ("compactions", "upto", upto - 1)]
        # The next batch, or the repetition of the last one, builds on the one before.
        old += [(part, "batch_id", keep - 1) for part in ("positions", "rotations", "held", "sent")]
        # Released facts are in the base; those of the last batches may not have been sent to databases yet.
        old.append(("released", "batch_id", keep - 2))
        context = spark.sparkContext
        removed = 0
        for part, name, end in old:
            folder = context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{part}")
            files = folder.getFileSystem(context._jsc.hadoopConfiguration())
            for status in files.listStatus(folder) if files.exists(folder) else []:
                key, _, number = status.getPath().getName().partition("=")
                if key == name and int(number) <= end:
                    files.delete(status.getPath(), True)
                    removed += 1
        return removed


def stream_to_databases(
    events: DataFrame,
    spec: TableSpec,
    connect: Connect,
    checkpoint: str,
    every: str | None = "2 seconds",
    paused: Gate | None = None,
    pause_seconds: float = 1.0,
    rotating: bool = False,
    rejects: Rejects = None,
    state: StreamApply | None = None,
    **options,
) -> StreamingQuery:
    """Continuous apply to shard databases.

    The fold of all keys is kept in the state store (``FoldedDatabases``), so a batch meets the state of its own keys only. So late
    files and repeated batches never put older rows over newer ones.

    Logs that are ``rotating``, which name their file by rotations only, and a ``state`` that is seeded, compacted or
    holds shards back keep the facts as files instead: a batch is folded with what is known of its keys there, and only keys
    whose fold has moved forward, or was released meanwhile, are written. Events that cannot be routed, also those
    without a known file, go to ``rejects``, or fail the batch.
    """
    if state is None and not rotating:
        folded = FoldedDatabases(spec, connect, checkpoint, paused, pause_seconds, rejects=rejects, **options)
        return folded.start(events, every)
    kept = state or StreamApply(spec, f"{checkpoint.rstrip('/')}-state", rotating=rotating)

    def process(batch: DataFrame, batch_id: int) -> None:
        wait_while(paused, pause_seconds)
        spark = batch.sparkSession
        kept.process(batch, batch_id)
        refused = _stored(spark, kept._at("rejects", batch_id))
        if refused is not None:
            if rejects is None:
                raise ValueError(f"batch {batch_id} has changes that cannot be routed, see {kept._at('rejects', batch_id)}")
            hand_over(refused, rejects, batch_id)
        calls = kept.release_calls(spark)
        write_operations(kept.moved(spark, batch_id), spec, connect, **options)
        if calls:
            kept.mark_sent(spark, batch_id, calls)
        kept.tidy(spark, batch_id)

    return start_batches(events, process, checkpoint, every)


def stop_between_batches(query: StreamingQuery, wait_seconds: float = 6.0) -> None:
    """Let a running batch finish, up to a limit, then stop. A cut batch is repeated on restart."""
    end = time.monotonic() + wait_seconds
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < end:
        time.sleep(0.1)
    query.stop()


def lag_gate(read_lag: Callable[[], DataFrame]) -> Gate:
    """Paused while the latest lag table has a paused host."""
    return lambda: not read_lag().where("paused").isEmpty()
