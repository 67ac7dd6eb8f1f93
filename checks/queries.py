"""One query per operator, each over whole tables."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from reshard.functions import events as ev
from reshard.functions import hashing as hs
from reshard.functions import positions as ps
from reshard.functions import values as vl
from reshard.operators import audit, changes, folding, intervals, lag, loading, reports, routing
from reshard.plans import log_apply
from reshard.plans.batch_load import load_rows
from reshard.plans.log_apply import apply_log, single_key_operations, typed_changes
from reshard.session import broadcast_if_small, new_folder
from reshard.sinks import files
from reshard.sources import changelog, directory, position_log, snapshot
from reshard.streaming.apply import StreamApply
from reshard.streaming.state_fold import StateFold
from reshard.streaming.files import start_batches
from reshard.streaming.listeners import Listener, listen_each, listener_counts, listener_positions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LISTENERS = [
    Listener("likes", "shard_*", "user_recording_like"),
    Listener("comments", "*", "Comment"),
    Listener("archive", "archive", "*"),
    Listener("everything", "*", "*"),
]


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return fx.build(spark, sf, fx.SNAPSHOT)


def _changes(spark: SparkSession, sf: str) -> DataFrame:
    return fx.build(spark, sf, fx.CHANGES)


def _keys(spark: SparkSession, sf: str) -> DataFrame:
    return fx.keys(spark, sf)


def _positions(spark: SparkSession, sf: str) -> DataFrame:
    return fx.build(spark, sf, fx.POSITIONS)


def _starts(spark: SparkSession, sf: str) -> DataFrame:
    return _positions(spark, sf).select("source", ps.position(F.col("log_file"), F.col("log_pos")).alias("start"))


def _typed(spark: SparkSession, sf: str) -> DataFrame:
    return changes.accepted(typed_changes(fx.row_events(spark, sf), fx.LOGGED_LIKES))


def _operations(spark: SparkSession, sf: str) -> DataFrame:
    return single_key_operations(fx.row_events(spark, sf), fx.LOGGED_LIKES)


def _directory(spark: SparkSession, sf: str) -> DataFrame:
    return directory.shard_map(fx.build(spark, sf, fx.DIRECTORY_ENTRIES), "entry_no").drop("error")


def _flat(operations: DataFrame) -> DataFrame:
    return operations.select(
        "source", "pos.log_file", "pos.log_pos", "pos.row_idx", "pos.sub", "op", "shard", "user_id", "recording_id",
        F.col("vals.user_id").alias("new_user_id"), F.col("vals.created_on").alias("created_on"),
    )


# Sources


@query
def snapshot_keyset_scan(spark: SparkSession, sf: str) -> DataFrame:
    return snapshot.keyset_page(_snapshot(spark, sf), 100).drop("source")


@query
def snapshot_chunk_plan(spark: SparkSession, sf: str) -> DataFrame:
    return snapshot.chunk_plan(_snapshot(spark, sf), 2000)


@query
def snapshot_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Ranges of equal row counts per source, of ids with large holes, with the predicates that read them."""
    return snapshot.snapshot_ranges(fx.build(spark, sf, fx.SPARSE), 100, by=("source",))


@query
def changelog_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Land the log as files, read it back with its schema, and expand it."""
    path = new_folder(spark, "changelog")
    fx.row_events(spark, sf).write.parquet(path)
    events = changelog.read_changelog(spark, path)
    rows = changes.accepted(changes.project_changes(changes.expand_row_images(events), fx.LOGGED_LIKES))
    return rows.select(
        "source", "log_file", "log_pos", "row_idx", "database_name", "table_name", "dml",
        F.col("before.user_id").alias("user_id"), F.col("after.user_id").alias("new_user_id"),
        F.coalesce("after.created_on", "before.created_on").alias("created_on"),
    )


@query
def resume_from_position(spark: SparkSession, sf: str) -> DataFrame:
    log = fx.build(spark, sf, fx.FOUR_SOURCES)
    middle = log.where(2 * F.col("seq") <= log.agg(F.max("seq")).scalar())
    early = log.where(4 * F.col("seq") <= log.agg(F.max("seq")).scalar())
    explicit = reports.last_position(early).where(F.col("source").isin("db-0", "db-1"))
    saved = reports.last_position(middle).where(F.col("source").isin("db-1", "db-2"))
    return changelog.resume(log, explicit, saved)


@query
def shard_map(spark: SparkSession, sf: str) -> DataFrame:
    return directory.shard_map(fx.build(spark, sf, fx.MIXED_ENTRIES), "entry_no")


# Key hashing


@query
def hash_value_int(spark: SparkSession, sf: str) -> DataFrame:
    return _keys(spark, sf).select("id", hs.hash_int(F.col("k_int")).alias("h"), hs.hash_int(F.col("k_neg")).alias("h_neg"))


@query
def hash_value_string(spark: SparkSession, sf: str) -> DataFrame:
    return _keys(spark, sf).select(
        "id", hs.hash_string(F.col("k_num")).alias("h_num"), hs.hash_string(F.col("k_txt")).alias("h_txt")
    )


@query
def hash_value_bytes(spark: SparkSession, sf: str) -> DataFrame:
    return _keys(spark, sf).select(
        "id",
        hs.hash_bytes(F.col("k_num").cast("binary")).alias("h_num"),
        hs.hash_bytes(F.col("k_txt").cast("binary")).alias("h_txt"),
    )


@query
def shard_slot(spark: SparkSession, sf: str) -> DataFrame:
    return _keys(spark, sf).select(
        "id", hs.shard_slot(F.col("k_int")).alias("slot"), hs.shard_slot(F.col("k_neg")).alias("slot_neg")
    )


@query
def shard_index(spark: SparkSession, sf: str) -> DataFrame:
    return _keys(spark, sf).select(
        "id", hs.shard_index(F.col("k_int"), 32).alias("shard"), hs.shard_index(F.col("k_neg"), 32).alias("shard_neg")
    )


@query
def shard_table_index(spark: SparkSession, sf: str) -> DataFrame:
    return _keys(spark, sf).select(
        "id",
        hs.shard_index(F.col("k_int"), 32, 10).alias("table_index"),
        hs.shard_index(F.col("k_neg"), 32, 10).alias("table_index_neg"),
    )


@query
def shard_to_database(spark: SparkSession, sf: str) -> DataFrame:
    index = hs.shard_index(F.col("k_int"), 32, 10)
    placed = _keys(spark, sf).select("id", index.alias("shard"))
    return placed.select(
        "id", "shard", hs.database_index(F.col("shard"), 10).alias("db_index"), hs.database_alias(F.col("shard"), 10).alias("alias")
    )


# Projections and filters


@query
def classify_dml(spark: SparkSession, sf: str) -> DataFrame:
    return fx.build(spark, sf, fx.STATEMENTS).select("id", "description", ev.classify_dml(F.col("description")).alias("dml"))


@query
def expand_row_images(spark: SparkSession, sf: str) -> DataFrame:
    rows = changes.accepted(changes.expand_row_images(fx.row_events(spark, sf)))
    return rows.select(
        "source", "log_file", "log_pos", "row_idx", "dml",
        F.col("before")[2].alias("user_id"), F.col("after")[2].alias("new_user_id"),
        F.coalesce(F.col("after")[0], F.col("before")[0]).alias("seq"),
    )


@query
def table_pattern_filter(spark: SparkSession, sf: str) -> DataFrame:
    return changes.match_tables(_changes(spark, sf), fx.LIKES).select("seq", "source", "database_name", "table_name")


@query
def skip_applied_events(spark: SparkSession, sf: str) -> DataFrame:
    return changes.skip_applied(_changes(spark, sf), _positions(spark, sf)).select("source", "seq", "log_file", "log_pos", "row_idx")


@query
def shard_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = routing.route_snapshot(_snapshot(spark, sf), fx.ALL_LIKES)
    return routing.keep_shards(rows, fx.LIKES).select("id", "shard")


@query
def project_row_image(spark: SparkSession, sf: str) -> DataFrame:
    events = fx.row_events(spark, sf, "string")
    rows = changes.accepted(changes.project_changes(changes.expand_row_images(events), fx.LOGGED_LIKES))
    image = F.coalesce("after", "before")
    return rows.select("source", "log_file", "log_pos", "row_idx", *[image.getField(n).alias(n) for n in fx.LIKES.names])


@query
def unsigned_reinterpret(spark: SparkSession, sf: str) -> DataFrame:
    rows = _keys(spark, sf)
    narrow = {bits: (F.col("id") % 2 ** bits - 2 ** (bits - 1)) for bits in (8, 16, 24, 32)}
    return rows.select(
        "id",
        vl.unsigned_value(narrow[8].cast("tinyint"), 8).alias("u8"),
        vl.unsigned_value(narrow[16].cast("smallint"), 16).alias("u16"),
        vl.unsigned_value(narrow[24].cast("int"), 24).alias("u24"),
        vl.unsigned_value(narrow[32].cast("int"), 32).alias("u32"),
        vl.unsigned_text(F.col("k_neg")).alias("u64"),
    )


@query
def latin1_decode(spark: SparkSession, sf: str) -> DataFrame:
    ids = _keys(spark, sf).select("id")
    byte = F.lpad(F.hex(F.col("id") % 255 + 1), 2, "0")
    return ids.select("id", vl.latin1_text(F.unhex(F.concat(F.lit("41"), byte, byte))).alias("text"))


@query
def row_image_text(spark: SparkSession, sf: str) -> DataFrame:
    image = F.array("seq", F.when(F.col("g") % 3 != 0, F.col("created_on")), "user_id", "recording_id")
    return _changes(spark, sf).select("seq", vl.image_text(image).alias("image"))


# Routing


@query
def route_changes(spark: SparkSession, sf: str) -> DataFrame:
    return _flat(routing.route_changes(_typed(spark, sf), fx.LOGGED_LIKES))


@query
def route_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return routing.route_snapshot(_snapshot(spark, sf), fx.LIKES).drop("source")


@query
def split_key_moves(spark: SparkSession, sf: str) -> DataFrame:
    return _flat(_operations(spark, sf))


@query
def split_same_shard_only(spark: SparkSession, sf: str) -> DataFrame:
    """Key moves to another shard are left out."""
    return _flat(routing.split_key_moves(_typed(spark, sf), fx.STAYING_LIKES))


@query
def key_move_audit(spark: SparkSession, sf: str) -> DataFrame:
    return routing.key_move_audit(_typed(spark, sf), fx.LOGGED_LIKES)


# Loading


@query
def insert_ignore(spark: SparkSession, sf: str) -> DataFrame:
    return load_rows(_snapshot(spark, sf), fx.LIKES)


@query
def load_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Rows without a complete key are handed over, the others loaded."""
    refused: list[DataFrame] = []
    rows = _snapshot(spark, sf).withColumn("recording_id", F.when(F.col("id") % 19 != 7, F.col("recording_id")))
    loaded = load_rows(rows, fx.LIKES, rejects=refused.append)
    wanted = ["user_id", "recording_id", "created_on"]
    kept = loaded.select(F.lit("loaded").alias("outcome"), *wanted)
    return kept.unionByName(refused[0].select(F.lit("rejected").alias("outcome"), *wanted))


@query
def insert_ignore_existing(spark: SparkSession, sf: str) -> DataFrame:
    """Load into shards that the log has already filled in part."""
    facts = folding.change_facts(_operations(spark, sf), fx.LOGGED_LIKES)
    return load_rows(_snapshot(spark, sf), fx.LOGGED_LIKES, folding.state_rows(facts, fx.LOGGED_LIKES))


@query
def reorder_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return loading.number_in_shard(load_rows(_snapshot(spark, sf), fx.LIKES), fx.LIKES)


@query
def write_shards(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "shards")
    files.write_shards(load_rows(_snapshot(spark, sf), fx.LIKES), fx.LIKES, path)
    return files.read_shards(spark, path)


@query
def load_batches(spark: SparkSession, sf: str) -> DataFrame:
    return loading.load_batches(load_rows(_snapshot(spark, sf), fx.LIKES), 50)


@query
def dry_run_preview(spark: SparkSession, sf: str) -> DataFrame:
    first = loading.first_of_batches(load_rows(_snapshot(spark, sf), fx.LIKES), fx.LIKES, 50)
    shown = reports.render_statements(reports.snapshot_operations(first, fx.LIKES), fx.LIKES)
    return shown.select("shard", "batch_no", "sql", "args")


@query
def dry_run_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The same preview for the log, whose operations come in log order, here for one source after the other."""
    ordered = _operations(spark, sf).withColumn("place", F.struct("source", "pos"))
    first = loading.first_of_batches(ordered, fx.LOGGED_LIKES, 20, ("place",))
    return reports.render_statements(first, fx.LOGGED_LIKES).select("shard", "batch_no", "op", "args")


@query
def render_statements(spark: SparkSession, sf: str) -> DataFrame:
    routed = reports.render_statements(routing.route_changes(_typed(spark, sf), fx.LOGGED_LIKES), fx.LOGGED_LIKES)
    return routed.select("source", "pos.log_file", "pos.log_pos", "pos.row_idx", "shard", "rendered")


@query
def shard_placement(spark: SparkSession, sf: str) -> DataFrame:
    rows = routing.with_database(load_rows(_snapshot(spark, sf), fx.LIKES), _directory(spark, sf), fx.LIKES)
    return rows.groupBy("host", "port", "db").agg(F.count("*").alias("rows"))


@query
def shard_counts(spark: SparkSession, sf: str) -> DataFrame:
    return reports.shard_counts(routing.route_snapshot(_snapshot(spark, sf), fx.LIKES), fx.LIKES)


@query
def rows_processed(spark: SparkSession, sf: str) -> DataFrame:
    return reports.rows_processed(snapshot.chunk_plan(_snapshot(spark, sf), 200, by=("source",)), partitions=5)


# Applying the log


@query
def compact_changes(spark: SparkSession, sf: str) -> DataFrame:
    net = folding.compact_changes(_operations(spark, sf), fx.LOGGED_LIKES)
    return net.select(
        "source", "shard", "user_id", "recording_id", "op", F.col("vals.created_on").alias("created_on"),
        "pos.log_file", "pos.log_pos", "pos.row_idx", "pos.sub",
    )


@query
def apply_changes(spark: SparkSession, sf: str) -> DataFrame:
    target = load_rows(_snapshot(spark, sf), fx.LOGGED_LIKES)
    return apply_log(target, fx.row_events(spark, sf), fx.LOGGED_LIKES)


@query
def bootstrap_state(spark: SparkSession, sf: str) -> DataFrame:
    return log_apply.bootstrap_state(_snapshot(spark, sf), fx.row_events(spark, sf), _starts(spark, sf), fx.LOGGED_LIKES)


@query
def bootstrap_partial_starts(spark: SparkSession, sf: str) -> DataFrame:
    """One source has no saved start: its log is applied from the beginning."""
    starts = _starts(spark, sf).where("source = 'db-a'")
    return log_apply.bootstrap_state(_snapshot(spark, sf), fx.row_events(spark, sf), starts, fx.LOGGED_LIKES)


@query
def bootstrap_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """The table read in three chunks while its log goes on, each with a mark from before it was read."""
    table, log = load_rows(_snapshot(spark, sf), fx.LOGGED_LIKES), fx.row_events(spark, sf)
    end = log.agg(F.max("seq")).scalar()
    chunk = (F.col("recording_id") % 3).alias("chunk")
    read, marks = [], []
    for number, (low, seen) in enumerate(((5, 5), (1, 3), (2, 7))):  # eighths of the log; the chunks are not read in order
        marks.append(reports.last_position(log.where(8 * F.col("seq") <= low * end)).select(
            F.lit(number).cast("bigint").alias("chunk"), "source", ps.position(F.col("log_file"), F.col("log_pos")).alias("low")
        ))
        rows = apply_log(table, log.where(8 * F.col("seq") <= seen * end), fx.LOGGED_LIKES)
        read.append(rows.select("*", chunk).where(F.col("chunk") == number).drop("shard"))
    chunks, lows = read[0].unionByName(read[1]).unionByName(read[2]), marks[0].unionByName(marks[1]).unionByName(marks[2])
    return log_apply.bootstrap_chunks(chunks, lows, log.where(8 * F.col("seq") > end), fx.LOGGED_LIKES)


@query
def apply_changes_one_shard(spark: SparkSession, sf: str) -> DataFrame:
    """Apply the log to one shard folder only."""
    path = new_folder(spark, "shards")
    files.write_shards(load_rows(_snapshot(spark, sf), fx.LOGGED_LIKES), fx.LOGGED_LIKES, path)
    return apply_log(files.read_shards(spark, path), fx.row_events(spark, sf), fx.LOGGED_LIKES, shards=[3])


@query
def apply_progress(spark: SparkSession, sf: str) -> DataFrame:
    return reports.apply_progress(_operations(spark, sf), _positions(spark, sf))


@query
def last_applied_position(spark: SparkSession, sf: str) -> DataFrame:
    return reports.last_position(_changes(spark, sf))


@query
def rejects(spark: SparkSession, sf: str) -> DataFrame:
    return changes.count_rejects(typed_changes(fx.faulty_events(spark, sf), fx.LOGGED_LIKES))


# Positions


@query
def assign_log_file(spark: SparkSession, sf: str) -> DataFrame:
    return changes.assign_log_file(fx.build(spark, sf, fx.RAW)).select("source", "seq", "event_name", "log_pos", "log_file")


@query
def assign_log_file_far(spark: SparkSession, sf: str) -> DataFrame:
    """The same for a log in which some events, also rotations, are numbered far behind the others."""
    return changes.assign_log_file(fx.build(spark, sf, fx.RAW_FAR)).select("source", "seq", "event_name", "log_pos", "log_file")


def _applied(spark: SparkSession, sf: str) -> DataFrame:
    columns = [F.col(c) for c in ("source", "after_file", "after_pos", "upto_file", "upto_pos")]
    return fx.build(spark, sf, fx.APPLIED_RUNS).select(*intervals.read_range(*columns))


def _borders(ranges: DataFrame) -> DataFrame:
    ends = [F.col(f"{end}.{part}").alias(f"{end}_{part}") for end in ("after", "upto") for part in ("log_file", "log_pos")]
    return ranges.select("source", *ends)


@query
def applied_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """What of the log was applied, merged from two halves that were merged before."""
    runs = _applied(spark, sf)
    odd = F.xxhash64("after") % 2 == 0
    halves = [intervals.merge_ranges(runs.where(half), partitions=3) for half in (odd, ~odd)]
    return _borders(intervals.merge_ranges(halves[0].unionByName(halves[1]), partitions=5))


@query
def missing_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """What of the log was left out."""
    return _borders(intervals.gaps(intervals.merge_ranges(_applied(spark, sf)), partitions=3))


@query
def skip_applied_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Changes that are still to be applied, late ones included."""
    left = intervals.skip_ranges(_changes(spark, sf), intervals.merge_ranges(_applied(spark, sf)))
    return left.select("source", "seq", "log_file", "log_pos", "row_idx")


@query
def log_gap_audit(spark: SparkSession, sf: str) -> DataFrame:
    return audit.log_gap_audit(fx.build(spark, sf, fx.AUDITED))


@query
def distinct_positions(spark: SparkSession, sf: str) -> DataFrame:
    return changes.distinct_positions(_changes(spark, sf))


@query
def replay_dedup(spark: SparkSession, sf: str) -> DataFrame:
    log = _changes(spark, sf)
    newest = reports.last_position(log).select("source", F.col("log_file").alias("_newest"))
    replayed = log.join(broadcast_if_small(newest), "source").where(F.col("log_file") == F.col("_newest")).drop("_newest")
    wanted = ["source", "log_file", "log_pos", "row_idx", "seq"]
    return changes.drop_replayed(log.select(wanted).unionByName(replayed.select(wanted)))


# Lag


@query
def replica_lag(spark: SparkSession, sf: str) -> DataFrame:
    return lag.replica_lag(fx.build(spark, sf, fx.HEARTBEATS))


@query
def pause_transitions(spark: SparkSession, sf: str) -> DataFrame:
    return lag.pause_transitions(fx.build(spark, sf, fx.HEARTBEATS), partitions=7)


@query
def replication_status(spark: SparkSession, sf: str) -> DataFrame:
    beats = fx.build(spark, sf, fx.HEARTBEATS)
    behind = F.when(F.col("seq") % 5 != 0, F.floor(lag.lag_ns(beats) / 1e9).cast("bigint"))
    return lag.replication_status(beats.select("host", "seq", behind.alias("seconds_behind")))


@query
def throttle_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = load_rows(_snapshot(spark, sf), fx.LIKES)
    latest = lag.replica_lag(fx.build(spark, sf, fx.HEARTBEATS))
    marked = lag.throttle_split(rows, _directory(spark, sf), latest, fx.LIKES)
    return marked.select("shard", "user_id", "recording_id", "host", "held")


@query
def throttle_asof(spark: SparkSession, sf: str) -> DataFrame:
    """Operations that were due while the host of their shard was paused, by their place in the log as time."""
    event = (ps.file_number(F.col("pos.log_file")) - 17) * 1000 + F.floor((F.col("pos.log_pos") - 120) / 73)
    timed = _operations(spark, sf).withColumn("at_ns", F.lit(1_700_000_000_250_000_000) + event * 500_000_000)
    beats = fx.build(spark, sf, fx.HEARTBEATS)
    marked = lag.throttle_as_of(timed, _directory(spark, sf), beats, fx.LOGGED_LIKES, "at_ns", partitions=5)
    return marked.select("source", "pos.log_file", "pos.log_pos", "pos.row_idx", "pos.sub", "shard", "host", "held")


# Streaming


def _land_log(spark: SparkSession, sf: str) -> tuple[str, int]:
    """Write the log as files, to be read in about four micro-batches; returns files per trigger."""
    parts = max(4, spark.sparkContext.defaultParallelism)
    path = new_folder(spark, "landed")
    fx.row_events(spark, sf).repartitionByRange(parts, "seq").write.parquet(path)
    return path, math.ceil(parts / 4)


def _streamed(spark: SparkSession, sf: str) -> StreamApply:
    path, per_trigger = _land_log(spark, sf)
    apply = StreamApply(fx.LOGGED_LIKES, new_folder(spark, "state"))
    apply.start(changelog.stream_changelog(spark, path, files_per_trigger=per_trigger), every=None).awaitTermination()
    return apply


@query
def stream_apply(spark: SparkSession, sf: str) -> DataFrame:
    return _streamed(spark, sf).current(spark)


def _state_fold(spark: SparkSession, sf: str, handle: Callable[[DataFrame, int], None]) -> StateFold:
    path, per_trigger = _land_log(spark, sf)
    fold = StateFold(fx.LOGGED_LIKES, new_folder(spark, "fold"))
    events = changelog.stream_changelog(spark, path, files_per_trigger=per_trigger)
    fold.start(events, handle, every=None).awaitTermination()
    return fold


@query
def stream_fold_state(spark: SparkSession, sf: str) -> DataFrame:
    """Rows as the state store has them after a stream."""
    return _state_fold(spark, sf, lambda facts, batch_id: facts.write.format("noop").mode("overwrite").save()).current(spark)


@query
def stream_fold_output(spark: SparkSession, sf: str) -> DataFrame:
    """What such a stream hands on: the last operation of each key is the net effect of the whole log."""
    path = new_folder(spark, "operations")

    def keep(facts: DataFrame, batch_id: int) -> None:
        folding.net_operation(facts, fx.LOGGED_LIKES).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    _state_fold(spark, sf, keep)
    told = spark.read.parquet(path)
    last = told.groupBy(*fx.LOGGED_LIKES.identity).agg(F.max_by(F.struct("op", "vals", "pos"), "batch_id").alias("last"))
    return last.select(
        "source", "shard", "user_id", "recording_id", "last.op", F.col("last.vals.created_on").alias("created_on"),
        "last.pos.log_file", "last.pos.log_pos", "last.pos.row_idx", "last.pos.sub",
    )


@query
def stream_resume(spark: SparkSession, sf: str) -> DataFrame:
    """Half of the log, a stop, the other half, and another run on the same state."""
    log, path, state = fx.row_events(spark, sf), new_folder(spark, "landed"), new_folder(spark, "state")
    late = F.col("seq") > log.agg((F.min("seq") + F.max("seq")) / 2).scalar()
    for part in (log.where(~late), log.where(late)):
        part.write.mode("append").parquet(path)
        apply = StreamApply(fx.LOGGED_LIKES, state)
        apply.start(changelog.stream_changelog(spark, path), every=None).awaitTermination()
    return apply.positions(spark)


@query
def stream_rotating(spark: SparkSession, sf: str) -> DataFrame:
    """A log that names its files by rotations, landed in four parts, one of them late."""
    log, path = fx.rotating_events(spark, sf), new_folder(spark, "landed")
    for part in (0, 2, 3, 1):
        log.where(F.col("part") == part).drop("part").write.mode("append").parquet(path)
    apply = StreamApply(fx.LOGGED_LIKES, new_folder(spark, "state"), rotating=True)
    per_trigger = max(1, spark.sparkContext.defaultParallelism)
    apply.start(changelog.stream_changelog(spark, path, files_per_trigger=per_trigger), every=None).awaitTermination()
    return apply.current(spark)


def _throttled(spark: SparkSession, sf: str) -> StreamApply:
    latest = lag.replica_lag(fx.build(spark, sf, fx.HEARTBEATS))
    places = _directory(spark, sf)

    def hold(facts: DataFrame) -> DataFrame:
        return lag.throttle_split(facts, places, latest, fx.LOGGED_LIKES)

    path, per_trigger = _land_log(spark, sf)
    apply = StreamApply(fx.LOGGED_LIKES, new_folder(spark, "state"), hold=hold)
    apply.start(changelog.stream_changelog(spark, path, files_per_trigger=per_trigger), every=None).awaitTermination()
    return apply


@query
def throttled_apply(spark: SparkSession, sf: str) -> DataFrame:
    """Rows after a run in which changes for hosts that are behind were held."""
    return _throttled(spark, sf).current(spark)


@query
def throttled_release(spark: SparkSession, sf: str) -> DataFrame:
    """The same after the hosts have caught up."""
    apply = _throttled(spark, sf)
    apply.hold = None
    apply.release(spark)
    return apply.current(spark)


@query
def stream_replay_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """A log whose newest files are read again in the middle of the stream and at its end."""
    log, path, out = _changes(spark, sf).select("source", "log_file", "log_pos", "row_idx", "seq"), new_folder(spark, "landed"), new_folder(spark, "once")
    end = log.agg(F.max("seq")).scalar()
    first, rest = log.where(2 * F.col("seq") <= end), log.where(2 * F.col("seq") > end)
    for part in (first, first.where(4 * F.col("seq") > end), rest, log.where(8 * F.col("seq") > 7 * end)):
        part.coalesce(2).write.mode("append").parquet(path)
    landed = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 2).parquet(path)

    def keep(part: DataFrame, batch_id: int) -> None:
        part.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    start_batches(changes.drop_replayed_stream(landed), keep, new_folder(spark, "checkpoint"), None).awaitTermination()
    return spark.read.parquet(out).drop("batch_id")


@query
def stream_from_position(spark: SparkSession, sf: str) -> DataFrame:
    """A stream that is given a position in the middle of a file for one source; the other starts at its end, from which more comes."""
    log, path, out = fx.row_events(spark, sf), new_folder(spark, "landed"), new_folder(spark, "read")
    end = log.agg(F.max("seq")).scalar()
    position_log.land_changelog(log.where(2 * F.col("seq") <= end), path)
    given = reports.last_position(log.where(4 * F.col("seq") <= end)).where("source = 'db-a'").first()
    start = {"db-a": (given["log_file"], given["log_pos"])}
    checkpoint = new_folder(spark, "checkpoint")

    def keep(part: DataFrame, batch_id: int) -> None:
        part.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    for _ in range(2):  # the second run goes on where the first one stopped
        start_batches(position_log.stream_positions(spark, path, start), keep, checkpoint, None).awaitTermination()
        position_log.land_changelog(log.where(2 * F.col("seq") > end), path)
    return spark.read.parquet(out).select("source", "seq", "log_file", "log_pos", F.size("rows").alias("images"))


@query
def listener_progress(spark: SparkSession, sf: str) -> DataFrame:
    """How far each of several listeners has come that keep their own place in the log."""
    path, per_trigger = _land_log(spark, sf)
    told = [replace(one, handler=lambda part, batch_id: part.write.format("noop").mode("overwrite").save()) for one in LISTENERS]
    checkpoint = new_folder(spark, "listeners")
    for running in listen_each(changelog.stream_changelog(spark, path, files_per_trigger=per_trigger), told, checkpoint, every=None).values():
        running.awaitTermination()
    return listener_positions(spark, told, checkpoint)


@query
def listener_fanout(spark: SparkSession, sf: str) -> DataFrame:
    return listener_counts(_changes(spark, sf), LISTENERS)
