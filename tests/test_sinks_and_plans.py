import glob
import json
import os
import re
from dataclasses import replace

import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from checks import fixtures as fx
from helpers import ITEMS, Recorder, events_frame, operations_frame, random_operations, recorded, rows_of, sequential
from reshard.operators import loading, reports, routing
from reshard.operators.folding import apply_changes, compact_changes
from reshard.plans.batch_load import batch_load, load_databases, load_rows
from reshard.functions.positions import position
from reshard.plans.log_apply import apply_log, apply_log_to_shards, bootstrap_state, touched_shards
from reshard.sinks.database import write_operations
from reshard.sinks.files import read_shards, save_bucketed, write_shards
from reshard.sources import directory, snapshot
from reshard.sources.changelog import event_schema, stream_changelog
from reshard.spec import ColumnSpec, TableSpec
from reshard.streaming.apply import StreamApply, stream_to_databases


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_shard_files_are_sorted(spark, sf, tmp_path):
    path = str(tmp_path / "shards")
    rows = fx.build(spark, sf, fx.SNAPSHOT)
    batch_load(rows, fx.LIKES, path)
    assert os.path.isdir(f"{path}/shard=4") and not os.path.exists(f"{path}/shard=5")
    for name in glob.glob(f"{path}/shard=*/*.parquet"):
        keys = [(r["user_id"], r["recording_id"]) for r in pq.ParquetFile(name).read().to_pylist()]
        assert keys == sorted(keys)
    back = read_shards(spark, path)
    assert rows_of(back, "shard", "user_id", "recording_id", "created_on") == rows_of(
        load_rows(rows, fx.LIKES), "shard", "user_id", "recording_id", "created_on"
    )
    assert "PartitionFilters: [isnotnull(shard" in plan_of(spark.read.parquet(path).where("shard = 3"))


def test_shard_folders_after_a_log(spark, tmp_path):
    operations, start = random_operations(22, 200, 30), {k: -k for k in range(0, 40, 3)}
    rows = spark.createDataFrame([(0, k, v) for k, v in start.items()], "shard int, k bigint, v int")
    write_shards(rows, ITEMS, f"{tmp_path}/v0")
    apply_log_to_shards(f"{tmp_path}/v0", events_frame(spark, operations[:90]), ITEMS, f"{tmp_path}/v1")
    apply_log_to_shards(f"{tmp_path}/v1", events_frame(spark, operations[90:]), ITEMS, f"{tmp_path}/v2")
    assert rows_of(read_shards(spark, f"{tmp_path}/v2"), "k", "v") == sequential(operations, start)
    assert rows_of(read_shards(spark, f"{tmp_path}/v0"), "k", "v") == sorted(start.items())


def test_load_into_a_filled_target(spark, sf):
    rows = fx.build(spark, sf, fx.SNAPSHOT)
    loaded = load_rows(rows, fx.LIKES)
    assert load_rows(rows, fx.LIKES, loaded).count() == 0
    half = loaded.where("recording_id < 3")
    assert load_rows(rows, fx.LIKES, half).where("recording_id < 3").count() == 0


def test_rows_without_key_are_set_aside(spark):
    rows = spark.createDataFrame([(1, None, 5), (2, 7, 6)], "id bigint, k bigint, v int")
    refused = []
    assert rows_of(load_rows(rows, ITEMS, rejects=refused.append), "k", "v") == [(7, 6)]
    assert rows_of(refused[0], "id") == [(1,)]
    with pytest.raises(PySparkException, match="no complete key"):
        load_rows(rows, ITEMS).collect()


def test_refused_changes_come_out(spark, tmp_path):
    """Without somewhere to put them the job fails; a path stores them; nothing vanishes."""
    events = events_frame(spark, [("f", 1, 0, "I", 1, 5), ("f", 2, 0, "I", None, 6)])
    target = spark.createDataFrame([(0, 9, 9)], "shard int, k bigint, v int")
    with pytest.raises(PySparkException, match="null_key"):
        apply_log(target, events, ITEMS).collect()
    path = str(tmp_path / "rejects")
    assert rows_of(apply_log(target, events, ITEMS, rejects=path), "k", "v") == [(1, 5), (9, 9)]
    assert rows_of(spark.read.parquet(path), "reason") == [("null_key",)]
    lost = events.where("log_pos = 10").withColumn("log_file", F.lit(None).cast("string"))
    with pytest.raises(PySparkException, match="no_log_file"):
        apply_log(target, lost, ITEMS).collect()


def test_bootstrap_keeps_the_log_of_sources_without_a_start(spark):
    spec = replace(ITEMS, source="source")
    rows = spark.createDataFrame([("src", 1, 1, 1), ("new", 2, 1, 2)], "source string, id bigint, k bigint, v int")
    log = events_frame(spark, [("f", 1, 0, "U", 1, 5)])
    log = log.unionByName(log.withColumn("source", F.lit("new")))
    starts = spark.createDataFrame([("src",)], "source string").select("source", position(F.lit("f"), F.lit(99)).alias("start"))
    state = bootstrap_state(rows.where("source = 'new'"), log, starts, spec)
    assert rows_of(state, "source", "v") == [("new", 5)]


def test_only_wanted_shards_are_read(spark, tmp_path):
    far = [1, 2**48, 2 * 2**48]
    spec = replace(ITEMS, shard_num=4)
    rows = spark.createDataFrame([(i, k, 0) for i, k in enumerate(far)], "shard int, k bigint, v int")
    write_shards(rows, spec, str(tmp_path / "v0"))
    log = events_frame(spark, [("f", n, 0, "U", k, 7) for n, k in enumerate(far)])
    assert touched_shards(log.where("seq < 2"), spec) == [0, 1]
    changed = apply_log(read_shards(spark, str(tmp_path / "v0")), log, spec, shards=[1])
    assert rows_of(changed, "k", "v") == [(2**48, 7)]
    assert re.search(r"PartitionFilters: \[[^\]]*shard", plan_of(changed))
    apply_log_to_shards(str(tmp_path / "v0"), log, spec, str(tmp_path / "v1"), shards=[2])
    assert rows_of(spark.read.parquet(str(tmp_path / "v1")), "shard", "v") == [(2, 7)]


class Dying:
    """A connection whose first statement kills it; with ``sour`` the rollback fails as well."""

    def __init__(self, folder, shard, sour):
        self.folder, self.sour = folder, sour
        self.number = len(glob.glob(f"{folder}/opened-*"))
        open(f"{folder}/opened-{self.number}", "w").close()

    def cursor(self):
        return self

    def execute(self, sql, args):
        if self.number == 0:
            raise ConnectionError("gone")
        open(f"{self.folder}/done-{self.number}", "w").close()

    def commit(self):
        pass

    def rollback(self):
        if self.sour:
            raise ConnectionError("still gone")

    def close(self):
        open(f"{self.folder}/closed-{self.number}", "w").close()


@pytest.mark.parametrize("sour", [False, True])
def test_a_dead_connection_is_replaced(spark, tmp_path, sour):
    folder = str(tmp_path)
    operations = compact_changes(operations_frame(spark, [("f", 1, 0, "I", 1, 5)]), ITEMS)
    write_operations(operations, ITEMS, lambda shard: Dying(folder, shard, sour), wait_seconds=0, tasks=1)
    names = {os.path.basename(n) for n in glob.glob(f"{folder}/*")}
    assert names == {"opened-0", "closed-0", "opened-1", "done-1", "closed-1"}


def test_first_row_wins_with_text_values(spark):
    rows = spark.createDataFrame([(3, 7, "c"), (1, 7, None), (2, 8, "b")], "id bigint, k bigint, v string").withColumn("shard", F.lit(0))
    kept = loading.insert_ignore(rows, ITEMS).collect()
    assert sorted((r["k"], r["v"]) for r in kept) == [(7, None), (8, "b")]


def test_load_plan(spark, sf):
    plan = plan_of(load_rows(fx.build(spark, sf, fx.SNAPSHOT), fx.LIKES))
    assert plan.count("Exchange") == 1 and "SortAggregate" not in plan and "partial_min" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_filter_reaches_the_scan(spark, sf):
    plan = plan_of(snapshot.keyset_page(fx.build(spark, sf, fx.SNAPSHOT), 100))
    assert "GreaterThan(o_orderkey,100)" in plan and "TakeOrderedAndProject" in plan


def test_merge_shuffles_each_side_once(spark, sf):
    target = load_rows(fx.build(spark, sf, fx.SNAPSHOT), fx.LOGGED_LIKES)
    events = fx.row_events(spark, sf)
    whole = plan_of(apply_log(target, events, fx.LOGGED_LIKES))
    assert whole.count("Exchange") == plan_of(target).count("Exchange") + plan_of(events).count("Exchange") + 1


def test_bucketed_target_is_not_shuffled(spark):
    shard = routing.shard_of(F.col("k"), ITEMS)
    rows = spark.range(200).select(F.col("id").alias("k"), F.col("id").cast("int").alias("v")).withColumn("shard", shard)
    save_bucketed(rows, ITEMS, "kept_items", 8)
    changes = operations_frame(spark, [("f", 1, 0, "D", 5, 0), ("f", 2, 0, "I", 900, 1)]).withColumn("shard", shard)
    net = compact_changes(changes, ITEMS)
    merged = apply_changes(spark.table("kept_items"), net, ITEMS)
    plan = plan_of(merged)
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    assert merged.count() == 200 and merged.where("k = 5").count() == 0


def test_sub_tables_share_a_database(spark, sf):
    spec = fx._likes(location=4, replication=4, shard_filter=None)
    places = directory.shard_map(fx.build(spark, sf, fx.DIRECTORY_ENTRIES), "entry_no").drop("error")
    rows = routing.with_database(routing.route_snapshot(fx.build(spark, sf, fx.SNAPSHOT), spec), places, spec)
    assert rows.where(F.floor(F.col("shard") / 4) != F.regexp_extract("db", r"(\d+)$", 1).cast("int")).count() == 0
    assert rows.where("db IS NULL").count() == 0
    assert reports.shard_counts(rows, spec).count() == 128


def test_directory_entries(spark):
    entries = ["shard29:shard_29@host29", "# shard1:x@y", "shard1:a:b", "shard1:db1@h1@3307", "shard1:db2@h2", "bad:db", "odd:db@h@x"]
    frame = spark.createDataFrame(list(enumerate(entries)), "n int, entry string")
    found = directory.shard_map(frame, "n")
    assert rows_of(found.where("error is null"), "alias", "db", "host", "port") == [
        ("shard1", "db1", "h1", 3307), ("shard29", "shard_29", "host29", 3306)
    ]
    assert rows_of(found.where("error is not null"), "alias", "error") == [("bad", "no host"), ("odd", "bad port")]
    wanted = spark.createDataFrame([("shard29",)], "alias string")
    assert directory.lookup(found, wanted).first()["host"] == "host29"
    for alias in ("bad", "odd", "missing"):
        with pytest.raises(PySparkException):
            directory.lookup(found, spark.createDataFrame([(alias,)], "alias string")).collect()


def test_statements(spark):
    ops = [("f", 1, 0, "I", 1, 5), ("f", 2, 0, "U", 1, None), ("f", 3, 0, "D", 1, 0)]
    shown = reports.render_statements(operations_frame(spark, ops), ITEMS).orderBy("pos").collect()
    assert [r["rendered"] for r in shown] == [
        "replace into items (k, v) values (?, ?) --> [1,5]",
        "update items set k=?, v=? where k=? --> [1,null,1]",
        "delete from items where k=? --> [1]",
    ]
    assert reports.statement(routing.INSERT_IGNORE, ITEMS, 2) == "insert ignore into items (k, v) values (?, ?), (?, ?)"


def test_text_arguments_are_quoted(spark):
    from reshard.spec import ColumnSpec, TableSpec

    spec = TableSpec(table="t", columns=(ColumnSpec("k", 0), ColumnSpec("v", 1, "string")), key=("k",))
    rows = spark.createDataFrame([(1, 'a"],[b')], "k bigint, v string").select(
        "k", F.lit("I").alias("op"), F.struct("k", "v").alias("vals")
    )
    assert json.loads(reports.render_statements(rows, spec).first()["args"]) == [1, 'a"],[b']
    marked = rows.withColumn("vals", F.struct("k", F.lit("<a&b>\u2028").alias("v")))
    assert reports.render_statements(marked, spec).first()["args"] == r'[1,"\u003ca\u0026b\u003e\u2028"]'


def test_batches(spark):
    rows = spark.range(4001).select(F.when(F.col("id") < 4000, 0).otherwise(1).alias("shard"))
    for run in (1, 2, 10_000):
        batches = loading.load_batches(rows, 2000, run)
        assert rows_of(batches, "shard", "batch_no", "batch_rows") == [(0, 0, 2000), (0, 1, 2000), (1, 0, 1)]


def test_first_of_shards(spark, sf):
    rows = load_rows(fx.build(spark, sf, fx.SNAPSHOT), fx.LIKES)
    batches = loading.first_of_batches(rows, fx.LIKES, 10**9)
    names = ["shard", "user_id", "recording_id", "created_on"]
    assert rows_of(batches, *names) == rows_of(loading.first_of_shards(rows, fx.LIKES), *names)


def test_database_sink(spark, sf, tmp_path):
    folder = str(tmp_path)
    rows = load_rows(fx.build(spark, sf, fx.SNAPSHOT), fx.LIKES)
    snapshot_rows = fx.build(spark, sf, fx.SNAPSHOT)
    load_databases(snapshot_rows, fx.LIKES, lambda shard: Recorder(folder, shard), batch_rows=7, wait_seconds=0)
    batches, written = recorded(folder), []
    for shard, batch in batches:
        (sql, args), = batch
        size = len(args) // 3
        assert size <= 7 and sql.count("(?, ?, ?)") == size and sql.startswith("insert ignore into ")
        found = [tuple(args[i : i + 3]) for i in range(0, len(args), 3)]
        assert found == sorted(found)
        written += [(shard, *row) for row in found]
    assert sorted(written) == rows_of(rows, "shard", *fx.LIKES.names)


def test_database_sink_changes(spark, tmp_path):
    ops = operations_frame(spark, [("f", 1, 0, "I", 1, 5), ("f", 2, 0, "U", 2, 6), ("f", 3, 0, "D", 3, 0)])
    write_operations(compact_changes(ops, ITEMS), ITEMS, lambda shard: Recorder(str(tmp_path), shard), wait_seconds=0)
    statements = sorted(tuple(map(str, s)) for _, batch in recorded(str(tmp_path)) for s in batch)
    assert statements == [
        ("delete from items where k=?", "[3]"),
        ("replace into items (k, v) values (?, ?)", "[1, 5]"),
        ("update items set k=?, v=? where k=?", "[2, 6, 2]"),
    ]


def test_stream_into_databases(spark, tmp_path):
    """Statements of all batches, run in commit order, leave the sequential state."""
    operations = random_operations(21, 150, 20)
    landed, out, waits = str(tmp_path / "log"), str(tmp_path / "out"), [True, False, False, False]
    os.mkdir(out)
    for start in (0, 50, 100):
        events_frame(spark, operations[start : start + 50]).coalesce(1).write.mode("append").parquet(landed)
    stream_to_databases(
        stream_changelog(spark, landed, files_per_trigger=1), ITEMS, lambda shard: Recorder(out, shard),
        str(tmp_path / "checkpoint"), every=None, paused=lambda: waits.pop(0), pause_seconds=0.01, wait_seconds=0,
    ).awaitTermination()
    assert waits == [] and run_statements(recorded(out)) == sequential(operations)


def run_statements(batches):
    state = {}
    for _, batch in batches:
        for sql, args in batch:
            if sql.startswith("replace"):
                state[args[0]] = args[1]
            elif sql.startswith("delete"):
                state.pop(args[0], None)
            elif args[2] in state:
                state[args[0]] = args[1]
    return sorted(state.items())


def test_late_files_and_rotations_into_databases(spark, tmp_path):
    """A late file puts no older row over a newer one, and file names come from rotations."""

    def part(rows):
        return spark.createDataFrame(
            [("src", seq, None, pos, name, nxt, "db", "items", images) for seq, pos, name, nxt, images in rows], event_schema()
        )

    landed, out = str(tmp_path / "log"), str(tmp_path / "out")
    os.mkdir(out)
    parts = [
        [(1, 4, "RotateEvent", "bin.1", None), (2, 900, "WriteRowsEventV2", None, [[1, 10]])],
        [(7, 4, "RotateEvent", "bin.3", None), (8, 100, "UpdateRowsEventV2", None, [[1, 11], [1, 22]])],
        [(4, 4, "RotateEvent", "bin.2", None), (5, 500, "UpdateRowsEventV2", None, [[1, 10], [1, 11]]), (6, 600, "WriteRowsEventV2", None, [[2, 5]])],
    ]
    for n, rows in enumerate(parts):
        part(rows).coalesce(1).write.mode("append").parquet(landed)
        stream_to_databases(
            stream_changelog(spark, landed), ITEMS, lambda shard: Recorder(out, shard), str(tmp_path / "checkpoint"),
            every=None, wait_seconds=0, rotating=True,
        ).awaitTermination()
    assert run_statements(recorded(out)) == [(1, 22), (2, 5)]


def test_events_without_a_file_fail_the_stream(spark, tmp_path):
    landed = str(tmp_path / "log")
    events_frame(spark, [("f", 1, 0, "I", 1, 5)]).withColumn("log_file", F.lit(None).cast("string")).write.parquet(landed)
    os.mkdir(tmp_path / "out")
    query = stream_to_databases(
        stream_changelog(spark, landed), ITEMS, lambda shard: Recorder(str(tmp_path / "out"), shard), str(tmp_path / "c"), every=None
    )
    with pytest.raises(PySparkException):
        query.awaitTermination()


def test_order_may_name_value_columns(spark, tmp_path):
    spec = replace(ITEMS, order=("v",))
    operations = random_operations(31, 60, 9)
    apply = StreamApply(spec, str(tmp_path / "state"))
    apply.process(events_frame(spark, operations), 0)
    assert apply.compact(spark) == 0
    assert rows_of(apply.current(spark), "k", "v") == sequential(operations)
    out = str(tmp_path / "out")
    os.mkdir(out)
    write_operations(compact_changes(operations_frame(spark, operations), spec), spec, lambda shard: Recorder(out, shard), wait_seconds=0)
    assert run_statements(recorded(out)) == sequential(operations)


@pytest.mark.parametrize("element", ["binary", "string"])
def test_latin1_columns_and_keys(spark, element):
    """Bytes are decoded, text is taken as it is; a latin1 key is hashed as text."""
    spec = TableSpec("t", (ColumnSpec("k", 0, charset="latin1"), ColumnSpec("n", 1, "int")), key=("k",), shard_num=4)
    text = F.unhex(F.lit("E9")) if element == "binary" else F.lit("é")
    image = F.array(text, F.lit("7").cast(element))
    events = spark.range(1).select(
        F.lit("src").alias("source"), F.lit(1).cast("bigint").alias("seq"), F.lit("f").alias("log_file"),
        F.lit(4).cast("bigint").alias("log_pos"), F.lit("WriteRowsEventV2").alias("event_name"),
        F.lit(None).cast("string").alias("next_log_name"), F.lit("db").alias("database_name"),
        F.lit("t").alias("table_name"), F.array(image).alias("rows"),
    )
    target = spark.createDataFrame([], "shard int, k string, n int")
    assert rows_of(apply_log(target, events, spec), "k", "n") == [("é", 7)]


def test_database_sink_gives_up(spark, tmp_path):
    ops = operations_frame(spark, [("f", 1, 0, "I", 1, 5)])

    def refuse(shard):
        raise ConnectionError("never")

    with pytest.raises(Exception, match="never"):
        write_operations(ops, ITEMS, refuse, attempts=2, wait_seconds=0)


def test_jdbc_options():
    options = snapshot.jdbc_options("jdbc:x", "t", 1, 100, 8)
    assert options["partitionColumn"] == "id" and options["upperBound"] == "101" and options["numPartitions"] == "8"


def test_no_python_in_operators():
    """Only the database sink handles rows in Python."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for name in glob.glob(f"{root}/reshard/**/*.py", recursive=True):
        text = open(name).read()
        assert not re.search(r"pandas|\budf\b|mapInPandas|\.rdd\b|localCheckpoint|crossJoin", text), name
        assert ("foreachPartition" in text) == name.endswith("database.py"), name
