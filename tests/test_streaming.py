import random

import pytest
from pyspark.sql import functions as F

from helpers import ITEMS, events_frame, random_operations, rows_of, sequential
from reshard.functions.positions import position
from reshard.sources.changelog import after, event_schema, resume, start_positions, stream_changelog
from reshard.spec import TableSpec
from reshard.streaming.apply import StreamApply, lag_gate, stop_between_batches
from reshard.streaming.listeners import Listener, listen, listener_counts, notify

SOURCED = TableSpec(**{**ITEMS.__dict__, "source": "source"})


def land(spark, operations, path):
    events_frame(spark, operations).coalesce(1).write.mode("append").parquet(path)


def run(apply, spark, path, files=1):
    query = apply.start(stream_changelog(spark, path, files_per_trigger=files), every=None)
    query.awaitTermination()


def current(apply, spark):
    return rows_of(apply.current(spark), "k", "v")


def test_stop_and_restart(spark, tmp_path):
    operations = random_operations(11, 300, 40)
    landed, apply = str(tmp_path / "log"), StreamApply(ITEMS, str(tmp_path / "state"))
    for part in (operations[:100], operations[100:150]):
        land(spark, part, landed)
    run(apply, spark, landed)
    assert current(apply, spark) == sequential(operations[:150])
    again = StreamApply(ITEMS, str(tmp_path / "state"))
    land(spark, operations[150:], landed)
    run(again, spark, landed)
    assert current(again, spark) == sequential(operations)
    assert again.last_batch(spark) == 2
    last = operations[-1]
    assert rows_of(again.positions(spark), "source", "log_file", "log_pos") == [("src", last[0], last[1] * 10 + last[2])]


def test_repeated_and_late_batches(spark, tmp_path):
    operations = random_operations(12, 200, 25)
    parts = [operations[i::3] for i in range(3)]
    random.Random(1).shuffle(parts)
    apply = StreamApply(ITEMS, str(tmp_path / "state"))
    for batch, part in enumerate(parts):
        apply.process(events_frame(spark, part), batch)
        apply.process(events_frame(spark, part), batch)
    apply.process(events_frame(spark, parts[0]), 3)
    assert current(apply, spark) == sequential(operations)


def test_compaction_keeps_room_for_late_changes(spark, tmp_path):
    operations = random_operations(13, 240, 20)
    parts = [operations[i::4] for i in range(4)]
    apply = StreamApply(ITEMS, str(tmp_path / "state"))
    assert apply.current(spark) is None and apply.compact(spark) is None
    for batch, part in enumerate(parts):
        apply.process(events_frame(spark, part), batch)
        if batch in (0, 2):
            assert apply.compact(spark) == batch
            assert apply.compact(spark) is None
    assert current(apply, spark) == sequential(operations)
    assert apply.compact(spark) == 3
    assert current(apply, spark) == sequential(operations)


def test_empty_batches(spark, tmp_path):
    apply = StreamApply(ITEMS, str(tmp_path / "state"))
    empty = spark.createDataFrame([], event_schema())
    apply.process(empty, 0)
    apply.process(events_frame(spark, [("f", 1, 0, "I", 1, 5)]), 1)
    apply.process(empty, 2)
    assert current(apply, spark) == [(1, 5)]


@pytest.mark.parametrize("spec, starts", [(ITEMS, ("bin.00001", 0)), (SOURCED, None)])
def test_seeded_with_a_snapshot(spark, tmp_path, spec, starts):
    operations = random_operations(14, 100, 30)
    start = {k: 1000 + k for k in range(0, 60, 2)}
    rows = spark.createDataFrame([("src", 0, k, v) for k, v in start.items()], "source string, shard int, k bigint, v int")
    if starts is None:
        starts = spark.createDataFrame([("src",)], "source string").select(
            "source", position(F.lit("bin.00001"), F.lit(0)).alias("start")
        )
    apply = StreamApply(spec, str(tmp_path / "state"))
    apply.seed(rows, starts)
    assert current(apply, spark) == sorted(start.items())
    apply.process(events_frame(spark, operations), 0)
    assert current(apply, spark) == sequential(operations, start)


def test_rejects_are_stored(spark, tmp_path):
    apply = StreamApply(ITEMS, str(tmp_path / "state"))
    events = events_frame(spark, [("f", 1, 0, "I", 1, 5), ("f", 2, 0, "I", None, 5)])
    apply.process(events, 0)
    assert [r["reason"] for r in apply.rejects(spark).collect()] == ["null_key"]
    assert current(apply, spark) == [(1, 5)]


def test_rotating_log(spark, tmp_path):
    """File names come from rotations, also from those of earlier batches."""

    def batch(rows):
        return spark.createDataFrame(
            [("src", seq, None, pos, name, nxt, "db", "items", images) for seq, pos, name, nxt, images in rows], event_schema()
        )

    apply = StreamApply(ITEMS, str(tmp_path / "state"), rotating=True)
    apply.process(batch([(1, 4, "RotateEvent", "bin.1", None), (2, 900, "WriteRowsEventV2", None, [[1, 10]])]), 0)
    apply.process(batch([(3, 950, "WriteRowsEventV2", None, [[2, 20]]), (4, 4, "RotateEvent", "bin.2", None)]), 1)
    apply.process(batch([(5, 100, "UpdateRowsEventV2", None, [[1, 10], [1, 11]])]), 2)
    assert current(apply, spark) == [(1, 11), (2, 20)]
    assert rows_of(apply.positions(spark), "log_file", "log_pos") == [("bin.2", 100)]
    # Repeating a batch does not see rotations of its own or later batches as earlier ones.
    apply.process(batch([(3, 950, "WriteRowsEventV2", None, [[2, 20]]), (4, 4, "RotateEvent", "bin.2", None)]), 1)
    assert current(apply, spark) == [(1, 11), (2, 20)]


def test_pauses_before_a_batch(spark, tmp_path):
    answers = [True, True, False]
    apply = StreamApply(ITEMS, str(tmp_path / "state"), paused=lambda: answers.pop(0), pause_seconds=0.01)
    apply.process(events_frame(spark, [("f", 1, 0, "I", 1, 5)]), 0)
    assert answers == [] and current(apply, spark) == [(1, 5)]
    flags = spark.createDataFrame([("a", False), ("b", True)], "host string, paused boolean")
    assert lag_gate(lambda: flags)() and not lag_gate(lambda: flags.where("not paused"))()


def test_stops_between_batches(spark, tmp_path):
    landed, apply = str(tmp_path / "log"), StreamApply(ITEMS, str(tmp_path / "state"))
    land(spark, [("f", 1, 0, "I", 1, 5)], landed)
    query = apply.start(stream_changelog(spark, landed), every="1 second")
    query.processAllAvailable()
    stop_between_batches(query)
    assert not query.isActive and current(apply, spark) == [(1, 5)]


def test_listeners(spark, tmp_path):
    seen = {}

    def remember(name):
        return lambda part, batch_id: seen.__setitem__((name, batch_id), part.count())

    listeners = [
        Listener("all", "*", "*", remember("all")),
        Listener("items", "db", "ITEM*", remember("items"), wait=False),
        Listener("none", "db", "other", remember("none"), wait=False),
    ]
    landed = str(tmp_path / "log")
    land(spark, [("f", 1, 0, "I", 1, 5), ("f", 2, 0, "I", 2, 5)], landed)
    listen(stream_changelog(spark, landed), listeners, str(tmp_path / "checkpoint"), every=None).awaitTermination()
    assert seen == {("all", 0): 2, ("items", 0): 2, ("none", 0): 0}
    events = events_frame(spark, [("f", 1, 0, "I", 1, 5)])
    assert rows_of(listener_counts(events, listeners), "listener", "rows") == [("all", 1), ("items", 1), ("none", 0)]


def test_listener_failures_are_raised(spark):
    def fail(part, batch_id):
        raise RuntimeError("no")

    events = events_frame(spark, [("f", 1, 0, "I", 1, 5)])
    for wait in (True, False):
        with pytest.raises(RuntimeError):
            notify(events, [Listener("x", "*", "*", fail, wait=wait)])
    with pytest.raises(ValueError):
        Listener("x", "", "*")


def test_where_to_start(spark):
    log = events_frame(spark, [("f1", 1, 0, "I", 1, 5), ("f2", 1, 0, "I", 2, 5)])
    log = log.unionByName(log.withColumn("source", F.lit("new"))).unionByName(log.withColumn("source", F.lit("old")))
    names = "source string, log_file string, log_pos bigint"
    explicit = spark.createDataFrame([("src", "f1", 10)], names)
    saved = spark.createDataFrame([("src", "f2", 10), ("old", "f1", 0)], names)
    starts = rows_of(start_positions(log, explicit, saved), "source", "start.log_file", "start.log_pos")
    assert starts == [("new", "f2", 10), ("old", "f1", 0), ("src", "f1", 10)]
    found = rows_of(resume(log, explicit, saved), "source", "log_file")
    assert found == [("old", "f1"), ("old", "f2"), ("src", "f2")]
    assert rows_of(after(log, start_positions(log, explicit, saved)), "source", "log_file") == found


def test_bucketed_base_is_not_shuffled(spark, tmp_path):
    operations = random_operations(15, 240, 40)
    parts = [operations[i::4] for i in range(4)]
    apply = StreamApply(SOURCED, str(tmp_path / "state"), buckets=8)
    for batch, part in enumerate(parts):
        apply.process(events_frame(spark, part), batch)
        if batch == 1:
            assert apply.compact(spark) == 1
    assert current(apply, spark) == sequential(operations)
    # A new session does not know the table, only the files.
    spark.sql(f"DROP TABLE {apply._table(1)}")
    plan = apply.current(spark)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    assert current(StreamApply(SOURCED, str(tmp_path / "state")), spark) == sequential(operations)
    assert apply.compact(spark) == 3
    assert current(apply, spark) == sequential(operations)


def test_dry_run_stores_nothing(spark, tmp_path):
    seen = {}
    apply = StreamApply(
        ITEMS, str(tmp_path / "state"), preview=lambda first, batch: seen.__setitem__(batch, rows_of(first, "shard", "rendered"))
    )
    apply.process(events_frame(spark, [("f", 2, 0, "I", 2, 6), ("f", 1, 0, "D", 1, 5)]), 0)
    assert seen == {0: [(0, "delete from items where k=? --> [1]")]}
    assert apply.current(spark) is None


def test_dry_run_leaves_the_log_to_the_real_run(spark, tmp_path):
    operations, landed, state = random_operations(17, 60, 9), str(tmp_path / "log"), str(tmp_path / "state")
    land(spark, operations, landed)
    run(StreamApply(ITEMS, state, preview=lambda first, batch: first.collect()), spark, landed)
    apply = StreamApply(ITEMS, state)
    run(apply, spark, landed)
    assert current(apply, spark) == sequential(operations)


def test_held_changes_wait_and_fold(spark, tmp_path):
    operations = random_operations(18, 200, 20)
    held = {"on": True}
    spec = TableSpec(**{**ITEMS.__dict__, "shard_num": 4})
    wide = [(f, p, r, op, (k % 2) * 2**48 + k, v) for f, p, r, op, k, v in operations]
    apply = StreamApply(spec, str(tmp_path / "state"), hold=lambda facts: facts.withColumn("held", (F.col("shard") == 1) & held["on"]))
    apply.process(events_frame(spark, wide[:120]), 0)
    due = sequential([o for o in wide[:120] if o[4] < 2**48])
    assert current(apply, spark) == due
    apply.process(events_frame(spark, wide[120:180]), 1)
    apply.release(spark)
    assert current(apply, spark) == sequential([o for o in wide[:180] if o[4] < 2**48])
    held["on"] = False
    apply.release(spark)
    assert current(apply, spark) == sequential(wide[:180])
    assert apply.compact(spark) == 1
    apply.process(events_frame(spark, wide[180:]), 2)
    assert current(apply, spark) == sequential(wide)


def test_vacuum_keeps_what_is_needed(spark, tmp_path):
    operations = random_operations(19, 240, 20)
    parts = [operations[i * 40 : (i + 1) * 40] for i in range(6)]
    apply = StreamApply(ITEMS, str(tmp_path / "state"))
    for batch in range(4):
        apply.process(events_frame(spark, parts[batch]), batch)
        if batch in (1, 3):
            apply.compact(spark)
    assert apply.vacuum(spark) > 0 and apply.vacuum(spark) == 0
    folders = [p.name for p in (tmp_path / "state" / "delta").iterdir()]
    assert folders == [] and [p.name for p in (tmp_path / "state" / "base").iterdir()] == ["upto=3"]
    assert current(apply, spark) == sequential(operations[:160])
    again = StreamApply(ITEMS, str(tmp_path / "state"))
    again.process(events_frame(spark, parts[3]), 3)
    for batch in (4, 5):
        again.process(events_frame(spark, parts[batch]), batch)
    assert current(again, spark) == sequential(operations)
    assert rows_of(again.current(spark, shards=[0]), "k", "v") == sequential(operations)
    assert again.current(spark, shards=[1]).count() == 0


def test_tidies_itself_up(spark, tmp_path):
    """With ``compact_every`` the deltas do not pile up, and late files still find their place."""
    operations = random_operations(24, 240, 20)
    parts = [operations[i::8] for i in range(8)]
    landed, apply = str(tmp_path / "log"), StreamApply(ITEMS, str(tmp_path / "state"), compact_every=3)
    for part in parts:
        land(spark, part, landed)
    run(apply, spark, landed)
    assert current(apply, spark) == sequential(operations)
    assert sorted(p.name for p in (tmp_path / "state" / "base").iterdir()) == ["upto=5"]
    assert sorted(p.name for p in (tmp_path / "state" / "delta").iterdir() if "=" in p.name) == ["batch_id=6", "batch_id=7"]


@pytest.mark.parametrize("spec, buckets", [(ITEMS, None), (SOURCED, 8)])
def test_removed_keys_can_be_forgotten(spark, tmp_path, spec, buckets):
    operations = random_operations(16, 240, 60)
    apply = StreamApply(spec, str(tmp_path / "state"), buckets=buckets)
    apply.process(events_frame(spark, operations[:120]), 0)
    log_file, log_pos, row_idx = operations[99][:3]
    passed = spark.createDataFrame([("src", log_file, log_pos * 10 + row_idx)], "source string, log_file string, log_pos bigint")
    kept = apply.facts(spark).count()
    assert apply.compact(spark, passed) == 0
    assert apply.facts(spark).count() < kept
    assert current(apply, spark) == sequential(operations[:120])
    # Changes that were forgotten about are skipped, newer ones fit, in any order.
    apply.process(events_frame(spark, operations[180:]), 1)
    apply.process(events_frame(spark, operations[50:180]), 2)
    assert current(apply, spark) == sequential(operations)
    assert apply.compact(spark) == 2
    assert current(apply, spark) == sequential(operations)


def test_seed_keeps_rows_of_unknown_sources(spark, tmp_path):
    rows = spark.createDataFrame([("src", 0, 1, 1), ("other", 0, 1, 2)], "source string, shard int, k bigint, v int")
    starts = spark.createDataFrame([("src",)], "source string").select(
        "source", position(F.lit("bin.00001"), F.lit(0)).alias("start")
    )
    apply = StreamApply(SOURCED, str(tmp_path / "state"))
    apply.seed(rows, starts)
    assert current(apply, spark) == [(1, 1), (1, 2)]


def test_progress(spark, tmp_path):
    seen = {}
    spec = TableSpec(**{**ITEMS.__dict__, "shard_num": 4, "shard_filter": lambda shard: shard != 2})
    apply = StreamApply(spec, str(tmp_path / "state"), progress=seen.__setitem__)
    operations = [("f", n, 0, "I", key, 5) for n, key in enumerate([1, 2, 2**48, 2**49, 3 * 2**48, None])]
    land(spark, operations, str(tmp_path / "log"))
    run(apply, spark, str(tmp_path / "log"))
    assert seen == {0: {"changes": 6, "rejected": 1, "pushed": [2, 1, 0, 1]}}
    apply.process(spark.createDataFrame([], event_schema()), 1)
    assert seen[1] == {"changes": 0, "rejected": 0, "pushed": [0, 0, 0, 0]}
