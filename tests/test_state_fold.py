"""The fold in the state store, what becomes of held rows on their way to databases, and the ledger of finished parts."""

import glob
import json
import os
import re
from dataclasses import replace

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import ITEMS, Recorder, events_frame, operations_frame, random_operations, recorded, rows_of, sequential
from reshard.operators.folding import compact_changes
from reshard.sinks.database import Ledger, write_operations
from reshard.sources.changelog import stream_changelog
from reshard.streaming.apply import StreamApply, stream_to_databases
from reshard.streaming.state_fold import FoldedDatabases, StateFold, folded_stream
from test_sinks_and_plans import run_statements

SHARDED = replace(ITEMS, shard_num=4)


def wide(operations):
    """The same operations over two shards."""
    return [(f, p, r, op, (k % 2) * 2**48 + k, v) for f, p, r, op, k, v in operations]


def land(spark, operations, path):
    events_frame(spark, operations).coalesce(1).write.mode("append").parquet(path)


def log(spark, path, files=1):
    return stream_changelog(spark, path, files_per_trigger=files)


def ignore(facts, batch_id):
    facts.write.format("noop").mode("overwrite").save()


def test_late_repeated_and_resumed(spark, tmp_path):
    """Files in any order, one of them twice, over a restart: the fold is that of the whole log."""
    operations = random_operations(41, 240, 25)
    parts = [operations[i::4] for i in (2, 0, 3, 1)]
    landed, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")
    for part in (parts[0], parts[1]):
        land(spark, part, landed)
    StateFold(ITEMS, checkpoint).start(log(spark, landed), ignore, every=None).awaitTermination()
    for part in (parts[2], parts[0], parts[3]):
        land(spark, part, landed)
    again = StateFold(ITEMS, checkpoint)
    again.start(log(spark, landed), ignore, every=None).awaitTermination()
    assert rows_of(again.current(spark), "k", "v") == sequential(operations)


def test_a_batch_touches_the_state_of_its_keys_only(spark, tmp_path):
    landed, checkpoint, seen = str(tmp_path / "log"), str(tmp_path / "checkpoint"), []
    land(spark, [("f", n, 0, "I", n, n) for n in range(300)], landed)
    StateFold(ITEMS, checkpoint).start(log(spark, landed), ignore, every=None).awaitTermination()
    land(spark, [("g", 1, 0, "U", 7, 70), ("g", 2, 0, "U", 7, 71), ("g", 3, 0, "D", 9, 0)], landed)
    fold = StateFold(ITEMS, checkpoint)
    query = fold.start(log(spark, landed), lambda facts, n: seen.append(sorted(r["k"] for r in facts.collect())), every=None)
    query.awaitTermination()
    state = query.lastProgress["stateOperators"][0]
    assert seen == [[7, 9]] and state["numRowsUpdated"] == 2 and state["numRowsTotal"] == 300
    plan = query._jsq.explainInternal(False) if hasattr(query._jsq, "explainInternal") else ""
    assert "StateStoreRestore" in plan and "base" not in re.findall(r"Location: .*", plan)
    assert fold.facts(spark).count() == 300 and fold.current(spark).count() == 299


def test_refused_changes_fail_or_come_out(spark, tmp_path):
    landed = str(tmp_path / "log")
    land(spark, [("f", 1, 0, "I", 1, 5), ("f", 2, 0, "I", None, 6)], landed)
    query = StateFold(ITEMS, str(tmp_path / "a")).start(log(spark, landed), ignore, every=None)
    with pytest.raises(PySparkException, match="null_key"):
        query.awaitTermination()
    out, rejects = str(tmp_path / "out"), str(tmp_path / "rejects")
    os.mkdir(out)
    query = stream_to_databases(
        log(spark, landed), ITEMS, lambda shard: Recorder(out, shard), str(tmp_path / "b"), every=None, wait_seconds=0, rejects=rejects
    )
    query.awaitTermination()
    for other in spark.streams.active:
        other.processAllAvailable()
    assert run_statements(recorded(out)) == [(1, 5)]
    assert rows_of(spark.read.parquet(rejects), "reason") == [("null_key",)]


def test_shared_plan_is_streaming(spark, tmp_path):
    landed = str(tmp_path / "log")
    land(spark, [("f", 1, 0, "I", 1, 5)], landed)
    assert folded_stream(log(spark, landed), ITEMS).isStreaming


@pytest.mark.parametrize("kept_in", ["state store", "files"])
def test_held_rows_reach_the_databases(spark, tmp_path, kept_in):
    """Rows that were held and released between two batches are not lost, whichever way the facts are kept."""
    operations = wide(random_operations(42, 200, 20))
    landed, out, held = str(tmp_path / "log"), str(tmp_path / "out"), {"on": True}
    os.mkdir(out)

    def hold(facts):
        return facts.withColumn("held", (F.col("shard") == 1) & held["on"])

    def connect(shard):
        return Recorder(out, shard)

    state = StreamApply(SHARDED, str(tmp_path / "state"), hold=hold)
    folded = FoldedDatabases(SHARDED, connect, str(tmp_path / "checkpoint"), hold=hold, wait_seconds=0)

    def run(part):
        land(spark, part, landed)
        if kept_in == "files":
            query = stream_to_databases(log(spark, landed), SHARDED, connect, str(tmp_path / "checkpoint"), every=None, wait_seconds=0, state=state)
        else:
            query = folded.start(log(spark, landed), every=None)
        query.awaitTermination()

    near = [o for o in operations if o[4] < 2**48]
    run(operations[:80])
    assert run_statements(recorded(out)) == sequential([o for o in operations[:80] if o in near])
    run(operations[80:120])
    held["on"] = False
    (state if kept_in == "files" else folded).release(spark)
    if kept_in == "state store":
        assert run_statements(recorded(out)) == sequential(operations[:120])
    held["on"] = True
    # The next batch is about other shards only.
    quiet = [o for o in operations[120:] if o in near]
    run(quiet)
    assert run_statements(recorded(out)) == sequential(operations[:120] + quiet)
    held["on"] = False
    late = [o for o in operations[120:] if o not in near]
    run(late)
    assert run_statements(recorded(out)) == sequential(operations)


def test_releasing_twice_stores_once(spark, tmp_path):
    held = {"on": True}
    apply = StreamApply(SHARDED, str(tmp_path / "state"), hold=lambda facts: facts.withColumn("held", F.lit(held["on"])))
    apply.process(events_frame(spark, [("f", 1, 0, "I", 1, 5), ("f", 2, 0, "I", 2, 6)]), 0)
    held["on"] = False
    for _ in range(3):
        apply.release(spark)
    assert spark.read.parquet(str(tmp_path / "state" / "released")).count() == 2
    assert rows_of(apply.current(spark, shards=[0]), "k", "v") == [(1, 5), (2, 6)]
    assert apply.current(spark, shards=[1]).count() == 0


def test_shards_without_deltas_are_pruned(spark, tmp_path):
    apply = StreamApply(SHARDED, str(tmp_path / "state"))
    rows = spark.createDataFrame([(0, 1, 1), (1, 2**48, 2)], "shard int, k bigint, v int")
    apply.seed(rows, ("f", 0))
    assert rows_of(apply.current(spark, shards=[1]), "k", "v") == [(2**48, 2)]


class Journal:
    """A connection to a database that is a folder: transactions appear whole, and the ledger is read from them.

    ``lost`` tells which commits reach the database without the client hearing of it.
    """

    def __init__(self, folder, shard, lost):
        self.folder, self.shard, self.lost, self.pending, self.answer = folder, shard, lost, [], None

    def cursor(self):
        return self

    def _entries(self):
        return [s for name in glob.glob(f"{self.folder}/{self.shard}-*.json") for s in json.load(open(name))]

    def execute(self, sql, args):
        if sql.startswith("select"):
            found = [s[1][2] for s in self._entries() if "applied_batches" in s[0] and s[1][:2] == args]
            self.answer = (max(found),) if found else None
        else:
            self.pending.append([sql, args])

    def fetchone(self):
        return self.answer

    def commit(self):
        if not self.pending:
            return
        number = len(glob.glob(f"{self.folder}/{self.shard}-*.json"))
        with open(f"{self.folder}/{self.shard}-{number}-{os.getpid()}-{id(self)}.json", "w") as out:
            json.dump(self.pending, out)
        self.pending = []
        mark = f"{self.folder}/lost-{self.shard}-{number}"
        if number in self.lost and not os.path.exists(mark):
            open(mark, "w").close()
            raise ConnectionError("answer lost after the commit")

    def rollback(self):
        self.pending = []

    def close(self):
        pass


@pytest.mark.parametrize("with_ledger", [True, False])
def test_ledger_keeps_parts_from_running_twice(spark, tmp_path, with_ledger):
    """Commits whose answer is lost are tried again: with a ledger every statement has run once, without it some ran twice."""
    out = str(tmp_path)
    ledger = Ledger("likes", parts=4) if with_ledger else None
    for batch, part in enumerate((range(0, 40), range(40, 60), range(0, 20))):
        ops = operations_frame(spark, [("f", 100 * batch + n, 0, "I", n, batch) for n in part])
        for _ in range(2):  # the whole batch comes again after a restart
            write_operations(
                compact_changes(ops, ITEMS), ITEMS, lambda shard: Journal(out, shard, {0, 2, 5}), wait_seconds=0,
                ledger=ledger.at(batch) if ledger else None, tasks=2,
            )
    statements = [tuple(s[1]) for name in glob.glob(f"{out}/*.json") for s in json.load(open(name)) if "into items" in s[0]]
    wanted = [(n, 0) for n in range(40)] + [(n, 1) for n in range(40, 60)] + [(n, 2) for n in range(20)]
    if with_ledger:
        assert sorted(statements) == sorted(wanted)
    else:
        assert set(statements) == set(wanted) and len(statements) > len(wanted)
