"""Streams that know their place in the log, drop what comes twice, and keep a place per listener."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import events_frame, random_operations, rows_of
from reshard.operators.changes import drop_replayed_stream
from reshard.sources import position_log
from reshard.sources.changelog import event_schema
from reshard.sources.position_log import PositionReader, land_changelog, stream_positions
from reshard.streaming.files import start_batches
from reshard.streaming.listeners import Listener, listen, listen_each, listener_positions


def land(spark, operations, path, source="src"):
    land_changelog(events_frame(spark, operations).withColumn("source", F.lit(source)), path)


def reader(path, **options):
    return PositionReader({"path": path, **{k: str(v) for k, v in options.items()}}, event_schema())


def places(operations, source="src"):
    return sorted((source, f, p * 10 + r) for f, p, r, *_ in operations)


def read_stream(spark, path, checkpoint, out, start, **options):
    query = start_batches(
        stream_positions(spark, path, start, **options), lambda part, n: part.write.mode("overwrite").parquet(f"{out}/batch_id={n}"), checkpoint, None
    )
    query.awaitTermination()
    return query


def test_explicit_start_inside_a_file_then_the_checkpoint(spark, tmp_path):
    operations = random_operations(51, 200, 10)
    path, out, checkpoint = str(tmp_path / "log"), str(tmp_path / "out"), str(tmp_path / "c")
    land(spark, operations[:120], path)
    at = operations[70]
    start = {"src": (at[0], at[1] * 10 + at[2])}
    read_stream(spark, path, checkpoint, out, start)
    assert rows_of(spark.read.parquet(out), "source", "log_file", "log_pos") == places(operations[71:120])
    land(spark, operations[120:], path)
    # The start is not asked for any more: the stream goes on where it was.
    read_stream(spark, path, checkpoint, out, "latest")
    assert rows_of(spark.read.parquet(out), "source", "log_file", "log_pos") == places(operations[71:])
    images = spark.read.parquet(out).where("event_name like 'Update%'").select(F.size("rows").alias("n")).distinct().collect()
    assert [r["n"] for r in images] == [2]


def test_latest_and_earliest(spark, tmp_path):
    path = str(tmp_path / "log")
    land(spark, [("f1", 1, 0, "I", 1, 1), ("f2", 2, 0, "I", 2, 2)], path, "a/b")
    assert reader(path).initialOffset() == {"a/b": ["f2", 20]}
    assert reader(path, start="earliest").initialOffset() == {}
    assert reader(path, start=json.dumps({"other": ["x", 5]})).initialOffset() == {"a/b": ["f2", 20], "other": ["x", 5]}
    assert reader(str(tmp_path / "nothing")).initialOffset() == {}
    parts = reader(path).partitions({"a/b": ["f1", 10]}, {"a/b": ["f2", 20]})
    assert [(p.source, p.log_file, p.after, p.upto) for p in parts] == [("a/b", "f2", None, 20)]


def test_flush_by_count_or_delay(spark, tmp_path, monkeypatch):
    """A slow log waits for the delay, a burst goes out at once; nothing waits twice."""
    now = [100.0]
    monkeypatch.setattr(position_log.time, "monotonic", lambda: now[0])
    path = str(tmp_path / "log")
    land(spark, [("f1", 1, 0, "I", 1, 1)], path)
    stream = reader(path, start="earliest", least_rows=10, longest_delay=2)
    assert stream.initialOffset() == {} and stream.latestOffset() == {}
    now[0] += 1.9
    land(spark, [("f1", 2, 0, "I", 2, 2)], path)
    assert stream.latestOffset() == {}
    now[0] += 0.2
    assert stream.latestOffset() == {"src": ["f1", 20]}
    now[0] += 50
    assert stream.latestOffset() == {"src": ["f1", 20]}
    land(spark, [("f1", 3, 0, "I", 3, 3)], path)
    assert stream.latestOffset() == {"src": ["f1", 20]}
    land(spark, [("f2", p, 0, "I", p, p) for p in range(1, 12)], path)
    assert stream.latestOffset() == {"src": ["f2", 110]}


def test_batches_of_bounded_size(spark, tmp_path):
    path = str(tmp_path / "log")
    for n in range(1, 5):
        land(spark, [(f"f{n}", p, 0, "I", p, p) for p in range(1, 6)], path, "a")
    land(spark, [("g1", p, 0, "I", p, p) for p in range(1, 4)], path, "b")
    stream = reader(path, start="earliest", most_rows=8)
    stream.initialOffset()
    steps = [stream.latestOffset() for _ in range(4)]
    assert steps[0] == {"a": ["f1", 50], "b": ["g1", 30]} and steps[1] == {"a": ["f3", 50], "b": ["g1", 30]}
    assert steps[2] == steps[3] == {"a": ["f4", 50], "b": ["g1", 30]}


def test_copies_on_a_stream(spark, tmp_path):
    """Each change once, and the state forgets changes that are older than the delay."""
    path, out = str(tmp_path / "log"), str(tmp_path / "out")
    changes = spark.range(3000).select(
        F.lit("s").alias("source"), F.lit("f").alias("log_file"), F.col("id").alias("log_pos"), F.lit(0).alias("row_idx"), F.timestamp_seconds(F.col("id") + 1_000_000_000).alias("ts")
    )
    for a, z in ((0, 1000), (900, 1000), (900, 2000), (1950, 2000), (2000, 3000)):
        changes.where(f"log_pos between {a} and {z - 1}").coalesce(1).write.mode("append").parquet(path)
    landed = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 1).parquet(path)
    stream = drop_replayed_stream(landed, "200 seconds", time="ts")
    assert stream.columns == changes.columns
    query = start_batches(stream, lambda part, n: part.write.mode("overwrite").parquet(f"{out}/batch_id={n}"), str(tmp_path / "c"), None)
    query.awaitTermination()
    assert rows_of(spark.read.parquet(out), "log_pos") == [(n,) for n in range(3000)]
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) <= 2000
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] < 1500


def test_a_failing_listener_neither_blocks_nor_repeats_the_others(spark, tmp_path):
    operations = random_operations(52, 90, 10)
    path, got = str(tmp_path / "log"), {"good": [], "bad": []}
    for start in (0, 30, 60):
        events_frame(spark, operations[start : start + 30]).coalesce(1).write.mode("append").parquet(path)
    broken = {"on": True}

    def good(part, batch_id):
        got["good"] += [(r["log_file"], r["log_pos"]) for r in part.collect()]

    def bad(part, batch_id):
        rows = [(r["log_file"], r["log_pos"]) for r in part.collect()]
        if broken["on"] and batch_id == 1:
            raise ValueError("not now")
        got["bad"] += rows

    listeners = [Listener("good", "*", "items", good), Listener("bad", "db", "*", bad)]

    def run():
        stream = spark.readStream.schema(event_schema()).option("maxFilesPerTrigger", 1).parquet(path)
        return listen_each(stream, listeners, str(tmp_path / "c"), every=None)

    queries = run()
    queries["good"].awaitTermination()
    with pytest.raises(PySparkException, match="not now"):
        queries["bad"].awaitTermination()
    wanted = sorted((f, p * 10 + r) for f, p, r, *_ in operations)
    assert sorted(got["good"]) == wanted and len(got["bad"]) == 30
    told = {r["listener"]: r["rows"] for r in listener_positions(spark, listeners, str(tmp_path / "c")).collect()}
    assert told == {"good": 90, "bad": 30}
    broken["on"] = False
    for query in run().values():
        query.awaitTermination()
    assert sorted(got["good"]) == sorted(got["bad"]) == wanted
    last = {(r["listener"], r["log_file"], r["log_pos"], r["rows"]) for r in listener_positions(spark, listeners, str(tmp_path / "c")).collect()}
    assert last == {(n, *wanted[-1], 90) for n in ("good", "bad")}


def test_names_of_listeners(spark):
    with pytest.raises(ValueError, match="names"):
        listen_each(None, [Listener("a", "*", "*"), Listener("a", "*", "*")], "c")
    with pytest.raises(ValueError, match="names"):
        listen_each(None, [Listener("a/b", "*", "*")], "c")


def test_listeners_of_a_rotating_log_get_the_file(spark, tmp_path):
    """Also for events of a batch that comes after the one with the rotation."""
    path, got = str(tmp_path / "log"), []

    def part(rows):
        return spark.createDataFrame([("s", n, None, 10 * n, e, nxt, "db", "items", None) for n, e, nxt in rows], event_schema())

    part([(1, "RotateEvent", "f1"), (2, "WriteRowsEventV2", None)]).coalesce(1).write.mode("append").parquet(path)
    part([(3, "WriteRowsEventV2", None), (4, "RotateEvent", "f2"), (5, "WriteRowsEventV2", None)]).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(event_schema()).option("maxFilesPerTrigger", 1).parquet(path)
    listener = Listener("all", "*", "*", lambda rows, n: got.extend((r["seq"], r["log_file"]) for r in rows.collect()))
    listen(stream, [listener], str(tmp_path / "c"), every=None, rotating=True).awaitTermination()
    assert sorted(got) == [(1, "f1"), (2, "f1"), (3, "f1"), (4, "f2"), (5, "f2")]
