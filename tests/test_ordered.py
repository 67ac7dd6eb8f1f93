"""Order-dependent operators against brute force, with one group holding most rows."""

import random

import pytest
from pyspark.sql import functions as F

from reshard.operators.audit import log_gap_audit
from reshard.operators.changes import assign_log_file
from reshard.operators.lag import pause_transitions, replica_lag
from reshard.operators.ordered import _placed, with_previous, with_row_number, with_running_total


def skewed(seed, count, spread=1):
    rnd = random.Random(seed)
    seqs = rnd.sample(range(count * spread), count)
    return [("hot" if rnd.random() < 0.7 else f"g{rnd.randrange(5)}", s, rnd.choice([None, 1, 2, 3])) for s in seqs]


@pytest.mark.parametrize("partitions", [None, 1, 7, 40])
@pytest.mark.parametrize("spread", [1, 1000])
def test_previous(spark, partitions, spread):
    data = skewed(1, 400, spread)
    expected, last = {}, {}
    for group, seq, value in sorted(data, key=lambda r: r[1]):
        expected[group, seq] = last.get(group)
        last[group] = value
    rows = spark.createDataFrame(data, "g string, seq bigint, v int")
    found = with_previous(rows, ["g"], "seq", "v", "was", partitions=partitions)
    assert {(r["g"], r["seq"]): r["was"] for r in found.collect()} == expected


def test_ranges_are_bounded_whatever_the_order_values(spark):
    """One far-off value, a group with nine tenths of the rows, and NULL as a group."""
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 10 > 0, "hot").when(F.col("id") % 20 > 0, "g").alias("g"),
        F.when(F.col("id") == 19_999, 10**15).otherwise(F.col("id")).alias("seq"),
        F.lit(1).alias("v"),
    )
    sizes = [r["count"] for r in _placed(rows, ["g"], ["seq"], 8).groupBy("_part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 20_000 / 8
    found = with_previous(rows, ["g"], "seq", "v", "was", F.lit(0), partitions=8)
    assert {(r["g"], r["was"]): r["count"] for r in found.groupBy("g", "was").count().collect()} == {
        ("hot", 0): 1, ("hot", 1): 17_999, ("g", 0): 1, ("g", 1): 999, (None, 0): 1, (None, 1): 999,
    }
    total = with_running_total(rows, ["g"], "seq", "v", "total", partitions=8)
    assert {r["g"]: r["m"] for r in total.groupBy("g").agg(F.max("total").alias("m")).collect()} == {"hot": 18_000, "g": 1000, None: 1000}
    numbered = with_row_number(rows, ["g"], ["seq"])
    assert {r["g"]: r["m"] for r in numbered.groupBy("g").agg(F.max("row_no").alias("m")).collect()} == {"hot": 18_000, "g": 1000, None: 1000}


@pytest.mark.parametrize("partitions", [None, 9])
def test_running_total(spark, partitions):
    data = skewed(4, 300, 50)
    expected, total = {}, {}
    for group, seq, value in sorted(data, key=lambda r: r[1]):
        total[group] = total.get(group, 0) + (value or 0)
        expected[group, seq] = total[group]
    rows = spark.createDataFrame(data, "g string, seq bigint, v int").fillna(0)
    found = with_running_total(rows, ["g"], "seq", "v", "total", partitions)
    assert {(r["g"], r["seq"]): r["total"] for r in found.collect()} == expected


@pytest.mark.parametrize("max_groups", [None, 6])
def test_row_number(spark, max_groups):
    data = skewed(2, 3000)
    expected, count = {}, {}
    for group, seq, _ in sorted(data, key=lambda r: r[1]):
        count[group] = count.get(group, 0) + 1
        expected[group, seq] = count[group]
    rows = spark.createDataFrame(data, "g string, seq bigint, v int")
    assert {(r["g"], r["seq"]): r["row_no"] for r in with_row_number(rows, ["g"], ["seq"], max_groups=max_groups).collect()} == expected


@pytest.mark.parametrize("bound", [0, 1_000_000])
@pytest.mark.parametrize("share", [0.0, 0.02, 0.5])
def test_log_files(spark, bound, share):
    rnd = random.Random(3)
    data, current, expected = [], {}, {}
    for seq in range(500):
        source = "big" if rnd.random() < 0.8 else "small"
        rotates = rnd.random() < share
        name = f"bin.{seq:05d}" if rotates else None
        current[source] = name or current.get(source)
        expected[seq] = current[source]
        data.append((source, seq * 3, "RotateEvent" if rotates else "WriteRowsEventV2", name))
    events = spark.createDataFrame(data, "source string, seq bigint, event_name string, next_log_name string")
    found = assign_log_file(events, max_broadcast_rows=bound).collect()
    assert {r["seq"] // 3: r["log_file"] for r in found} == expected
    assert len(found) == 500


def test_log_files_from_earlier_reads(spark):
    events = spark.createDataFrame(
        [("a", 10, "X", None), ("a", 11, "RotateEvent", "f2"), ("a", 12, "X", None), ("b", 10, "X", None)],
        "source string, seq bigint, event_name string, next_log_name string",
    )
    known = spark.createDataFrame([("a", 3, "f1")], "source string, seq bigint, log_file string")
    found = {(r["source"], r["seq"]): r["log_file"] for r in assign_log_file(events, known).collect()}
    assert found == {("a", 10): "f1", ("a", 11): "f2", ("a", 12): "f2", ("b", 10): None}


def beats(spark, lags):
    return spark.createDataFrame(
        [(host, seq, 10**18 + seq, 10**18 + seq + lag) for host, seq, lag in lags],
        "host string, seq bigint, heartbeat_ns bigint, observed_ns bigint",
    )


def test_lag_limits(spark):
    limit = 1_500_000_000
    rows = beats(spark, [("a", 1, limit), ("b", 1, limit + 1), ("c", 1, 0), ("d", 1, limit * 2), ("d", 2, -5)])
    found = {r["host"]: (r["lag_ns"], r["paused"]) for r in replica_lag(rows).collect()}
    assert found == {"a": (limit, False), "b": (limit + 1, True), "d": (limit * 2, True)}


@pytest.mark.parametrize("partitions", [None, 5])
def test_pause_changes(spark, partitions):
    high, low = 2_000_000_000, 1_000_000
    rows = beats(
        spark,
        [("a", 1, low), ("a", 2, high), ("a", 3, -1), ("a", 4, high), ("a", 5, low), ("b", 1, high), ("b", 9, high)],
    )
    found = sorted((r["host"], r["seq"], r["paused"]) for r in pause_transitions(rows, partitions).collect())
    assert found == [("a", 2, True), ("a", 5, False), ("b", 1, True)]


def test_gap_audit(spark):
    data = [
        ("a", "bin.00001", 1, 4), ("a", "bin.00001", 2, 100), ("a", "bin.00001", 3, 50),
        ("a", "bin.00003", 4, 4), ("a", "bin.00004", 5, 4), ("b", "noname", 1, 4),
        ("c", "bin.999999", 1, 4), ("c", "bin.1000000", 2, 4),
    ]
    log = spark.createDataFrame(data, "source string, log_file string, seq bigint, log_pos bigint")
    found = {(r["source"], r["log_file"]): r for r in log_gap_audit(log).collect()}
    assert found["a", "bin.00001"]["backward_steps"] == 1
    assert (found["a", "bin.00003"]["gap"], found["a", "bin.00003"]["distance"]) == (True, 2)
    assert not found["a", "bin.00004"]["gap"]
    assert found["b", "noname"]["expected_next"] is None
    # By name the longer number sorts first; by number it follows.
    assert found["c", "bin.999999"]["distance"] == -1
    numeric = {(r["source"], r["log_file"]): r for r in log_gap_audit(log, numeric_order=True).collect()}
    assert numeric["c", "bin.1000000"]["distance"] == 1
