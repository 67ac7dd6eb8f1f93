"""Look-ups by interval, merged position ranges, equal-depth id ranges and chunked bootstraps, against plain Python."""

import random
from bisect import bisect_right
from collections import defaultdict
from dataclasses import replace

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import ITEMS, events_frame, random_operations, rows_of, sequential
from reshard.functions.positions import position
from reshard.functions.search import count_up_to
from reshard.operators import intervals, lag
from reshard.operators.changes import assign_log_file
from reshard.plans.log_apply import bootstrap_chunks
from reshard.sources import snapshot


def test_search(spark):
    marks = sorted(random.Random(1).sample(range(200), 37))
    rows = spark.createDataFrame([(v,) for v in [*range(-3, 205), None]], "v bigint")
    found = dict(rows.select("v", count_up_to(F.col("v"), F.lit(marks), len(marks))).collect())
    assert found == {**{v: bisect_right(marks, v) for v in range(-3, 205)}, None: None}
    empty = rows.select(count_up_to(F.col("v"), F.array().cast("array<bigint>"), 0).alias("n")).where("n <> 0")
    assert empty.count() == 0


@pytest.mark.parametrize("bound", [1_000_000, 0])
def test_as_of(spark, bound):
    """One source with most rows, ties, NULLs, points before and far behind all rows; broadcast and shuffled."""
    rnd = random.Random(2)
    points = [("hot", rnd.randrange(5000), rnd.randrange(100)) for _ in range(300)] + [("cold", 50, 1), ("hot", 10**12, 7), (None, 5, 5), ("x", None, 4)]
    points += [("hot", points[0][1], 101)]
    rows = [("hot", rnd.randrange(-10, 6000)) for _ in range(3000)] + [("cold", 49), ("cold", 50), ("none", 1), (None, 5), ("hot", None), ("hot", 10**12)]
    places = defaultdict(dict)
    for by, at, value in points:
        if by is not None and at is not None:
            places[by][at] = max(value, places[by].get(at, value))

    def expected(by, at):
        known = sorted(places.get(by, {}))
        n = 0 if at is None else bisect_right(known, at)
        return places[by][known[n - 1]] if n else None

    left = spark.createDataFrame(rows, "by string, at bigint").withColumn("_to", F.lit("kept"))
    right = spark.createDataFrame(points, "by string, at bigint, value int")
    got = intervals.as_of(left, right, "by", "at", "value", bound)
    assert got.columns == ["by", "at", "_to", "value"]
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted((tuple(r) for r in got.select("by", "at", "value").collect()), key=key) == sorted(((*r, expected(*r)) for r in rows), key=key)
    none = intervals.as_of(left, right.limit(0), "by", "at", "value", bound)
    assert none.where("value is null").count() == len(rows)


def test_a_far_rotation_does_not_crowd_the_others(spark):
    """With one rotation at 10^12 an event still meets a few pieces: the join makes hardly more rows than there are events."""
    turns = [("s", 1000 * n, "RotateEvent", f"f.{n:06d}") for n in range(2000)] + [("s", 10**12, "RotateEvent", "f.999999")]
    rows = [("s", n, "WriteRowsEventV2", None) for n in range(500, 2_000_000, 997)]
    events = spark.createDataFrame(turns + rows, "source string, seq bigint, event_name string, next_log_name string")
    found = assign_log_file(events)
    assert found.where((F.col("event_name") != "RotateEvent") & (F.col("log_file") != F.format_string("f.%06d", F.floor(F.col("seq") / 1000)))).count() == 0
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert "_bucket" in text
    points = events.where("event_name = 'RotateEvent'").select("source", "seq", F.col("next_log_name").alias("log_file"))
    grid = F.array(*[F.lit(i / intervals.BUCKETS) for i in range(1, intervals.BUCKETS)])
    marks = points.agg(F.percentile_approx("seq", grid, F.lit(intervals.ACCURACY))).first()[0]
    assert len(set(marks)) > 1500


def brute_merge(ranges):
    out = defaultdict(list)
    for source, a, z in sorted(r for r in ranges if r[1] < r[2]):
        if out[source] and a <= out[source][-1][1]:
            out[source][-1][1] = max(z, out[source][-1][1])
        else:
            out[source].append([a, z])
    return sorted((s, *r) for s, found in out.items() for r in found)


def ranges_frame(spark, ranges):
    rows = [(s, f"f{a // 100:03d}", a % 100, f"f{z // 100:03d}", z % 100) for s, a, z in ranges]
    frame = spark.createDataFrame(rows, "source string, af string, ap bigint, zf string, zp bigint")
    return frame.select(*intervals.read_range(*[F.col(c) for c in frame.columns]))


def plain(merged):
    number = lambda p: int(p["log_file"][1:]) * 100 + p["log_pos"]
    return sorted((r["source"], number(r["after"]), number(r["upto"])) for r in merged.collect())


@pytest.mark.parametrize("seed", range(3))
def test_merged_ranges(spark, seed):
    """Merging is the same in one go and in two, and with itself; gaps are what is left between."""
    rnd = random.Random(seed)
    ranges = []
    for _ in range(120):
        a = rnd.randrange(900)
        ranges.append((rnd.choice("aab"), a, a + rnd.choice([0, 1, 5, 20])))
    wanted, frame = brute_merge(ranges), ranges_frame(spark, ranges).persist()
    merged = intervals.merge_ranges(frame, partitions=4)
    assert plain(merged) == wanted
    half = F.xxhash64("after", "upto") % 2 == 0
    parts = intervals.merge_ranges(frame.where(half)).unionByName(intervals.merge_ranges(frame.where(~half)))
    assert plain(intervals.merge_ranges(parts)) == wanted == plain(intervals.merge_ranges(merged))
    between = [(s, z, a) for (s, _, z), (t, a, _) in zip(wanted, wanted[1:]) if s == t]
    assert plain(intervals.gaps(merged)) == between
    at = spark.createDataFrame([(s, f"f{n // 100:03d}", n % 100) for s in "abc" for n in range(0, 1000, 3)], "source string, log_file string, log_pos bigint")
    left = {(r["source"], int(r["log_file"][1:]) * 100 + r["log_pos"]) for r in intervals.skip_ranges(at, merged).collect()}
    assert left == {(s, n) for s in "abc" for n in range(0, 1000, 3) if not any(t == s and a < n <= z for t, a, z in wanted)}


def test_a_late_file_is_not_skipped(spark):
    """Files 1 and 3 were applied; file 2 comes late: a maximum would drop it, the ranges do not."""
    events = events_frame(spark, [(f"f{n}", p, 0, "I", n, p) for n in (1, 2, 3) for p in (1, 2)])
    edges = [("src", "f0", 0, "f1", 20), ("src", "f2", 20, "f3", 20)]
    applied = spark.createDataFrame(edges, "source string, af string, ap bigint, zf string, zp bigint")
    merged = intervals.merge_ranges(applied.select(*intervals.read_range(*[F.col(c) for c in applied.columns])))
    assert rows_of(intervals.skip_ranges(events, merged), "log_file", "log_pos") == [("f2", 10), ("f2", 20)]


def test_ranges_of_uneven_ids(spark):
    """Clustered ids, one far off, negative ones and NULL: ranges hold equal counts, and their predicates take each row once."""
    rnd = random.Random(5)
    ids = sorted({*range(5000), *(rnd.randrange(10**9) for _ in range(700)), 10**17, -(10**12)})
    rows = spark.createDataFrame([(i,) for i in ids], "id bigint").repartition(7)
    plan = snapshot.snapshot_ranges(rows, 300).orderBy("chunk").collect()
    want = [ids[i : i + 300] for i in range(0, len(ids), 300)]
    assert [(r["lo"], r["hi"], r["rows"]) for r in plan] == [(w[0], w[-1], len(w)) for w in want]
    predicates = snapshot.range_predicates(snapshot.snapshot_ranges(rows, 300))
    tagged = [rows.unionByName(spark.createDataFrame([(None,), (10**18,), (-(10**18),)], "id bigint")).where(p) for p in predicates]
    taken = sorted(r["id"] if r["id"] is not None else 0.5 for part in tagged for r in part.collect())
    assert taken == sorted([*ids, 10**18, -(10**18), 0.5])


def test_ranges_of_repeated_ids_and_nothing(spark):
    rows = spark.createDataFrame([("a", 1)] * 50 + [("a", i) for i in range(2, 40)] + [("b", None), ("b", 5)], "source string, id bigint")
    plan = snapshot.snapshot_ranges(rows, 10, by=("source",)).orderBy("source", "chunk")
    assert [tuple(r)[:5] for r in plan.collect()] == [
        ("a", 0, 1, 1, 50), ("a", 1, 2, 11, 10), ("a", 2, 12, 21, 10), ("a", 3, 22, 31, 10), ("a", 4, 32, 39, 8), ("b", 0, 5, 5, 2)
    ]
    assert [r["predicate"] for r in plan.collect()][:2] == ["id < 2 or id is null", "id >= 2 and id < 12"]
    hot = spark.createDataFrame([(i,) for i in [*range(7), *[7] * 50, *range(8, 20)]], "id bigint")
    found = [(r["lo"], r["hi"], r["rows"]) for r in snapshot.snapshot_ranges(hot, 10).orderBy("chunk").collect()]
    assert found == [(0, 6, 7), (7, 10, 53), (11, 19, 9)]
    assert snapshot.snapshot_ranges(rows.limit(0), 10).count() == 0


def test_throttled_at_the_time(spark):
    """A host is held from the measurement that pauses it to the one that does not; invalid ones change nothing."""
    ms = 1_000_000
    beats = [("h0", 10, 2000), ("h0", 20, -5), ("h0", 30, 100), ("h1", 10, 1500), ("h1", 25, 1501), ("h0", 40, 3000), ("h0", 40, 10)]
    frame = spark.createDataFrame([(h, i, t - d * ms, t) for i, (h, t, d) in enumerate(beats)], "host string, seq bigint, heartbeat_ns bigint, observed_ns bigint")
    places = spark.createDataFrame([("shard0", "d", "h0", 1), ("shard1", "d", "h1", 1), ("shard2", "d", "h2", 1)], "alias string, db string, host string, port bigint")
    ops = spark.createDataFrame([(s, t) for s in (0, 1, 2) for t in (9, 10, 29, 30, 39, 40)], "shard int, t bigint")
    got = lag.throttle_as_of(ops, places, frame, replace(ITEMS, shard_num=3), "t")
    held = {(r["shard"], r["t"]) for r in got.where("held").collect()}
    assert held == {(0, 10), (0, 29), (0, 40), (1, 29), (1, 30), (1, 39), (1, 40)}


@pytest.mark.parametrize("seed", range(4))
def test_chunks_read_while_the_log_goes_on(spark, seed):
    """Whatever the marks and moments of reading, the result is that of applying the whole log to the first state."""
    rnd = random.Random(seed)
    operations, start = random_operations(60 + seed, 120, 12), {k: -k for k in range(0, 20, 2)}
    chunks, marks = [], []
    for c in range(3):
        low = rnd.randrange(1, 110)
        seen = rnd.randrange(low, 120)
        # Reading sees whole events only: the operations of one position belong together.
        while seen < 120 and operations[seen][:2] == operations[seen - 1][:2]:
            seen += 1
        chunks += [(c, k, v) for k, v in sequential(operations[:seen], start) if k % 3 == c]
        marks.append((c, operations[low - 1][0], operations[low - 1][1] * 10 + operations[low - 1][2]))
    read = spark.createDataFrame(chunks, "chunk int, k bigint, v int")
    lows = spark.createDataFrame(marks, "chunk int, f string, p bigint").select("chunk", position(F.col("f"), F.col("p")).alias("low"))
    first = min(marks, key=lambda m: m[1:])[1:]
    log = events_frame(spark, operations).where(position(F.col("log_file"), F.col("log_pos")) > F.struct(F.lit(first[0]), F.lit(first[1]).cast("bigint")))
    assert rows_of(bootstrap_chunks(read, lows, log, ITEMS), "k", "v") == sequential(operations, start)


def test_chunks_without_a_mark_are_refused(spark, tmp_path):
    read = spark.createDataFrame([(0, 1, 1), (9, 2, 2), (0, None, 3)], "chunk int, k bigint, v int")
    lows = spark.createDataFrame([(0,)], "chunk int").select("chunk", position(F.lit("f"), F.lit(1)).alias("low"))
    log = events_frame(spark, [("f", 5, 0, "U", 1, 7)])
    with pytest.raises(PySparkException, match="no mark for chunk 9"):
        bootstrap_chunks(read.where("k is not null"), lows, log, ITEMS).collect()
    path = str(tmp_path / "refused")
    assert rows_of(bootstrap_chunks(read, lows, log, ITEMS, rejects=path), "k", "v") == [(1, 7)]
    assert rows_of(spark.read.option("mergeSchema", "true").parquet(f"{path}/snapshot"), "v") == [(2,), (3,)]
