import random

import pytest
from pyspark.sql import functions as F

from helpers import ITEMS, events_frame, operations_frame, random_operations, rows_of, sequential
from reshard.operators.folding import apply_changes, change_facts, compact_changes, fold_facts, state_rows
from reshard.operators.reports import last_position
from reshard.plans.log_apply import single_key_operations
from reshard.sources.changelog import order_files_by_number


@pytest.mark.parametrize("seed", range(3))
def test_equals_sequential_apply(spark, seed):
    operations = random_operations(seed, 600, 80)
    start = {k: -k for k in range(0, 120, 3)}
    target = spark.createDataFrame([(0, k, v) for k, v in start.items()], "shard int, k bigint, v int")
    net = compact_changes(operations_frame(spark, operations), ITEMS)
    assert rows_of(apply_changes(target, net, ITEMS), "k", "v") == sequential(operations, start)
    facts = change_facts(operations_frame(spark, operations), ITEMS)
    assert rows_of(state_rows(facts, ITEMS), "k", "v") == sequential(operations)


@pytest.mark.parametrize("seed", range(3))
def test_any_split_in_any_order(spark, seed):
    """Facts of parts, in shuffled arrival and with a part delivered twice, fold to the sequential state."""
    operations = random_operations(100 + seed, 400, 30)
    rnd = random.Random(seed)
    parts = [[] for _ in range(4)]
    for operation in operations:
        rnd.choice(parts).append(operation)
    parts.append(parts[1])
    rnd.shuffle(parts)
    facts = None
    for part in parts:
        one = change_facts(operations_frame(spark, part), ITEMS)
        facts = one if facts is None else fold_facts(facts.unionByName(one), ITEMS)
    assert rows_of(state_rows(facts, ITEMS), "k", "v") == sequential(operations)


def test_update_of_missing_row_does_nothing(spark):
    ops = [("f", 1, 0, "U", 1, 10), ("f", 2, 0, "D", 2, 0), ("f", 3, 0, "U", 2, 20), ("f", 4, 0, "I", 3, 30), ("f", 5, 0, "U", 3, 31)]
    target = spark.createDataFrame([(0, 2, 2), (0, 4, 4)], "shard int, k bigint, v int")
    net = compact_changes(operations_frame(spark, ops), ITEMS)
    assert rows_of(net, "k", "op") == [(1, "U"), (2, "D"), (3, "I")]
    assert rows_of(apply_changes(target, net, ITEMS), "k", "v") == [(3, 31), (4, 4)]


def test_null_values_survive(spark):
    ops = [("f", 1, 0, "I", 1, 10), ("f", 2, 0, "U", 1, None)]
    net = compact_changes(operations_frame(spark, ops), ITEMS)
    target = spark.createDataFrame([(0, 9, None)], "shard int, k bigint, v int")
    found = apply_changes(target, net, ITEMS).select("k", "v").collect()
    assert sorted((r[0], r[1]) for r in found) == [(1, None), (9, None)]


def test_hot_key_is_folded_before_the_shuffle(spark):
    ops = operations_frame(spark, random_operations(5, 50, 3))
    plan = compact_changes(ops.withColumn("shard", F.col("k").cast("int")), ITEMS)._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange"):]
    assert "partial_max" in before_shuffle


def test_files_can_be_ordered_by_number(spark):
    """By name the tenth-power file comes first; padded names follow the numbers."""
    log = [("bin.999999", 10, 0, "I", 1, 1), ("bin.1000000", 10, 0, "U", 1, 2), ("bin.1000001", 10, 0, "D", 2, 0)]
    events = order_files_by_number(events_frame(spark, log))
    facts = change_facts(single_key_operations(events, ITEMS), ITEMS)
    assert rows_of(state_rows(facts, ITEMS), "k", "v") == [(1, 2)]
    assert rows_of(last_position(events), "log_file") == [("bin.00000000000001000001",)]
    assert rows_of(last_position(events_frame(spark, log)), "log_file") == [("bin.999999",)]
