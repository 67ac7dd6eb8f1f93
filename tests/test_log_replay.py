"""A hand-written log of a small keyed table, replayed in one go, in parts, and against a snapshot."""

import pytest
from pyspark.sql import functions as F

from helpers import rows_of
from reshard.operators.changes import accepted, count_rejects, expand_row_images, project_changes, skip_applied
from reshard.operators.folding import change_facts, state_rows
from reshard.operators.routing import key_move_audit, route_changes, split_key_moves
from reshard.plans.log_apply import apply_log, bootstrap_state, single_key_operations, typed_changes
from reshard.functions.positions import position
from reshard.sources.changelog import decode_messages, event_schema
from reshard.spec import SAME_SHARD_ONLY, ColumnSpec, TableSpec

SAMPLE = TableSpec(
    table="samplet",
    columns=(ColumnSpec("id", 0, "int"), ColumnSpec("license", 1, "int"), ColumnSpec("name", 2, "string")),
    key=("id",),
    database_pattern="test",
)

W, U, D = "WriteRowsEventV2", "UpdateRowsEventV2", "DeleteRowsEventV2"
LOG = [
    (485, W, [(1, 1, "a")]),
    (713, W, [(2, 2, "extended"), (3, 3, "extended")]),
    (926, W, [(4, 4, "transaction")]),
    (1036, W, [(5, 5, "transaction")]),
    (1146, W, [(6, 6, "transaction")]),
    (1352, U, [(5, 5, "transaction"), (5, 5, "update")]),
    (1549, D, [(2, 2, "extended")]),
    (1612, U, [(4, 4, "transaction"), (2, 4, "replaced 2,4")]),
    (1815, W, [(7, 7, "7")]),
    (2018, W, [(8, 8, "8")]),
    (2220, D, [(7, 7, "7"), (8, 8, "8")]),
    (2423, W, [(9, 9, "9")]),
    (2631, U, [(9, 9, "9"), (9, 9, "update 9")]),
    (2725, D, [(3, 3, "extended")]),
    (2826, W, [(10, 10, "10")]),
]
END = [(1, 1, "a"), (2, 4, "replaced 2,4"), (5, 5, "update"), (6, 6, "transaction"), (9, 9, "update 9"), (10, 10, "10")]
MORE = [(3000, U, [(5, 5, "update"), (5, 5, "update 5,6"), (6, 6, "transaction"), (6, 6, "update 5,6")])]


def log(spark, entries, table="samplet"):
    rows = [
        ("db", pos, "mysql-bin.000052", pos, kind, None, "test", table, [[None if v is None else str(v) for v in image] for image in images])
        for pos, kind, images in entries
    ]
    return spark.createDataFrame(rows, event_schema("string"))


def state(spark, events, spec=SAMPLE):
    return rows_of(state_rows(change_facts(single_key_operations(events, spec), spec), spec), "id", "license", "name")


def test_replay(spark):
    assert state(spark, log(spark, LOG)) == END


def test_replay_with_rows_of_one_event_in_order(spark):
    after = dict((r[0], r) for r in END)
    after[5], after[6] = (5, 5, "update 5,6"), (6, 6, "update 5,6")
    assert state(spark, log(spark, LOG + MORE)) == sorted(after.values())


def test_other_tables_are_not_touched(spark):
    other = log(spark, [(1, "StrangeEvent", [(1, 1, "x")])], "other")
    assert state(spark, log(spark, LOG).unionByName(other)) == END


def test_apply_from_any_point(spark):
    """Changes behind a position, applied to the state at that position, give the end state."""
    for cut in (1146, 1549, 1612, 2220):
        early = log(spark, [e for e in LOG if e[0] <= cut])
        target = state_rows(change_facts(single_key_operations(early, SAMPLE), SAMPLE), SAMPLE)
        applied = spark.createDataFrame([("db", "mysql-bin.000052", cut)], "source string, log_file string, log_pos bigint")
        rest = skip_applied(log(spark, LOG), applied)
        assert rows_of(apply_log(target, rest, SAMPLE), "id", "license", "name") == END


def test_bootstrap_may_start_early(spark):
    """The snapshot already holds later rows; applying older changes again does no harm."""
    early = [e for e in LOG if e[0] <= 2018]
    snapshot = state_rows(change_facts(single_key_operations(log(spark, early), SAMPLE), SAMPLE), SAMPLE)
    spec = TableSpec(**{**SAMPLE.__dict__, "snapshot_id": "license"})
    for start in (4, 1146, 2018):
        starts = spark.createDataFrame([("db",)], "source string").select(
            "source", position(F.lit("mysql-bin.000052"), F.lit(start)).alias("start")
        )
        found = bootstrap_state(snapshot.drop("shard"), log(spark, LOG), starts, spec)
        assert rows_of(found, "id", "license", "name") == END


def test_json_messages(spark):
    messages = log(spark, LOG).select(F.to_json(F.struct("*")).cast("binary").alias("value"))
    assert state(spark, decode_messages(messages, image_type="string")) == END


def test_rejects_are_kept_with_their_reason(spark):
    events = log(
        spark,
        [
            (1, "PartialUpdate", [(1, 1, "x"), (2, 2, "x")]),
            (2, U, [(1, 1, "x"), (1, 1, "y"), (2, 2, "x")]),
            (3, W, [(None, 1, "x"), (1, 1, "x")]),
            (4, U, [(1, 1, "x"), (None, 1, "x")]),
            (5, D, [(None, 1, "x")]),
            (6, W, []),
        ],
    )
    changes = typed_changes(events, SAMPLE)
    assert rows_of(count_rejects(changes), "reason", "rows") == [("null_key", 3), ("odd_update_images", 1), ("unknown_dml", 1)]
    assert accepted(changes).count() == 1


def test_short_images_are_rejected(spark):
    events = log(spark, [(1, W, [("1", "1", "x")])]).withColumn("rows", F.array(F.array().cast("array<string>")))
    assert rows_of(count_rejects(typed_changes(events, SAMPLE)), "reason", "rows") == [("null_key", 1)]


def test_statements_without_rows_are_ignored(spark):
    events = log(spark, [(1, "QueryEvent", [])]).withColumn("rows", F.lit(None).cast("array<array<string>>"))
    assert typed_changes(events, SAMPLE).count() == 0


def test_images_are_paired(spark):
    rows = expand_row_images(log(spark, MORE)).orderBy("row_idx").collect()
    assert [(r["row_idx"], r["before"][2], r["after"][2]) for r in rows] == [
        (0, "update", "update 5,6"), (1, "transaction", "update 5,6")
    ]


LIFT = 2**48
MOVING = TableSpec(table="t", columns=(ColumnSpec("k", 0), ColumnSpec("v", 1, "int")), key=("k",))


def moves(spark):
    rows = [
        ("db", 1, "f", 1, U, None, "d", "t", [[LIFT, 1], [2 * LIFT, 2]]),
        ("db", 2, "f", 2, U, None, "d", "t", [[LIFT + 1, 3], [LIFT + 2, 4]]),
        ("db", 3, "f", 3, U, None, "d", "t", [[LIFT + 5, 3], [LIFT + 5, 4]]),
    ]
    return accepted(project_changes(expand_row_images(spark.createDataFrame(rows, event_schema())), MOVING))


def test_key_moves(spark):
    split = rows_of(split_key_moves(moves(spark), MOVING), "pos.log_pos", "pos.sub", "op", "shard", "k")
    assert split == [
        (1, 0, "D", 1, LIFT), (1, 1, "I", 2, 2 * LIFT),
        (2, 0, "D", 1, LIFT + 1), (2, 1, "I", 1, LIFT + 2),
        (3, 0, "U", 1, LIFT + 5),
    ]
    routed = rows_of(route_changes(moves(spark), MOVING), "pos.log_pos", "op", "shard", "k")
    assert routed == [(1, "U", 2, LIFT), (2, "U", 1, LIFT + 1), (3, "U", 1, LIFT + 5)]
    assert rows_of(key_move_audit(moves(spark), MOVING), "old_shard", "new_shard", "moves") == [(1, 2, 1)]


def test_moves_to_other_shards_can_be_left_out(spark):
    spec = TableSpec(**{**MOVING.__dict__, "on_key_move": SAME_SHARD_ONLY})
    assert rows_of(split_key_moves(moves(spark), spec), "pos.log_pos", "pos.sub", "op") == [(2, 0, "D"), (2, 1, "I"), (3, 0, "U")]


def test_spec_is_checked():
    with pytest.raises(ValueError):
        TableSpec(table="t", columns=(ColumnSpec("a", 0),), key=("b",))
    with pytest.raises(ValueError):
        TableSpec(table="t", columns=(ColumnSpec("a", 0),), key=("a",), on_key_move="never")
    with pytest.raises(ValueError):
        TableSpec(table="t", columns=(ColumnSpec("a", 0), ColumnSpec("b", 1)), key=("a",), shard_by="b")
