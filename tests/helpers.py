"""Small inputs and a row-by-row model of the sequential apply."""

from __future__ import annotations

import glob
import json
import os
import random
import time

from pyspark.sql import functions as F

from reshard.functions.positions import change_position
from reshard.spec import ColumnSpec, TableSpec

ITEMS = TableSpec(
    table="items",
    columns=(ColumnSpec("k", 0), ColumnSpec("v", 1, "int")),
    key=("k",),
)

IMAGES = "struct<k:bigint,v:int>"


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def random_operations(seed, count, keys):
    """(log_file, log_pos, row_idx, op, key, value), in log order."""
    rnd = random.Random(seed)
    out = []
    for i in range(count):
        out.append((f"bin.{1 + i // 50:05d}", 100 + (i % 50) // 2 * 10, i % 2, rnd.choice("IIUUUD"), rnd.randrange(keys), i))
    return out


def sequential(operations, start=None):
    state = dict(start or {})
    for _, _, _, op, key, value in operations:
        if op == "I" or (op == "U" and key in state):
            state[key] = value
        elif op == "D":
            state.pop(key, None)
    return sorted(state.items())


def operations_frame(spark, operations):
    raw = spark.createDataFrame(
        operations, "log_file string, log_pos bigint, row_idx int, op string, k bigint, v int"
    )
    return raw.select(
        F.lit(0).alias("shard"),
        "k",
        "op",
        change_position(F.col("log_file"), F.col("log_pos"), F.col("row_idx")).alias("pos"),
        F.when(F.col("op") != "D", F.struct("k", "v")).alias("vals"),
    )


def events_frame(spark, operations):
    """The same operations as raw events with one row each."""
    names = {"I": "WriteRowsEventV2", "U": "UpdateRowsEventV2", "D": "DeleteRowsEventV2"}
    rows = []
    for n, (log_file, log_pos, row_idx, op, key, value) in enumerate(operations):
        image = [key, value]
        images = [image, image] if op == "U" else [image]
        rows.append(("src", n, log_file, log_pos * 10 + row_idx, names[op], None, "db", "items", images))
    from reshard.sources.changelog import event_schema

    return spark.createDataFrame(rows, event_schema())


class Recorder:
    """A database connection that writes what it is told to a folder, and fails on its first commit."""

    def __init__(self, folder, shard):
        self.folder, self.shard, self.pending = folder, shard, []

    def cursor(self):
        return self

    def execute(self, sql, args):
        self.pending.append([sql, args])

    def commit(self):
        first = f"{self.folder}/failed-{self.shard}"
        if not os.path.exists(first):
            open(first, "w").close()
            raise ConnectionError("lost")
        with open(f"{self.folder}/{self.shard}-{os.getpid()}-{id(self)}.log", "a") as out:
            out.write(json.dumps([time.time_ns(), self.pending]) + "\n")
        self.pending = []

    def rollback(self):
        self.pending = []

    def close(self):
        pass


def recorded(folder):
    """(shard, statements) of all committed batches, in commit order."""
    batches = []
    for name in glob.glob(f"{folder}/*.log"):
        shard = int(os.path.basename(name).split("-")[0])
        batches += [(*json.loads(line), shard) for line in open(name)]
    return [(shard, statements) for _, statements, shard in sorted(batches)]
