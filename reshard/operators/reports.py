"""Counts, progress, positions and readable statements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reshard.functions.positions import position
from reshard.operators.ordered import with_running_total
from reshard.operators.routing import INSERT_IGNORE, REMOVE, REVISE, UPSERT
from reshard.session import broadcast_if_small
from reshard.spec import TableSpec


def shard_counts(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows per shard, with 0 for shards that got none."""
    shards = rows.sparkSession.range(spec.table_count).select(F.col("id").cast("int").alias("shard"))
    counts = rows.groupBy("shard").agg(F.count("*").alias("_rows"))
    return shards.join(counts, "shard", "left").select("shard", F.coalesce("_rows", F.lit(0)).alias("rows"))


def apply_progress(operations: DataFrame, applied: DataFrame) -> DataFrame:
    """Per shard: operations executed (up to the applied position), pushed, and the percentage."""
    last = broadcast_if_small(applied.select("source", position(F.col("log_file"), F.col("log_pos")).alias("_applied")))
    done = position(F.col("pos.log_file"), F.col("pos.log_pos")) <= F.col("_applied")
    return (
        operations.join(last, "source", "left")
        .groupBy("shard")
        .agg(F.count_if(F.coalesce(done, F.lit(False))).alias("executed"), F.count("*").alias("pushed"))
        .withColumn("percent", F.col("executed") / F.col("pushed") * F.lit(100.0))
    )


def last_position(changes: DataFrame) -> DataFrame:
    """Newest position per source. Folds per file first: a hash aggregation, whatever the source's size."""
    per_file = changes.groupBy("source", "log_file").agg(F.max("log_pos").alias("log_pos"))
    newest = per_file.groupBy("source").agg(F.max(F.struct("log_file", "log_pos")).alias("_last"))
    return newest.select("source", "_last.log_file", "_last.log_pos")


def rows_processed(chunks: DataFrame, partitions: int | None = None) -> DataFrame:
    """Running total of rows per source over a chunk plan (one row per chunk)."""
    plan = chunks.select("source", "chunk", "rows")
    return with_running_total(plan, ["source"], "chunk", "rows", "rows_processed", partitions)


def _where(spec: TableSpec) -> str:
    return " and ".join(f"{k}=?" for k in spec.key)


def insert_segment(spec: TableSpec) -> str:
    """Placeholders of one row; repeated for multi-row statements."""
    return "(" + ", ".join("?" for _ in spec.names) + ")"


def statement(op: str, spec: TableSpec, rows: int = 1) -> str:
    """Parameterised SQL text of an operation; inserts can carry several rows."""
    if op == REMOVE:
        return f"delete from {spec.table} where {_where(spec)}"
    if op == REVISE:
        return f"update {spec.table} set {', '.join(f'{n}=?' for n in spec.names)} where {_where(spec)}"
    verb = {UPSERT: "replace into", INSERT_IGNORE: "insert ignore into"}[op]
    return f"{verb} {spec.table} ({', '.join(spec.names)}) values {', '.join([insert_segment(spec)] * rows)}"


def _json(values: list[Column], spec: TableSpec) -> Column:
    """A JSON list of values of different types. Text is also made safe for HTML, as usual in such logs."""
    parts = [F.regexp_replace(F.to_json(F.array(v), {"ignoreNullFields": "false"}), r"^\[|\]$", "") for v in values]
    text = F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))
    if any(c.type == "string" for c in spec.columns):
        for char in "<>&\u2028\u2029":
            text = F.replace(text, F.lit(char), F.lit(f"\\u{ord(char):04x}"))
    return text


def render_statements(operations: DataFrame, spec: TableSpec) -> DataFrame:
    """Operation -> statement text, JSON arguments, and both joined by an arrow."""
    image = [F.col("vals").getField(n) for n in spec.names]
    old_key = [F.col(k) for k in spec.key]
    sql = F.when(F.col("op") == REMOVE, statement(REMOVE, spec))
    args = F.when(F.col("op") == REMOVE, _json(old_key, spec))
    for op, values in ((REVISE, image + old_key), (UPSERT, image), (INSERT_IGNORE, image)):
        sql = sql.when(F.col("op") == op, statement(op, spec))
        args = args.when(F.col("op") == op, _json(values, spec))
    rendered = operations.withColumns({"sql": sql, "args": args})
    return rendered.withColumn("rendered", F.concat("sql", F.lit(" --> "), "args"))


def snapshot_operations(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Routed snapshot rows as insert-ignore operations."""
    return rows.select("*", F.lit(INSERT_IGNORE).alias("op"), F.struct(*spec.names).alias("vals"))
