"""Inputs in the engine's shapes, derived from the given tables.

Each text is valid in Spark and in DuckDB. Names in braces are tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reshard.functions.hashing import unsigned_bits
from reshard.spec import ColumnSpec, TableSpec

# Keys are lifted by 2^48 because the shard slot starts at that bit.
LIFT = 281474976710656

SNAPSHOT = f"""
SELECT o_orderkey AS id, (o_custkey % 97) * {LIFT} + o_custkey AS user_id, o_orderkey % 7 AS recording_id,
  CAST(1400000000 + (o_orderkey * 7) % 1000000 AS INT) AS created_on,
  CASE WHEN o_custkey % 2 = 0 THEN 'db-a' ELSE 'db-b' END AS source
FROM {{orders}}
"""

_FILE_NUMBER = "CAST(CAST((event_id - event_id % 1000) / 1000 + 17 AS BIGINT) AS STRING)"
_LOG_FILE = f"'mysql-bin.' || lpad({_FILE_NUMBER}, CAST(greatest(5, length({_FILE_NUMBER})) AS INT), '0')"

# Flat change log: two rows per event, keys before and after the change.
CHANGES = f"""
SELECT event_id AS seq, CASE WHEN event_id % 2 = 0 THEN 'db-a' ELSE 'db-b' END AS source, {_LOG_FILE} AS log_file,
  CAST(120 + (event_id % 1000 - event_id % 4) * 73 AS BIGINT) AS log_pos,
  CAST((event_id % 4 - event_id % 2) / 2 AS INT) AS row_idx, g,
  CASE g % 3 WHEN 0 THEN 'Shard_0' WHEN 1 THEN 'shard_1' ELSE 'archive' END AS database_name,
  CASE WHEN g % 11 = 0 THEN 'comment' WHEN g % 2 = 0 THEN 'User_Recording_Like' ELSE 'user_recording_like' END
    AS table_name,
  CASE g % 5 WHEN 0 THEN 'WriteRowsEventV2' WHEN 1 THEN 'UpdateRowsEventV2' WHEN 2 THEN 'DeleteRowsEventV2'
    WHEN 3 THEN 'WriteRowsEventV1' ELSE 'UpdateRowsEventV1' END AS event_name,
  (user_id % 97) * {LIFT} + user_id AS user_id,
  CASE WHEN event_type = 'purchase' THEN ((user_id + 1) % 97) * {LIFT} + user_id + 1
    ELSE (user_id % 97) * {LIFT} + user_id END AS new_user_id,
  event_id % 7 AS recording_id, CAST(1400000000 + event_id AS INT) AS created_on
FROM (SELECT event_id, user_id, event_type, CAST((event_id - event_id % 4) / 4 AS BIGINT) AS g FROM {{events}}) e
"""

# The log with a missing file number after every seventh and an earlier offset in every tenth event. Some events are in
# files with a number about to grow by a digit, with a detached name, or without a number.
_GAPPED = "CAST(n + CAST((n - n % 7) / 7 AS BIGINT) AS STRING)"
_NUMBERED = f"'mysql-bin.' || lpad({_GAPPED}, CAST(greatest(5, length({_GAPPED})) AS INT), '0')"
AUDITED = f"""
SELECT source, seq, CASE g % 10 WHEN 6 THEN 'short.' || CAST(9 + n % 2 * 90 AS STRING)
    WHEN 7 THEN '//' || {_NUMBERED} || ':' || CAST(n AS STRING) WHEN 8 THEN 'archive' || CAST(n AS STRING)
    ELSE {_NUMBERED} END AS log_file,
  CASE WHEN g % 10 = 9 THEN log_pos - 2000 ELSE log_pos END AS log_pos
FROM (SELECT *, CAST(substr(log_file, 11) AS BIGINT) AS n FROM ({CHANGES}) c) m
"""

# Log with rotations and statements between the rows events.
RAW = f"""
SELECT CASE WHEN event_id % 2 = 0 THEN 'db-a' ELSE 'db-b' END AS source, event_id AS seq,
  CASE WHEN event_id % 1000 < 2 THEN 'RotateEvent' WHEN event_type = 'error' THEN 'QueryEvent'
    ELSE 'WriteRowsEventV2' END AS event_name,
  CAST(120 + (event_id % 1000) * 73 AS BIGINT) AS log_pos,
  CASE WHEN event_id % 1000 < 2 THEN {_LOG_FILE} END AS next_log_name
FROM {{events}}
"""

# The same log with some events, rotations among them, very far behind the others.
RAW_FAR = f"""
SELECT source, CASE WHEN seq % 3001 < 2 THEN seq * 1000000007 ELSE seq END AS seq, event_name, log_pos, next_log_name FROM ({RAW}) r
"""

# The snapshot with ids that leave large holes.
SPARSE = f"""
SELECT source, CASE WHEN id % 997 < 5 THEN id * 1000000007 ELSE id END AS id FROM ({SNAPSHOT}) s
"""

# Runs of the log that were applied, by their borders: every seventh is missing, others reach back into the run before.
RUNS = f"""
SELECT source, run, log_file AS upto_file, log_pos AS upto_pos,
  coalesce(CASE WHEN run % 7 = 5 THEN lag(log_file, 2) OVER (PARTITION BY source ORDER BY run)
    ELSE lag(log_file) OVER (PARTITION BY source ORDER BY run) END, '') AS after_file,
  coalesce(CASE WHEN run % 7 = 5 THEN lag(log_pos, 2) OVER (PARTITION BY source ORDER BY run)
    ELSE lag(log_pos) OVER (PARTITION BY source ORDER BY run) END, 0) AS after_pos
FROM (SELECT source, run, max_by(log_file, seq) AS log_file, max_by(log_pos, seq) AS log_pos
  FROM (SELECT *, CAST((seq - seq % 40) / 40 AS BIGINT) AS run FROM ({CHANGES}) c) d GROUP BY source, run) e
"""
APPLIED_RUNS = f"SELECT * FROM ({RUNS}) r WHERE run % 7 <> 3"

HEARTBEATS = """
SELECT 'host' || CAST(user_id % 8 AS STRING) AS host, event_id AS seq,
  1700000000000000000 + event_id * 500000000 AS heartbeat_ns,
  1700000000000000000 + event_id * 500000000 + (CAST(floor(value * 15) AS BIGINT) - 50) * 1000000 AS observed_ns
FROM {events}
"""

KEYS = f"""
SELECT event_id AS id, user_id * {LIFT} + event_id AS k_int, -(user_id * {LIFT} + event_id) AS k_neg,
  CAST(user_id * {LIFT} + event_id AS STRING) AS k_num, event_type || '-' || CAST(event_id AS STRING) AS k_txt
FROM {{events}}
"""

DIRECTORY_ENTRIES = """
SELECT CAST(i AS INT) AS entry_no,
  'shard' || CAST(i AS STRING) || ':shard_' || CAST(i AS STRING) || '@host' || CAST(i % 8 AS STRING)
  || CASE WHEN i % 4 = 0 THEN '@3307' ELSE '' END AS entry
FROM (SELECT DISTINCT o_orderkey % 32 AS i FROM {orders}) t
"""

# One entry per customer, with comments, broken entries and aliases that occur twice.
MIXED_ENTRIES = """
SELECT c_custkey AS entry_no,
  CASE c_custkey % 11 WHEN 0 THEN '# ' WHEN 1 THEN '#' ELSE '' END
  || 'c' || CAST(c_custkey - c_custkey % 3 AS STRING)
  || CASE WHEN c_custkey % 13 = 0 THEN '' WHEN c_custkey % 13 = 1 THEN ':x:' ELSE ':' END
  || 'db_' || CAST(c_custkey AS STRING)
  || CASE WHEN c_custkey % 17 = 0 THEN '' ELSE '@host' || CAST(c_nationkey AS STRING) END
  || CASE c_custkey % 5 WHEN 0 THEN '@3307' WHEN 1 THEN '@port' ELSE '' END AS entry
FROM {customer}
"""

# A saved position per source: about the middle of the log.
POSITIONS = f"""
SELECT source, max_by(log_file, seq) AS log_file, max_by(log_pos, seq) AS log_pos
FROM ({CHANGES}) c WHERE 2 * seq <= (SELECT max(event_id) FROM {{events}}) GROUP BY source
"""

# Log events of four sources with one position each, for choosing where to start.
FOUR_SOURCES = f"""
SELECT 'db-' || CAST(event_id % 4 AS STRING) AS source, {_LOG_FILE} AS log_file,
  CAST(120 + (event_id % 1000) * 73 AS BIGINT) AS log_pos, event_id AS seq
FROM {{events}}
"""

STATEMENTS = """
SELECT event_id AS id,
  CASE event_id % 12 WHEN 0 THEN 'insert into ' || event_type WHEN 1 THEN 'UPDATE ' || event_type
    WHEN 2 THEN 'Delete from ' || event_type WHEN 3 THEN ' insert into ' || event_type
    WHEN 4 THEN 'REPLACE INTO ' || event_type WHEN 5 THEN 'WriteRowsEventV2' WHEN 6 THEN 'UpdateRowsEventV1'
    WHEN 7 THEN 'DeleteRowsEventV0' WHEN 8 THEN 'writerowsEventV2' WHEN 9 THEN event_type
    WHEN 10 THEN 'insertion ' || event_type ELSE 'WriteRows ' || event_type END AS description
FROM {events}
"""


def _likes(**changed) -> TableSpec:
    options = dict(
        table="user_recording_like",
        columns=(
            ColumnSpec("user_id", 2),
            ColumnSpec("recording_id", 3),
            ColumnSpec("created_on", 1, "int"),
        ),
        key=("user_id", "recording_id"),
        database_pattern="shard_*",
        shard_filter=lambda shard: shard != 5,
    )
    return TableSpec(**{**options, **changed})


# The sample table: rows of shard 5 are not wanted.
LIKES = _likes()
ALL_LIKES = _likes(shard_filter=None)
LOGGED_LIKES = _likes(source="source")
STAYING_LIKES = _likes(source="source", on_key_move="same_shard_only")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def build(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    used = [n for n in ("orders", "events", "customer", "lineitem", "supplier", "part") if "{" + n + "}" in text]
    return spark.sql(text, **{n: table(spark, sf_dir, n) for n in used})


def keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of ``KEYS`` for user ids of any size. Its SQL has no result from user 32768 on, where the lifted key leaves 63 bits:
    there a number is the low 64 bits of the key, as hashes are, and the text has all its digits."""
    lifted = F.col("user_id").cast("decimal(20,0)") * F.lit(LIFT).cast("decimal(15,0)") + F.col("event_id").cast("decimal(20,0)")
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", lifted.alias("k"))
    return rows.select(
        F.col("event_id").alias("id"), unsigned_bits(F.col("k")).alias("k_int"), unsigned_bits(-F.col("k")).alias("k_neg"),
        F.col("k").cast("string").alias("k_num"), F.concat("event_type", F.lit("-"), F.col("event_id").cast("string")).alias("k_txt"),
    )


def _events_of(changes: DataFrame, element: str) -> DataFrame:
    """Pack change rows into one event per position, with positional images."""
    before = F.array(F.col("seq"), F.col("created_on").cast("bigint"), F.col("user_id"), F.col("recording_id"))
    after = F.array(F.col("seq"), F.col("created_on").cast("bigint"), F.col("new_user_id"), F.col("recording_id"))
    images = (
        F.when(F.col("event_name").startswith("Update"), F.array(before, after))
        .when(F.col("event_name").startswith("Delete"), F.array(before))
        .otherwise(F.array(after))
    )
    packed = changes.groupBy("source", "log_file", "log_pos", "event_name", "database_name", "table_name").agg(
        F.min("seq").alias("seq"),
        F.array_sort(F.collect_list(F.struct("row_idx", images.alias("images")))).alias("_parts"),
    )
    rows = F.flatten(F.transform("_parts", lambda part: part["images"])).cast(f"array<array<{element}>>")
    return packed.select(
        "source", "seq", "log_file", "log_pos", "event_name", F.lit(None).cast("string").alias("next_log_name"),
        "database_name", "table_name", rows.alias("rows"),
    )


def row_events(spark: SparkSession, sf_dir: str, element: str = "bigint") -> DataFrame:
    """Raw rows events; an event has two changes, so packing them is bounded."""
    return _events_of(build(spark, sf_dir, CHANGES), element)


def rotating_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows events that do not know their log file, and the rotations that tell it; ``part`` keeps a log file together."""
    events = row_events(spark, sf_dir)
    part = (F.regexp_extract("log_file", r"([0-9]+)$", 1).cast("bigint") % 4).alias("part")
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in events.dtypes]
    moved = {
        "source": F.col("source"), "seq": F.col("first") - 1, "log_pos": F.lit(4).cast("bigint"),
        "event_name": F.lit("RotateEvent"), "next_log_name": F.col("log_file"),
    }
    files = events.groupBy("source", "log_file").agg(F.min("seq").alias("first"))
    turns = files.select(*[moved[n].alias(n) if n in moved else c for n, c in zip(events.columns, nothing)], part)
    return events.select("*", part).withColumn("log_file", F.lit(None).cast("string")).unionByName(turns)


def faulty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows events with unknown kinds, unpaired update images and missing keys."""
    changes = build(spark, sf_dir, CHANGES)
    changes = changes.withColumns(
        {
            "recording_id": F.when(F.col("seq") % 19 != 7, F.col("recording_id")),
            "event_name": F.when(F.col("g") % 13 == 5, "PartialRowsEvent").otherwise(F.col("event_name")),
        }
    )
    events = _events_of(changes, "bigint")
    group = F.floor(F.col("seq") / 4)
    unpaired = F.col("event_name").startswith("Update") & (group % 17 == 3)
    return events.withColumn(
        "rows", F.when(unpaired, F.slice("rows", F.lit(1), F.size("rows") - 1)).otherwise(F.col("rows"))
    )
