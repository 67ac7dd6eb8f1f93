"""The same results in SQL, written another way than the engine computes them."""

from __future__ import annotations

from checks import fixtures as fx

_TABLES = {n: n for n in ("orders", "events", "customer")}


def _sql(text: str) -> str:
    return text.format(**_TABLES)


SNAP = _sql(fx.SNAPSHOT)
CHG = _sql(fx.CHANGES)
RAW = _sql(fx.RAW)
HB = _sql(fx.HEARTBEATS)
KEYS = _sql(fx.KEYS)
ENTRIES = _sql(fx.DIRECTORY_ENTRIES)
MIXED = _sql(fx.MIXED_ENTRIES)
POSITIONS = _sql(fx.POSITIONS)
FOUR = _sql(fx.FOUR_SOURCES)
STATEMENTS = _sql(fx.STATEMENTS)
AUDITED = _sql(fx.AUDITED)
RAW_FAR = _sql(fx.RAW_FAR)
SPARSE = _sql(fx.SPARSE)
APPLIED_RUNS = _sql(fx.APPLIED_RUNS)


def _slot(key: str) -> str:
    """Slot of a signed key, by division of the unsigned value."""
    unsigned = f"(CASE WHEN {key} < 0 THEN CAST({key} AS HUGEINT) + 18446744073709551616 ELSE CAST({key} AS HUGEINT) END)"
    return f"CAST(({unsigned} // {fx.LIFT}) % 4096 AS INTEGER)"


def _unsigned(key: str) -> str:
    return f"(CASE WHEN {key} < 0 THEN CAST({key} AS HUGEINT) + 18446744073709551616 ELSE CAST({key} AS HUGEINT) END)"


def _shard(key: str) -> str:
    return f"CAST({_slot(key)} % 32 AS INTEGER)"


# First row per key in id order, shard 5 dropped.
LOADED = f"""
SELECT shard, user_id, recording_id, created_on, source FROM (
  SELECT *, {_shard('user_id')} AS shard, row_number() OVER (PARTITION BY user_id, recording_id ORDER BY id) AS rn
  FROM ({SNAP}) s) t
WHERE rn = 1 AND shard <> 5
"""

DML = """CASE substr(event_name, 1, 5) WHEN 'Write' THEN 'Insert' WHEN 'Updat' THEN 'Update' WHEN 'Delet' THEN 'Delete' END"""

MATCHED = f"""
SELECT *, {DML} AS dml FROM ({CHG}) c
WHERE substr(lower(database_name), 1, 6) = 'shard_' AND lower(table_name) = 'user_recording_like'
"""

# One operation per change; the key is the one the operation looks for.
ROUTED = f"""
SELECT source, log_file, log_pos, row_idx, CAST(0 AS INTEGER) AS sub,
  CASE dml WHEN 'Insert' THEN 'I' WHEN 'Update' THEN 'U' ELSE 'D' END AS op,
  CASE WHEN dml = 'Delete' THEN {_shard('user_id')} ELSE {_shard('new_user_id')} END AS shard,
  CASE WHEN dml = 'Insert' THEN new_user_id ELSE user_id END AS user_id, recording_id,
  CASE WHEN dml <> 'Delete' THEN new_user_id END AS new_user_id,
  CASE WHEN dml <> 'Delete' THEN created_on END AS created_on
FROM ({MATCHED}) m
"""

# Key moves as a removal and an insertion.
OPS = f"""
SELECT * FROM (
  SELECT source, log_file, log_pos, row_idx, CAST(0 AS INTEGER) AS sub, 'I' AS op, {_shard('new_user_id')} AS shard,
    new_user_id AS user_id, recording_id, new_user_id, created_on FROM ({MATCHED}) m WHERE dml = 'Insert'
  UNION ALL
  SELECT source, log_file, log_pos, row_idx, 0, 'D', {_shard('user_id')}, user_id, recording_id, NULL, NULL
    FROM ({MATCHED}) m WHERE dml = 'Delete' OR (dml = 'Update' AND user_id <> new_user_id)
  UNION ALL
  SELECT source, log_file, log_pos, row_idx, 1, 'I', {_shard('new_user_id')}, new_user_id, recording_id, new_user_id,
    created_on FROM ({MATCHED}) m WHERE dml = 'Update' AND user_id <> new_user_id
  UNION ALL
  SELECT source, log_file, log_pos, row_idx, 0, 'U', {_shard('user_id')}, user_id, recording_id, new_user_id, created_on
    FROM ({MATCHED}) m WHERE dml = 'Update' AND user_id = new_user_id) o
WHERE shard <> 5
"""

_ORDER = "log_file DESC, log_pos DESC, row_idx DESC, sub DESC"
_LATEST = f"row_number() OVER (PARTITION BY source, shard, user_id, recording_id ORDER BY {_ORDER})"


def _net(ops: str) -> str:
    return f"""
SELECT source, shard, user_id, recording_id, coalesce(b.op, 'U') AS op,
  CASE WHEN coalesce(b.op, 'U') <> 'D' THEN i.created_on END AS created_on, n.log_file, n.log_pos, n.row_idx, n.sub
FROM (SELECT * FROM (SELECT *, {_LATEST} AS rn FROM ({ops}) o) WHERE rn = 1) n
LEFT JOIN (SELECT * FROM (SELECT *, {_LATEST} AS rn FROM ({ops}) o WHERE op <> 'U') WHERE rn = 1) b
  USING (source, shard, user_id, recording_id)
LEFT JOIN (SELECT * FROM (SELECT *, {_LATEST} AS rn FROM ({ops}) o WHERE op <> 'D') WHERE rn = 1) i
  USING (source, shard, user_id, recording_id)
"""


def _merged(target: str, net: str) -> str:
    return f"""
SELECT source, shard, user_id, recording_id, created_on FROM ({target}) t
WHERE NOT EXISTS (SELECT 1 FROM ({net}) n WHERE n.source = t.source AND n.user_id = t.user_id AND n.recording_id = t.recording_id)
UNION ALL
SELECT source, shard, user_id, recording_id, created_on FROM ({net}) n WHERE op = 'I'
UNION ALL
SELECT n.source, n.shard, n.user_id, n.recording_id, n.created_on FROM ({net}) n WHERE op = 'U'
  AND EXISTS (SELECT 1 FROM ({target}) t WHERE n.source = t.source AND n.user_id = t.user_id AND n.recording_id = t.recording_id)
"""


OPS_BEHIND = f"""
SELECT o.* FROM ({OPS}) o JOIN ({POSITIONS}) p ON o.source = p.source
WHERE o.log_file > p.log_file OR (o.log_file = p.log_file AND o.log_pos > p.log_pos)
"""

OPS_PARTLY_BEHIND = f"""
SELECT o.* FROM ({OPS}) o LEFT JOIN ({POSITIONS}) p ON o.source = p.source AND o.source = 'db-a'
WHERE p.source IS NULL OR o.log_file > p.log_file OR (o.log_file = p.log_file AND o.log_pos > p.log_pos)
"""

# First entry per alias, taken apart by position of the separators.
_ALIASES = f"""
SELECT entry_no, split_part(entry, ':', 1) AS alias, split_part(entry, ':', 2) AS place,
  row_number() OVER (PARTITION BY split_part(entry, ':', 1) ORDER BY entry_no) AS rn
FROM ({MIXED}) e WHERE left(entry, 1) <> '#' AND length(entry) - length(replace(entry, ':', '')) = 1
"""

DIRECTORY = f"""
SELECT split_part(entry, ':', 1) AS alias, split_part(split_part(entry, ':', 2), '@', 1) AS db,
  split_part(split_part(entry, ':', 2), '@', 2) AS host, CASE WHEN entry LIKE '%@3307' THEN 3307 ELSE 3306 END AS port,
  CAST(replace(split_part(entry, ':', 1), 'shard', '') AS INTEGER) AS db_index
FROM ({ENTRIES}) e
"""

_CRC_TABLE = """
WITH t AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS tbl)
"""


def _crc(text: str) -> str:
    codes = f"list_transform(str_split({text}, ''), lambda ch: CAST(ord(ch) AS BIGINT))"
    step = "lambda c, b: xor(c >> 8, t.tbl[xor(c, b) % 256 + 1])"
    return f"xor(list_reduce({codes}, {step}, CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT))"


LATEST_LAG = f"""
SELECT host, lag_ns, lag_ns > 1500000000 AS paused FROM (
  SELECT host, observed_ns - heartbeat_ns AS lag_ns, row_number() OVER (PARTITION BY host ORDER BY seq DESC) AS rn
  FROM ({HB}) h WHERE observed_ns > heartbeat_ns) t WHERE rn = 1
"""

_PLACED = f"""
SELECT o.*, d.host, coalesce(l.paused, FALSE) AS held FROM ({{rows}}) o
LEFT JOIN ({DIRECTORY}) d ON d.db_index = o.shard LEFT JOIN ({LATEST_LAG}) l ON l.host = d.host
"""

_JSON_ARGS = """CASE op WHEN 'D' THEN 'delete from user_recording_like where user_id=? and recording_id=? --> ['
    || user_id || ',' || recording_id || ']'
  WHEN 'U' THEN 'update user_recording_like set user_id=?, recording_id=?, created_on=? where user_id=? and recording_id=? --> ['
    || new_user_id || ',' || recording_id || ',' || created_on || ',' || user_id || ',' || recording_id || ']'
  ELSE 'replace into user_recording_like (user_id, recording_id, created_on) values (?, ?, ?) --> ['
    || new_user_id || ',' || recording_id || ',' || created_on || ']' END"""

_FAULTY = f"""
SELECT *, CASE WHEN g % 13 = 5 THEN 'unknown_dml' WHEN {DML} = 'Update' AND g % 17 = 3 THEN 'odd_update_images' END AS bad
FROM ({CHG}) c WHERE substr(lower(database_name), 1, 6) = 'shard_' AND lower(table_name) = 'user_recording_like'
"""

# Windows-1252 characters for 0x80 .. 0x9F; codes that are not assigned stay control codes.
_HIGH = " ".join(
    f"WHEN {code} THEN '{bytes([code]).decode('cp1252')}'"
    for code in range(128, 160)
    if code not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)
)

# Merged runs: a run opens another range when it begins behind all that came before it.
_ISLANDS = f"""
WITH r AS (SELECT source, (after_file, after_pos) AS a, (upto_file, upto_pos) AS z FROM ({APPLIED_RUNS}) r),
m AS (SELECT *, max(z) OVER (PARTITION BY source ORDER BY a, z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM r),
n AS (SELECT *, sum(CASE WHEN top IS NULL OR a > top THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY a, z) AS island FROM m)
SELECT source, min(a) AS a, max(z) AS z FROM n GROUP BY source, island
"""

ORACLES: dict[str, str] = {
    "snapshot_keyset_scan": f"SELECT id, user_id, recording_id, created_on FROM ({SNAP}) s WHERE id > 100 ORDER BY id LIMIT 2000",
    "snapshot_chunk_plan": f"""
SELECT CAST(id // 2000 AS BIGINT) AS chunk, min(id) AS lo, max(id) AS hi, count(*) AS rows FROM ({SNAP}) s GROUP BY 1""",
    "snapshot_ranges": f"""
WITH r AS (SELECT source, id, (row_number() OVER (PARTITION BY source ORDER BY id) - 1) // 100 AS chunk FROM ({SPARSE}) s),
c AS (SELECT source, chunk, min(id) AS lo, max(id) AS hi, count(*) AS rows FROM r GROUP BY 1, 2),
n AS (SELECT *, lead(lo) OVER (PARTITION BY source ORDER BY chunk) AS nx FROM c)
SELECT source, CAST(chunk AS INTEGER) AS chunk, lo, hi, rows, CASE WHEN chunk = 0 AND nx IS NULL THEN '1 = 1'
  WHEN chunk = 0 THEN 'id < ' || nx || ' or id is null' WHEN nx IS NULL THEN 'id >= ' || lo
  ELSE 'id >= ' || lo || ' and id < ' || nx END AS predicate FROM n""",
    "changelog_scan": f"""
SELECT source, log_file, log_pos, row_idx, database_name, table_name, {DML} AS dml,
  CASE WHEN {DML} <> 'Insert' THEN user_id END AS user_id, CASE WHEN {DML} <> 'Delete' THEN new_user_id END AS new_user_id,
  created_on FROM ({CHG}) c""",
    "resume_from_position": f"""
WITH f AS ({FOUR}), top AS (SELECT max(seq) AS m FROM f),
p AS (SELECT source, max((log_file, log_pos)) AS p FROM f, top
  WHERE CASE WHEN source IN ('db-0', 'db-1') THEN 4 * seq <= m WHEN source = 'db-2' THEN 2 * seq <= m ELSE TRUE END
  GROUP BY source)
SELECT f.source, f.log_file, f.log_pos, f.seq FROM f JOIN p ON f.source = p.source WHERE (f.log_file, f.log_pos) > p.p""",
    "shard_map": f"""
SELECT alias, CASE WHEN error IS NULL THEN split_part(place, '@', 1) END AS db,
  CASE WHEN error IS NULL THEN split_part(place, '@', 2) END AS host,
  CASE WHEN error IS NULL THEN CASE WHEN ats = 1 THEN 3306 ELSE CAST(split_part(place, '@', 3) AS BIGINT) END END AS port,
  error
FROM (SELECT *, length(place) - length(replace(place, '@', '')) AS ats,
    CASE WHEN place NOT LIKE '%@%' THEN 'no host' WHEN place LIKE '%@%@port' THEN 'bad port' END AS error
  FROM ({_ALIASES}) a WHERE rn = 1) t""",
    "hash_value_int": f"SELECT id, k_int AS h, k_neg AS h_neg FROM ({KEYS}) k",
    "hash_value_string": f"{_CRC_TABLE} SELECT id, CAST(k_num AS BIGINT) AS h_num, {_crc('k_txt')} AS h_txt FROM ({KEYS}) k, t",
    "hash_value_bytes": f"{_CRC_TABLE} SELECT id, {_crc('k_num')} AS h_num, {_crc('k_txt')} AS h_txt FROM ({KEYS}) k, t",
    "shard_slot": f"SELECT id, {_slot('k_int')} AS slot, {_slot('k_neg')} AS slot_neg FROM ({KEYS}) k",
    "shard_index": f"SELECT id, {_shard('k_int')} AS shard, {_shard('k_neg')} AS shard_neg FROM ({KEYS}) k",
    "shard_table_index": f"""
SELECT id, CAST({_shard('k_int')} * 10 + {_unsigned('k_int')} % 10 AS INTEGER) AS table_index,
  CAST({_shard('k_neg')} * 10 + {_unsigned('k_neg')} % 10 AS INTEGER) AS table_index_neg FROM ({KEYS}) k""",
    "shard_to_database": f"""
SELECT id, CAST({_shard('k_int')} * 10 + {_unsigned('k_int')} % 10 AS INTEGER) AS shard, {_shard('k_int')} AS db_index,
  'shard' || {_shard('k_int')} AS alias FROM ({KEYS}) k""",
    "classify_dml": f"""
SELECT id, description, CASE WHEN id % 12 IN (0, 5, 11) THEN 'Insert' WHEN id % 12 IN (1, 6) THEN 'Update'
  WHEN id % 12 IN (2, 7) THEN 'Delete' ELSE 'NoDML' END AS dml FROM ({STATEMENTS}) s""",
    "expand_row_images": f"""
SELECT source, log_file, log_pos, row_idx, {DML} AS dml, CASE WHEN {DML} <> 'Insert' THEN user_id END AS user_id,
  CASE WHEN {DML} <> 'Delete' THEN new_user_id END AS new_user_id, seq FROM ({CHG}) c""",
    "table_pattern_filter": f"SELECT seq, source, database_name, table_name FROM ({MATCHED}) m",
    "skip_applied_events": f"""
SELECT c.source, c.seq, c.log_file, c.log_pos, c.row_idx FROM ({CHG}) c JOIN ({POSITIONS}) p ON c.source = p.source
WHERE c.log_file > p.log_file OR (c.log_file = p.log_file AND c.log_pos > p.log_pos)""",
    "shard_filter": f"SELECT id, {_shard('user_id')} AS shard FROM ({SNAP}) s WHERE {_shard('user_id')} <> 5",
    "project_row_image": f"""
SELECT source, log_file, log_pos, row_idx, CASE WHEN {DML} = 'Delete' THEN user_id ELSE new_user_id END AS user_id,
  recording_id, created_on FROM ({CHG}) c""",
    "unsigned_reinterpret": f"""
SELECT id, CAST((id % 256 + 128) % 256 AS INTEGER) AS u8, CAST((id % 65536 + 32768) % 65536 AS INTEGER) AS u16,
  CAST((id % 16777216 + 8388608) % 16777216 AS INTEGER) AS u24, CAST((id % 4294967296 + 2147483648) % 4294967296 AS BIGINT) AS u32,
  CAST({_unsigned('k_neg')} AS VARCHAR) AS u64 FROM ({KEYS}) k""",
    "latin1_decode": f"""
SELECT id, 'A' || ch || ch AS text FROM (SELECT id, CASE CAST(id % 255 + 1 AS INTEGER) {_HIGH}
  ELSE chr(CAST(id % 255 + 1 AS INTEGER)) END AS ch FROM ({KEYS}) k) t""",
    "row_image_text": f"""
SELECT seq, CAST(seq AS VARCHAR) || ',' || CASE WHEN g % 3 <> 0 THEN CAST(created_on AS VARCHAR) ELSE '<nil>' END || ','
  || CAST(user_id AS VARCHAR) || ',' || CAST(recording_id AS VARCHAR) AS image FROM ({CHG}) c""",
    "route_changes": f"SELECT * FROM ({ROUTED}) r WHERE shard <> 5",
    "route_snapshot": f"SELECT id, user_id, recording_id, created_on, {_shard('user_id')} AS shard FROM ({SNAP}) s WHERE {_shard('user_id')} <> 5",
    "split_key_moves": OPS,
    "split_same_shard_only": f"""
SELECT o.* FROM ({OPS}) o WHERE NOT EXISTS (SELECT 1 FROM ({MATCHED}) m WHERE m.source = o.source AND m.log_file = o.log_file
  AND m.log_pos = o.log_pos AND m.row_idx = o.row_idx AND m.dml = 'Update' AND {_shard('m.user_id')} <> {_shard('m.new_user_id')})""",
    "key_move_audit": f"""
SELECT {_shard('user_id')} AS old_shard, {_shard('new_user_id')} AS new_shard, count(*) AS moves FROM ({MATCHED}) m
WHERE dml = 'Update' AND {_shard('user_id')} <> {_shard('new_user_id')} GROUP BY 1, 2""",
    "insert_ignore": f"SELECT shard, user_id, recording_id, created_on FROM ({LOADED}) l",
    "load_rejects": f"""
SELECT 'loaded' AS outcome, user_id, recording_id, created_on FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, recording_id ORDER BY id) AS rn FROM ({SNAP}) s WHERE id % 19 <> 7) t
WHERE rn = 1 AND {_shard('user_id')} <> 5
UNION ALL SELECT 'rejected', user_id, NULL, created_on FROM ({SNAP}) s WHERE id % 19 = 7""",
    "insert_ignore_existing": f"""
SELECT shard, user_id, recording_id, created_on, source FROM ({LOADED}) l WHERE NOT EXISTS (SELECT 1 FROM ({_net(OPS)}) n
  WHERE n.op = 'I' AND n.source = l.source AND n.user_id = l.user_id AND n.recording_id = l.recording_id)""",
    "reorder_snapshot": f"""
SELECT shard, user_id, recording_id, created_on,
  row_number() OVER (PARTITION BY shard ORDER BY user_id, recording_id) AS row_no FROM ({LOADED}) l""",
    "write_shards": f"SELECT shard, user_id, recording_id, created_on FROM ({LOADED}) l",
    "load_batches": f"""
SELECT shard, batch_no, count(*) AS batch_rows FROM (SELECT shard,
  (row_number() OVER (PARTITION BY shard ORDER BY user_id, recording_id) - 1) // 50 AS batch_no FROM ({LOADED}) l) t GROUP BY 1, 2""",
    "dry_run_preview": f"""
SELECT shard, (rn - 1) // 50 AS batch_no,
  'insert ignore into user_recording_like (user_id, recording_id, created_on) values (?, ?, ?)' AS sql,
  '[' || user_id || ',' || recording_id || ',' || created_on || ']' AS args
FROM (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY user_id, recording_id) AS rn FROM ({LOADED}) l) t
WHERE (rn - 1) % 50 = 0""",
    "dry_run_changes": f"""
SELECT shard, (rn - 1) // 20 AS batch_no, op, '[' || CASE WHEN op = 'D' THEN user_id || ',' || recording_id
    ELSE new_user_id || ',' || recording_id || ',' || created_on
      || CASE WHEN op = 'U' THEN ',' || user_id || ',' || recording_id ELSE '' END END || ']' AS args
FROM (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY source, log_file, log_pos, row_idx, sub) AS rn FROM ({OPS}) o) t
WHERE (rn - 1) % 20 = 0""",
    "render_statements": f"""
SELECT source, log_file, log_pos, row_idx, shard, {_JSON_ARGS} AS rendered FROM ({ROUTED}) r WHERE shard <> 5""",
    "shard_placement": f"""
SELECT host, CAST(port AS BIGINT) AS port, db, count(*) AS rows FROM ({LOADED}) l
LEFT JOIN ({DIRECTORY}) d ON d.db_index = l.shard GROUP BY 1, 2, 3""",
    "shard_counts": f"""
SELECT CAST(r.i AS INTEGER) AS shard, count(s.id) AS rows FROM range(32) r(i)
LEFT JOIN (SELECT id, {_shard('user_id')} AS shard FROM ({SNAP}) s WHERE {_shard('user_id')} <> 5) s ON s.shard = r.i GROUP BY 1""",
    "rows_processed": f"""
SELECT source, chunk, rows, CAST(sum(rows) OVER (PARTITION BY source ORDER BY chunk) AS BIGINT) AS rows_processed
FROM (SELECT source, CAST(id // 200 AS BIGINT) AS chunk, count(*) AS rows FROM ({SNAP}) s GROUP BY 1, 2) t""",
    "compact_changes": _net(OPS),
    "apply_changes": _merged(LOADED, _net(OPS)),
    "bootstrap_state": _merged(LOADED, _net(OPS_BEHIND)),
    "bootstrap_chunks": _merged(LOADED, _net(OPS)),
    "bootstrap_partial_starts": _merged(LOADED, _net(OPS_PARTLY_BEHIND)),
    "apply_changes_one_shard": f"SELECT * FROM ({_merged(LOADED, _net(OPS))}) m WHERE shard = 3",
    "apply_progress": f"""
SELECT o.shard, count(*) FILTER (o.log_file < p.log_file OR (o.log_file = p.log_file AND o.log_pos <= p.log_pos)) AS executed,
  count(*) AS pushed,
  count(*) FILTER (o.log_file < p.log_file OR (o.log_file = p.log_file AND o.log_pos <= p.log_pos)) / count(*) * 100.0 AS percent
FROM ({OPS}) o JOIN ({POSITIONS}) p ON o.source = p.source GROUP BY 1""",
    "last_applied_position": f"""
SELECT source, log_file, log_pos FROM (SELECT *, row_number() OVER (PARTITION BY source
  ORDER BY log_file DESC, log_pos DESC) AS rn FROM ({CHG}) c) t WHERE rn = 1""",
    "rejects": f"""
SELECT bad AS reason, count(DISTINCT (source, g)) AS rows FROM ({_FAULTY}) f WHERE bad IS NOT NULL GROUP BY 1
UNION ALL SELECT 'null_key', count(*) FROM ({_FAULTY}) f WHERE bad IS NULL AND seq % 19 = 7""",
    "assign_log_file": f"""
SELECT source, seq, event_name, log_pos,
  last_value(next_log_name IGNORE NULLS) OVER (PARTITION BY source ORDER BY seq) AS log_file FROM ({RAW}) r""",
    "assign_log_file_far": f"""
SELECT source, seq, event_name, log_pos,
  last_value(next_log_name IGNORE NULLS) OVER (PARTITION BY source ORDER BY seq) AS log_file FROM ({RAW_FAR}) r""",
    "applied_ranges": f"""
SELECT source, a[1] AS after_log_file, a[2] AS after_log_pos, z[1] AS upto_log_file, z[2] AS upto_log_pos FROM ({_ISLANDS}) i""",
    "missing_ranges": f"""
SELECT source, b[1] AS after_log_file, b[2] AS after_log_pos, a[1] AS upto_log_file, a[2] AS upto_log_pos
FROM (SELECT source, a, lag(z) OVER (PARTITION BY source ORDER BY a) AS b FROM ({_ISLANDS}) i) g WHERE b IS NOT NULL""",
    "skip_applied_ranges": f"""
SELECT source, seq, log_file, log_pos, row_idx FROM ({CHG}) c WHERE NOT EXISTS (SELECT 1 FROM ({APPLIED_RUNS}) r
  WHERE r.source = c.source AND (c.log_file, c.log_pos) > (r.after_file, r.after_pos)
    AND (c.log_file, c.log_pos) <= (r.upto_file, r.upto_pos))""",
    "log_gap_audit": f"""
WITH a AS ({AUDITED}), s AS (SELECT *, lag(log_pos) OVER (PARTITION BY source, log_file ORDER BY seq) AS b FROM a),
f AS (SELECT source, log_file, string_split(log_file, '.')[-1] AS digits, count(*) AS rows,
  count(*) FILTER (log_pos < b) AS backward_steps FROM s GROUP BY 1, 2, 3),
m AS (SELECT *, TRY_CAST(digits AS BIGINT) AS k, coalesce(TRY_CAST(digits AS BIGINT), 0) AS n,
  left(log_file, length(log_file) - length(digits)) AS stem, length(digits) AS width FROM f),
w AS (SELECT *, lag(log_file) OVER (PARTITION BY source ORDER BY log_file) AS before_file,
  lag(n) OVER (PARTITION BY source ORDER BY log_file) AS bn, repeat('0', width) AS zeros FROM m)
SELECT source, log_file, n AS file_number, CAST(CASE WHEN k IS NULL THEN 0 ELSE width END AS INTEGER) AS number_width, before_file,
  n - bn AS distance,
  CASE WHEN k >= 1 THEN stem || right(zeros || (k - 1), greatest(width, length(CAST(k - 1 AS VARCHAR)))) END AS expected_previous,
  CASE WHEN k IS NOT NULL THEN stem || right(zeros || (k + 1), greatest(width, length(CAST(k + 1 AS VARCHAR)))) END AS expected_next,
  coalesce(n - bn <> 1, FALSE) AS gap, left(log_file, 2) = '//' AS detached, rows, backward_steps FROM w""",
    "distinct_positions": f"SELECT log_file, log_pos, 'binary' AS log_type FROM ({CHG}) c GROUP BY 1, 2",
    "replay_dedup": f"SELECT source, log_file, log_pos, row_idx, seq FROM ({CHG}) c",
    "replica_lag": LATEST_LAG,
    "pause_transitions": f"""
SELECT host, seq, lag_ns, paused FROM (SELECT *, lag(paused, 1, FALSE) OVER (PARTITION BY host ORDER BY seq) AS was
  FROM (SELECT host, seq, observed_ns - heartbeat_ns AS lag_ns, observed_ns - heartbeat_ns > 1500000000 AS paused
    FROM ({HB}) h WHERE observed_ns > heartbeat_ns) p) t WHERE paused <> was""",
    "replication_status": f"""
SELECT host, seq, CASE WHEN seq % 5 <> 0 THEN CAST(floor((observed_ns - heartbeat_ns) / 1e9) AS BIGINT) END AS seconds_behind,
  CASE WHEN seq % 5 <> 0 THEN 'running' ELSE 'not running' END AS status FROM ({HB}) h""",
    "throttle_split": f"SELECT shard, user_id, recording_id, host, held FROM ({_PLACED.format(rows=LOADED)}) p",
    "throttle_asof": f"""
WITH o AS (SELECT *, 1700000000250000000 + ((CAST(split_part(log_file, '.', 2) AS BIGINT) - 17) * 1000 + (log_pos - 120) // 73) * 500000000
    AS at_ns FROM ({OPS}) o),
p AS (SELECT o.*, d.host FROM o LEFT JOIN ({DIRECTORY}) d ON d.db_index = o.shard),
h AS (SELECT host, observed_ns, max(observed_ns - heartbeat_ns) > 1500000000 AS paused FROM ({HB}) h
  WHERE observed_ns > heartbeat_ns GROUP BY 1, 2)
SELECT source, log_file, log_pos, row_idx, sub, shard, p.host, coalesce(h.paused, FALSE) AS held
FROM p ASOF LEFT JOIN h ON p.host = h.host AND p.at_ns >= h.observed_ns""",
    "stream_apply": f"SELECT source, shard, user_id, recording_id, created_on FROM ({_net(OPS)}) n WHERE op = 'I'",
    "stream_fold_state": f"SELECT source, shard, user_id, recording_id, created_on FROM ({_net(OPS)}) n WHERE op = 'I'",
    "stream_fold_output": _net(OPS),
    "stream_resume": f"""
SELECT source, log_file, log_pos FROM (SELECT *, row_number() OVER (PARTITION BY source
  ORDER BY log_file DESC, log_pos DESC) AS rn FROM ({CHG}) c) t WHERE rn = 1""",
    "stream_rotating": f"SELECT source, shard, user_id, recording_id, created_on FROM ({_net(OPS)}) n WHERE op = 'I'",
    "throttled_apply": f"""
SELECT source, shard, user_id, recording_id, created_on FROM ({_PLACED.format(rows=_net(OPS))}) p WHERE op = 'I' AND NOT held""",
    "throttled_release": f"SELECT source, shard, user_id, recording_id, created_on FROM ({_net(OPS)}) n WHERE op = 'I'",
    "stream_replay_dedup": f"SELECT source, log_file, log_pos, row_idx, seq FROM ({CHG}) c",
    "stream_from_position": f"""
WITH e AS (SELECT source, log_file, log_pos, min(seq) AS seq, CAST(sum(CASE {DML} WHEN 'Update' THEN 2 ELSE 1 END) AS INTEGER) AS images
  FROM ({CHG}) c GROUP BY 1, 2, 3), t AS (SELECT max(seq) AS m FROM e),
p AS (SELECT max((log_file, log_pos)) AS p FROM e, t WHERE 4 * seq <= m AND source = 'db-a')
SELECT source, seq, log_file, log_pos, images FROM e, t, p WHERE CASE WHEN source = 'db-a' THEN (log_file, log_pos) > p ELSE 2 * seq > m END""",
    "listener_progress": f"""
WITH e AS (SELECT source, log_file, log_pos, min(database_name) AS d, min(table_name) AS t FROM ({CHG}) c GROUP BY 1, 2, 3),
l AS (SELECT 'likes' AS listener, * FROM e WHERE starts_with(lower(d), 'shard_') AND lower(t) = 'user_recording_like'
  UNION ALL SELECT 'comments', * FROM e WHERE t = 'comment' UNION ALL SELECT 'archive', * FROM e WHERE d = 'archive'
  UNION ALL SELECT 'everything', * FROM e)
SELECT listener, source, max((log_file, log_pos))[1] AS log_file, max((log_file, log_pos))[2] AS log_pos, count(*) AS rows
FROM l GROUP BY 1, 2""",
    "listener_fanout": f"""
SELECT 'likes' AS listener, count(*) AS rows FROM ({MATCHED}) m
UNION ALL SELECT 'comments', count(*) FROM ({CHG}) c WHERE table_name = 'comment'
UNION ALL SELECT 'archive', count(*) FROM ({CHG}) c WHERE database_name = 'archive'
UNION ALL SELECT 'everything', count(*) FROM ({CHG}) c""",
}
