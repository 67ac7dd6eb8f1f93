"""A landed log of many short files is read by few tasks."""

from pyspark.sql import functions as F

from helpers import events_frame
from reshard.sources import position_log
from reshard.sources.changelog import event_schema
from reshard.sources.position_log import PositionReader, land_changelog


def read_all(stream, parts):
    return [
        [(s, f, p) for batch in stream.read(part) for s, f, p in zip(*(batch.column(n).to_pylist() for n in ("source", "log_file", "log_pos")))]
        for part in parts
    ]


def test_short_files_share_a_task(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    operations = [(f"f{n:03d}", p, 0, "I", p, p) for n in range(40) for p in (1, 2, 3)]
    for source in ("a", "b"):
        land_changelog(events_frame(spark, operations).withColumn("source", F.lit(source)), path)
    stream = PositionReader({"path": path}, event_schema())
    start, end = {"a": ["f010", 20]}, {"a": ["f030", 10], "b": ["f039", 30]}
    inside = [(s, f, p * 10) for s in "ab" for f, p, *_ in operations if s == "b" or ("f010", 20) < (f, p * 10) <= ("f030", 10)]
    parts = stream.partitions(start, end)
    assert len(parts) == 1 and read_all(stream, parts) == [inside]
    # A task ends with the file that reaches the bound, and nothing is read twice or left out.
    monkeypatch.setattr(position_log, "TASK_ROWS", 20)
    parts = stream.partitions(start, end)
    found = read_all(stream, parts)
    assert len(parts) == 9 and sum(found, []) == inside
    assert all(len(rows) <= 24 for rows in found)
