"""A change log as a stream whose offsets are log positions.

    spark.dataSource.register(PositionLog)
    events = spark.readStream.format("position_log").option("path", landed).option("start", "latest").load()

The log has been landed by ``land_changelog``: one folder per source and log file. A stream starts at the position given, goes on from
its checkpoint when it has one, and knows where it is by (file, offset) per source, also within a file. Options:

    path            folder of the landed log; any place that pyarrow can open
    start           ``earliest``, ``latest`` (the end of each source's log), or JSON {source: [file, offset]}: what lies behind that
                    is read, and a source that is not named starts at its end
    least_rows      a batch waits until so many events are there,
    longest_delay   or so many seconds have passed since the first of them was seen; without ``least_rows`` nothing waits
    most_rows       a batch takes whole landed files until it has so many events
    image_type      type of the values in row images

Positions only move forward: what is landed behind a source's position is not read. Use ``merge_ranges`` of what was applied
to find such late parts.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from reshard.sources.changelog import event_ddl

# A task reads landed files until it has so many events: a log of many short files would start a Python task for each.
TASK_ROWS = 50_000
# Footers read at once.
FOOTERS = 16

# The end of a file that is known to be the last one so far.
Place = tuple[str, int]


def land_changelog(events: DataFrame, path: str) -> None:
    """Add events to a landed log: one folder per source and log file, in the order of their offsets."""
    placed = events.repartitionByRange("source", "log_file", "log_pos").sortWithinPartitions("source", "log_file", "log_pos")
    placed.write.mode("append").partitionBy("source", "log_file").parquet(path)


@dataclass(frozen=True)
class Landed:
    """One landed file: events of one log file of one source."""

    source: str
    log_file: str
    path: str
    first: int
    last: int
    rows: int


@dataclass
class Part(InputPartition):
    """What a task reads: events of a landed file behind ``after`` up to ``upto``, and then those of further files."""

    source: str
    log_file: str
    path: str
    after: int | None
    upto: int | None
    further: tuple[Part, ...] = ()


class PositionLog(DataSource):
    """Registers as ``position_log``."""

    @classmethod
    def name(cls) -> str:
        return "position_log"

    def schema(self) -> str:
        return event_ddl(self.options.get("image_type", "bigint"))

    def streamReader(self, schema: StructType) -> PositionReader:
        return PositionReader(dict(self.options), schema)


class PositionReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str], schema: StructType) -> None:
        self.path, self.start = options["path"].rstrip("/"), options.get("start", "latest")
        self.least, self.most = int(options.get("least_rows", 0)), int(options.get("most_rows", 0))
        self.delay = float(options.get("longest_delay", 2.0))
        self.names = schema.fieldNames()
        self.seen: dict[str, Landed] = {}
        # Where the stream is, as far as this reader has been told, and since when something waits.
        self.at: dict[str, Place] | None = None
        self.waiting_since: float | None = None

    # What is there

    def _files(self) -> tuple[pafs.FileSystem, str]:
        if "://" in self.path or self.path.startswith("file:"):
            return pafs.FileSystem.from_uri(self.path)
        return pafs.LocalFileSystem(), self.path

    def _landed(self) -> list[Landed]:
        """All landed files, by source and position. Only the footers of new ones are read."""
        system, root = self._files()

        def landed(path: str) -> Landed | None:
            with system.open_input_file(path) as file:
                footer = pq.ParquetFile(file).metadata
            if not footer.num_rows:
                return None
            column = [footer.schema.column(i).path for i in range(footer.num_columns)].index("log_pos")
            edges = [footer.row_group(i).column(column).statistics for i in range(footer.num_row_groups)]
            names = dict(p.split("=", 1) for p in path.split("/") if "=" in p)
            source, log_file = unquote(names["source"]), unquote(names["log_file"])
            return Landed(source, log_file, path, min(e.min for e in edges), max(e.max for e in edges), footer.num_rows)

        new = []
        for info in system.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)):
            if info.type != pafs.FileType.File or not info.path.endswith(".parquet") or info.path in self.seen:
                continue
            if any(p.startswith(("_", ".")) for p in info.path[len(root) :].split("/")):
                continue
            new.append(info.path)
        with ThreadPoolExecutor(FOOTERS) as pool:
            self.seen |= {f.path: f for f in pool.map(landed, new) if f}
        return sorted(self.seen.values(), key=lambda f: (f.source, f.log_file, f.first, f.last))

    @staticmethod
    def _ends(files: list[Landed]) -> dict[str, Place]:
        ends: dict[str, Place] = {}
        for f in files:
            ends[f.source] = max(ends.get(f.source, ("", -1)), (f.log_file, f.last))
        return ends

    # Offsets: {source: [file, offset]}

    @staticmethod
    def _shown(places: dict[str, Place]) -> dict:
        return {source: list(place) for source, place in sorted(places.items())}

    @staticmethod
    def _read(offset: dict) -> dict[str, Place]:
        return {source: (place[0], int(place[1])) for source, place in offset.items()}

    def initialOffset(self) -> dict:
        """Explicit start, or the beginning, or the end of the log; a checkpoint comes before all of them."""
        if self.start == "earliest":
            self.at = {}
        else:
            self.at = self._ends(self._landed())
            if self.start != "latest":
                self.at |= self._read(json.loads(self.start))
        return self._shown(self.at)

    def latestOffset(self) -> dict:
        """How far the next batch goes: nowhere while it waits for more events."""
        files = self._landed()
        if self.at is None:
            # After a restart the first batch tells where the stream is; until then nothing can be held back.
            return self._shown(self._ends(files))
        new = [f for f in files if (f.log_file, f.last) > self.at.get(f.source, ("", -1))]
        rows = sum(f.rows for f in new)
        if not rows:
            self.waiting_since = None
            return self._shown(self.at)
        self.waiting_since = self.waiting_since or time.monotonic()
        if rows < self.least and time.monotonic() - self.waiting_since < self.delay:
            return self._shown(self.at)
        self.waiting_since = None
        self.at = dict(self.at) | self._ends(self._some(new))
        return self._shown(self.at)

    def _some(self, files: list[Landed]) -> list[Landed]:
        """Files up to ``most_rows``, each source in its order, the sources in turn."""
        if not self.most:
            return files
        waiting: dict[str, list[Landed]] = {}
        for f in files:
            waiting.setdefault(f.source, []).append(f)
        out, rows = [], 0
        while waiting and (not out or rows < self.most):
            for source in list(waiting):
                if out and rows >= self.most:
                    break
                f = waiting[source].pop(0)
                out.append(f)
                rows += f.rows
                if not waiting[source]:
                    del waiting[source]
        return out

    def partitions(self, start: dict, end: dict) -> list[Part]:
        """Landed files with events behind the start up to the end, up to TASK_ROWS in a task; the first and the last one of a
        source may be read in part."""
        began, ends = self._read(start), self._read(end)
        self.at = ends if self.at is None else self.at
        groups: list[list[Part]] = []
        rows = TASK_ROWS
        for f in self._landed():
            after, upto = began.get(f.source, ("", -1)), ends.get(f.source, ("", -1))
            if (f.log_file, f.last) <= after or (f.log_file, f.first) > upto:
                continue
            if rows >= TASK_ROWS:
                groups.append([])
                rows = 0
            rows += f.rows
            groups[-1].append(Part(
                f.source, f.log_file, f.path,
                after[1] if f.log_file == after[0] else None, upto[1] if f.log_file == upto[0] else None,
            ))
        return [replace(first, further=tuple(others)) for first, *others in groups]

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        """Events of a part's files, batch by batch."""
        system, _ = self._files()
        for one in (part, *part.further):
            yield from self._events(system, one)

    def _events(self, system: pafs.FileSystem, part: Part) -> Iterator[pa.RecordBatch]:
        with system.open_input_file(part.path) as file:
            for batch in pq.ParquetFile(file).iter_batches(batch_size=8192):
                at = batch.column("log_pos")
                inside = pa.array([True] * batch.num_rows)
                if part.after is not None:
                    inside = pc.and_(inside, pc.greater(at, part.after))
                if part.upto is not None:
                    inside = pc.and_(inside, pc.less_equal(at, part.upto))
                batch = batch.filter(inside)
                if batch.num_rows:
                    known = {"source": pa.array([part.source] * batch.num_rows), "log_file": pa.array([part.log_file] * batch.num_rows)}
                    columns = [known[n] if n in known else batch.column(n) for n in self.names]
                    yield pa.RecordBatch.from_arrays(columns, self.names)

    def commit(self, end: dict) -> None:
        """Nothing is removed: the landed log stays."""


def stream_positions(spark, path: str, start: str | dict[str, Place] = "latest", **options: object) -> DataFrame:
    """The landed log behind a start; other options as in the module's text."""
    spark.dataSource.register(PositionLog)
    text = start if isinstance(start, str) else json.dumps({s: list(p) for s, p in start.items()})
    reader = spark.readStream.format("position_log").option("path", path).option("start", text)
    return reader.options(**{k: str(v) for k, v in options.items()}).load()

