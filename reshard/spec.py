"""What the engine needs to know about one table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

SPLIT = "split"
SAME_SHARD_ONLY = "same_shard_only"


@dataclass(frozen=True)
class ColumnSpec:
    """One column that is copied to the target.

    ``ordinal`` is the 0-based place in a row image. ``bits`` is the width of an integer column in the
    log (8, 16, 24, 32 or 64); it matters only with ``unsigned``. ``charset='latin1'`` asks for decoding.
    """

    name: str
    ordinal: int
    type: str = "bigint"
    unsigned: bool = False
    bits: int = 64
    charset: str | None = None


@dataclass(frozen=True)
class TableSpec:
    """Declares how a table is keyed, sharded, filtered and matched in the change log.

    ``source`` names the column with the log's origin. When it is set, every key belongs to one origin
    and changes are folded per origin, because the order between two logs is undefined.
    ``location`` of 2 or more splits each shard into that many sub-tables; ``replication`` tells how many
    of those share one database. ``on_key_move`` is 'split' (an update that changes the key becomes a
    delete and an insert) or 'same_shard_only' (moves to another shard are left out).
    """

    table: str
    columns: tuple[ColumnSpec, ...]
    key: tuple[str, ...]
    shard_by: str = ""
    order: tuple[str, ...] = ()
    snapshot_id: str = "id"
    shard_num: int = 32
    location: int = 1
    replication: int = 1
    shard_filter: Callable[[Column], Column] | None = field(default=None, compare=False)
    database_pattern: str = "*"
    table_pattern: str = ""
    on_key_move: str = SPLIT
    source: str | None = None

    def __post_init__(self) -> None:
        names = [c.name for c in self.columns]
        object.__setattr__(self, "shard_by", self.shard_by or self.key[0])
        object.__setattr__(self, "order", tuple(self.order) or tuple(self.key))
        object.__setattr__(self, "table_pattern", self.table_pattern or self.table)
        missing = [k for k in (*self.key, *self.order, self.shard_by) if k not in names]
        if missing:
            raise ValueError(f"not a column of {self.table}: {', '.join(missing)}")
        if self.shard_by not in self.key:
            raise ValueError("shard_by must be one of the key columns")
        if self.shard_num < 1 or self.replication < 1:
            raise ValueError("shard_num and replication must be at least 1")
        if self.on_key_move not in (SPLIT, SAME_SHARD_ONLY):
            raise ValueError(f"unknown on_key_move: {self.on_key_move}")

    def column(self, name: str) -> ColumnSpec:
        return next(c for c in self.columns if c.name == name)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def values(self) -> list[str]:
        """Copied columns that are not part of the key."""
        return [n for n in self.names if n not in self.key]

    def order_of(self, image: str) -> list[Column]:
        """Target order where key columns stand by themselves and the others in an image, as in operations and facts.

        Keys come last again, so that rows without an image have a place.
        """
        places = [F.col(n) if n in self.key else F.col(image).getField(n) for n in self.order]
        return places + [F.col(k) for k in self.key if k not in self.order]

    @property
    def identity(self) -> list[str]:
        """Columns that identify one target row, the most selective ones first, as sorts compare them so."""
        return [*self.key, "shard", *([self.source] if self.source else [])]

    @property
    def table_count(self) -> int:
        """Number of routing targets: shards, or sub-tables when ``location`` is 2 or more."""
        return self.shard_num * max(self.location, 1)
