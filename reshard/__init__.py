"""Split large tables over many shards and keep the shards current from a change log, on Spark."""

from reshard.spec import ColumnSpec, TableSpec

__all__ = ["ColumnSpec", "TableSpec"]
