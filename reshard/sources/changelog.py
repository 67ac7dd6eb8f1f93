"""Reading change logs that have been landed as files or messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reshard.functions.positions import padded_file, position
from reshard.operators.reports import last_position
from reshard.session import broadcast_if_small


def event_ddl(image_type: str = "bigint") -> str:
    """One log event: where it is in the log, what it is about, and its row images."""
    return (
        "source string, seq bigint, log_file string, log_pos bigint, event_name string, next_log_name string, "
        f"database_name string, table_name string, rows array<array<{image_type}>>"
    )


def event_schema(image_type: str = "bigint") -> T.StructType:
    return T.StructType.fromDDL(event_ddl(image_type))


def read_changelog(spark: SparkSession, path: str, image_type: str = "bigint", fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(event_schema(image_type)).format(fmt).load(path)


def stream_changelog(
    spark: SparkSession, path: str, image_type: str = "bigint", fmt: str = "parquet", files_per_trigger: int = 1000
) -> DataFrame:
    """The same log as a stream; the bound on files per trigger is the back-pressure."""
    return (
        spark.readStream.schema(event_schema(image_type))
        .format(fmt)
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(path)
    )


def decode_messages(messages: DataFrame, value: str = "value", image_type: str = "bigint") -> DataFrame:
    """Events from JSON messages, as read from a message queue source, batch or stream."""
    event = F.from_json(F.col(value).cast("string"), event_schema(image_type)).alias("_event")
    return messages.select(event).select("_event.*")


def order_files_by_number(events: DataFrame) -> DataFrame:
    """Pad the file numbers, for logs whose numbers have grown by a digit. Positions must be padded alike."""
    padded = [c for c in ("log_file", "next_log_name") if c in events.columns]
    return events.withColumns({c: padded_file(F.col(c)) for c in padded})


def known_positions(explicit: DataFrame, saved: DataFrame) -> DataFrame:
    """Start per source as (source, start): the explicit position, else the saved one."""
    here = position(F.col("log_file"), F.col("log_pos"))
    given = explicit.select("source", here.alias("_given"))
    kept = saved.select("source", here.alias("_saved"))
    return given.join(kept, "source", "full_outer").select("source", F.coalesce("_given", "_saved").alias("start"))


def start_positions(changes: DataFrame, explicit: DataFrame, saved: DataFrame) -> DataFrame:
    """Start per source of the log, with the current end for sources that have no known position."""
    ends = last_position(changes).select("source", position(F.col("log_file"), F.col("log_pos")).alias("_end"))
    known = known_positions(explicit, saved)
    return ends.join(known, "source", "left").select("source", F.coalesce("start", "_end").alias("start"))


def after(changes: DataFrame, starts: DataFrame, keep_unknown: bool = False) -> DataFrame:
    """Changes behind the start position of their source; sources without one are left out, or kept whole."""
    here: Column = position(F.col("log_file"), F.col("log_pos"))
    behind = here > F.col("start")
    if keep_unknown:
        behind = behind | F.col("start").isNull()
    placed = changes.join(broadcast_if_small(starts), "source", "left" if keep_unknown else "inner")
    return placed.where(behind).drop("start")


def resume(changes: DataFrame, explicit: DataFrame, saved: DataFrame) -> DataFrame:
    """Changes still to be read. A source without a known position starts at the log's end: nothing yet."""
    return after(changes, known_positions(explicit, saved))
