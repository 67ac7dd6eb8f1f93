"""From raw change-log events to typed changes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from reshard.functions.events import DELETE, INSERT, NO_DML, UPDATE, first_word, table_matches, word_kind
from reshard.functions.positions import position
from reshard.functions.values import image_value
from reshard.operators.intervals import as_of
from reshard.session import broadcast_if_small
from reshard.spec import TableSpec

ROTATION = "RotateEvent"

UNKNOWN_DML = "unknown_dml"
ODD_UPDATE = "odd_update_images"
NULL_KEY = "null_key"
NO_LOG_FILE = "no_log_file"


def rotations(events: DataFrame) -> DataFrame:
    """Points at which a source's log continues in another file."""
    return events.where((F.col("event_name") == ROTATION) & F.col("next_log_name").isNotNull()).select(
        "source", "seq", F.col("next_log_name").alias("log_file")
    )


def assign_log_file(
    events: DataFrame, known: DataFrame | None = None, max_broadcast_rows: int = 1_000_000
) -> DataFrame:
    """Give every event the file named by the last rotation of its source, NULL before the first.

    ``known`` adds rotations from earlier reads, as (source, seq, log_file). The log itself is not shuffled while the
    rotations, one per log file, stay below ``max_broadcast_rows``.
    """
    points = rotations(events)
    if known is not None:
        points = points.unionByName(known.select("source", "seq", "log_file"))
    return as_of(events, points, "source", "seq", "log_file", max_broadcast_rows)


def expand_row_images(events: DataFrame) -> DataFrame:
    """One event with many row images -> one change per row.

    Adds ``dml``, ``row_idx``, ``before`` and ``after`` images, and ``reason``, which is set for events
    that cannot be expanded (these keep one row without images). Events without rows give no change.
    """
    element = events.schema["rows"].dataType.elementType.simpleString()
    kind, unpaired = F.col("dml"), F.size("rows") % 2 == 1
    prepared = events.select(
        "*",
        first_word(F.col("event_name")).alias("_word"),
        word_kind(F.col("_word")).alias("dml"),
        F.when(kind == NO_DML, UNKNOWN_DML).when((kind == UPDATE) & unpaired, ODD_UPDATE).alias("reason"),
    )
    images = F.when(
        F.col("reason").isNotNull() & F.col("rows").isNotNull(), F.array(F.lit(None).cast(element))
    ).otherwise(F.col("rows"))
    kept = [c for c in events.columns if c not in ("rows", "event_name")]
    paired = F.get("rows", F.col("_at") + 1)
    return (
        prepared.select(*kept, "rows", "dml", "reason", F.posexplode(images).alias("_at", "_image"))
        .where((F.col("dml") != UPDATE) | (F.col("_at") % 2 == 0))
        .select(
            *kept,
            "dml",
            "reason",
            F.when(F.col("dml") == UPDATE, F.shiftright("_at", 1)).otherwise(F.col("_at")).alias("row_idx"),
            F.when(F.col("dml") != INSERT, F.col("_image")).alias("before"),
            F.when(F.col("dml") == INSERT, F.col("_image"))
            .when((F.col("dml") == UPDATE) & F.col("reason").isNull(), paired)
            .alias("after"),
        )
    )


def match_tables(changes: DataFrame, spec: TableSpec) -> DataFrame:
    return changes.where(
        table_matches(F.col("database_name"), F.col("table_name"), spec.database_pattern, spec.table_pattern)
    )


def project_row_image(image: Column, spec: TableSpec, binary: bool | None = None) -> Column:
    """Typed struct of the copied columns; NULL for a missing image. ``binary`` tells whether the image holds bytes."""
    values = [image_value(image, column, binary).alias(column.name) for column in spec.columns]
    return F.when(image.isNotNull(), F.struct(*values))


def project_changes(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Replace positional images by typed structs, and mark rows whose key is not complete."""
    binary = isinstance(changes.schema["before"].dataType.elementType, BinaryType)
    typed = changes.withColumns({side: project_row_image(F.col(side), spec, binary) for side in ("before", "after")})

    def incomplete(image: str) -> Column:
        missing = F.lit(False)
        for name in spec.key:
            missing = missing | F.col(image).getField(name).isNull()
        return missing

    bad = F.when(F.col("dml") == INSERT, incomplete("after"))
    bad = bad.when(F.col("dml") == DELETE, incomplete("before"))
    bad = bad.otherwise(incomplete("before") | incomplete("after"))
    return typed.withColumn("reason", F.coalesce(F.col("reason"), F.when(bad, NULL_KEY)))


def accepted(changes: DataFrame) -> DataFrame:
    return changes.where(F.col("reason").isNull()).drop("reason")


# What becomes of changes and rows that cannot be routed: a handler gets them, a path stores them, and None lets the
# job fail at the first one.
Rejects = Callable[[DataFrame], None] | str | None


def hand_over(refused: DataFrame, rejects: Rejects, batch_id: int | None = None) -> None:
    """Give refused rows to the handler, or store them at the path.

    Those of a micro-batch replace what an earlier try of the same batch has stored; others are appended.
    """
    if callable(rejects):
        rejects(refused)
    elif rejects is not None and batch_id is not None:
        refused.write.mode("overwrite").parquet(f"{rejects}/batch_id={batch_id}")
    elif rejects is not None:
        refused.write.mode("append").parquet(rejects)


def routable(changes: DataFrame, rejects: Rejects = None) -> DataFrame:
    """Changes without a reason against them; the others are handed over, or fail the job."""
    if rejects is not None:
        hand_over(rejected(changes), rejects)
        return accepted(changes)
    text = F.concat(F.lit("a change cannot be routed: "), F.col("reason"))
    checked = F.when(F.col("reason").isNotNull(), F.raise_error(text).cast("boolean")).otherwise(F.lit(True))
    return changes.where(checked).drop("reason")


def rejected(changes: DataFrame) -> DataFrame:
    """Changes that cannot be routed, with the reason; nothing is dropped silently."""
    return changes.where(F.col("reason").isNotNull())


def placed_in_log(changes: DataFrame) -> DataFrame:
    """Mark changes whose log file is not known: they cannot be ordered."""
    lost = F.when(F.col("log_file").isNull(), NO_LOG_FILE)
    return changes.withColumn("reason", F.coalesce(F.col("reason"), lost))


def count_rejects(changes: DataFrame) -> DataFrame:
    return rejected(changes).groupBy("reason").agg(F.count("*").alias("rows"))


def skip_applied(changes: DataFrame, applied: DataFrame) -> DataFrame:
    """Drop whole events at or before the last applied position of their source."""
    last = broadcast_if_small(
        applied.select(F.col("source"), position(F.col("log_file"), F.col("log_pos")).alias("_applied"))
    )
    here = position(F.col("log_file"), F.col("log_pos"))
    return (
        changes.join(last, "source", "left")
        .where(F.col("_applied").isNull() | (here > F.col("_applied")))
        .drop("_applied")
    )


def drop_replayed(changes: DataFrame) -> DataFrame:
    """Keep one copy of changes that were read twice, as after a reconnect."""
    return changes.dropDuplicates(["source", "log_file", "log_pos", "row_idx"])


def drop_replayed_stream(changes: DataFrame, delay: str = "1 hour", time: str | None = None) -> DataFrame:
    """The same on a stream: copies that come within ``delay`` of the first one are dropped, and what is known of it then goes.

    Time is when a change arrives, so that a late file is never mistaken for an old one. With ``time``, a column of the changes, it is
    theirs: then changes that are older than the newest by more than ``delay`` are dropped as well.
    """
    when = F.current_timestamp() if time is None else F.col(time)
    timed = changes.withColumn("_when", when).withWatermark("_when", delay)
    return timed.dropDuplicatesWithinWatermark(["source", "log_file", "log_pos", "row_idx"]).drop("_when")


def distinct_positions(changes: DataFrame) -> DataFrame:
    """Positions as set members: file, offset and kind of log."""
    kind = F.col("log_type") if "log_type" in changes.columns else F.lit("binary")
    return changes.select("log_file", "log_pos", kind.alias("log_type")).distinct()
