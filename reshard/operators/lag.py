"""Replica lag, and holding work back for hosts whose replicas are behind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reshard.operators.intervals import as_of
from reshard.operators.ordered import with_previous
from reshard.operators.routing import with_database
from reshard.spec import TableSpec

# Fixed value: replicas further behind than this pause the work for their host.
MAX_LAG_NS = 1_500_000_000


def lag_ns(heartbeats: DataFrame) -> Column:
    return F.col("observed_ns") - F.col("heartbeat_ns")


def measured(heartbeats: DataFrame) -> DataFrame:
    """Valid lag measurements and the pause flag they imply; lag of zero or less is no measurement."""
    return heartbeats.withColumn("lag_ns", lag_ns(heartbeats)).where(F.col("lag_ns") > 0).withColumn(
        "paused", F.col("lag_ns") > MAX_LAG_NS
    )


def replica_lag(heartbeats: DataFrame) -> DataFrame:
    """Latest measurement per host."""
    latest = measured(heartbeats).groupBy("host").agg(F.max_by("lag_ns", "seq").alias("lag_ns"))
    return latest.withColumn("paused", F.col("lag_ns") > MAX_LAG_NS)


def pause_transitions(heartbeats: DataFrame, partitions: int | None = None) -> DataFrame:
    """Measurements at which a host's pause flag changes; it starts as not paused."""
    flags = measured(heartbeats).select("host", "seq", "lag_ns", "paused")
    return (
        with_previous(flags, ["host"], "seq", "paused", "_was", F.lit(False), partitions)
        .where(F.col("paused") != F.col("_was"))
        .drop("_was")
    )


def replication_status(replicas: DataFrame) -> DataFrame:
    """'not running' when the replica reports no delay at all, else 'running'."""
    return replicas.withColumn(
        "status", F.when(F.col("seconds_behind").isNull(), "not running").otherwise("running")
    )


def throttle_split(operations: DataFrame, directory: DataFrame, lag: DataFrame, spec: TableSpec) -> DataFrame:
    """Mark operations as ``held`` when the host of their shard is paused.

    Hosts without a measurement are never paused. Flags are joined to the directory first, which leaves at
    most one row per shard to broadcast.
    """
    flags = directory.join(lag.select("host", "paused"), "host", "left")
    placed = with_database(operations, flags, spec)
    return placed.withColumn("held", F.coalesce(F.col("paused"), F.lit(False))).drop("paused")


def throttle_as_of(
    operations: DataFrame, directory: DataFrame, heartbeats: DataFrame, spec: TableSpec, at: str, partitions: int | None = None
) -> DataFrame:
    """Mark operations as ``held`` when the host of their shard was paused at their time ``at``, in nanoseconds.

    The flag of a host holds from one measurement to the next, so only measurements that change it are looked up; one at the
    very time of an operation counts. Before the first measurement nothing is held. Unlike ``throttle_split``, which asks
    for the latest flags, this gives the same answer whenever it is run.
    """
    flags = measured(heartbeats).select("host", "observed_ns", "paused")
    # Of measurements at the same time a pausing one counts.
    flags = flags.groupBy("host", "observed_ns").agg(F.max("paused").alias("paused"))
    changes = with_previous(flags, ["host"], "observed_ns", "paused", "_was", F.lit(False), partitions)
    changes = changes.where(F.col("paused") != F.col("_was")).select("host", F.col("observed_ns").alias(at), "paused")
    placed = as_of(with_database(operations, directory, spec), changes, "host", at, "paused")
    return placed.withColumn("held", F.coalesce(F.col("paused"), F.lit(False))).drop("paused")
