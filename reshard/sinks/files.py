"""Shard folders and bucketed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reshard.operators.loading import reorder
from reshard.spec import TableSpec


def write_shards(
    rows: DataFrame, spec: TableSpec, path: str, mode: str = "errorifexists", partitions: int | None = None
) -> None:
    """One folder per shard, every file in target key order. A large shard gets several files."""
    reorder(rows, spec, partitions).write.partitionBy("shard").mode(mode).parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("shard", F.col("shard").cast("int"))


def save_bucketed(rows: DataFrame, spec: TableSpec, table: str, buckets: int, path: str | None = None) -> None:
    """Target kept in buckets of its identity: merging changes then shuffles the changes only.

    Use as many buckets as shuffle partitions, or more; with fewer the planner shuffles the target again.
    """
    writer = (
        rows.repartition(buckets, *spec.identity)
        .write.bucketBy(buckets, *spec.identity)
        .sortBy(*spec.identity)
        .mode("overwrite")
    )
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
