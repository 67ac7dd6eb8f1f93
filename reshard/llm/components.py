"""Connected components of a graph of any shape, by rounds of stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reshard.llm.common import partitions, stored

EDGES_PER_PARTITION = 50_000


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """node, root: the smallest node of the component of each node that has an edge.

    Each round links the larger neighbours of a node to its smallest one, then the smaller ones; the number of rounds
    grows with the logarithm of the graph. Minima are added up before the shuffle, so a node with very many neighbours
    is no hot key. Nothing is collected but counts. What a round stores has partitions after its number of edges, so
    that the last rounds, and small graphs, make few files. NULL ends and loops are ignored.
    """
    spark = edges.sparkSession
    rows = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u != v")
    rows = stored(rows.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    few = _partitions(rows.count(), partitions(spark))
    while not _are_stars(rows):
        rows = rows.coalesce(few)
        both = rows.unionByName(rows.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Stored, so that the join meets plain exchanges, where the rows of a node with very many neighbours are split.
        low = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).coalesce(few))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u != v").distinct().coalesce(few))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.greatest("v", "m").alias("a"), F.least("v", "m").alias("b"))
        small = small.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        rows = stored(small.where("a != b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct().coalesce(few))
    roots = rows.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return rows.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _partitions(edges: int, most: int) -> int:
    return max(1, min(most, -(-edges // EDGES_PER_PARTITION)))


def _are_stars(rows: DataFrame) -> bool:
    """Whether every edge leads from a node with one edge to a smaller one that has none to a smaller still."""
    ends = rows.select(F.col("u").alias("node"), F.lit(1).alias("up")).unionByName(rows.select(F.col("v").alias("node"), F.lit(0).alias("up")))
    seen = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return seen.where((F.col("ups") > 1) | ((F.col("ups") == 1) & (F.col("least") == 0))).isEmpty()
