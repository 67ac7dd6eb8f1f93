"""Uniform shuffle into shards of exact sizes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reshard.llm.common import multivariate, row_hash, with_running

ROWS_PER_BLOCK = 50_000
# Rows of the matrix, which is drawn on the driver and broadcast.
MOST_BLOCKS = 1024


def communication_matrix(blocks: list[int], shards: int, seed: int) -> list[list[int]]:
    """How many rows each block sends to each shard, drawn as a uniform shuffle would; shard sizes differ by one at most."""
    total = sum(blocks)
    left = [total // shards + (s < total % shards) for s in range(shards)]
    rng, matrix = np.random.default_rng(seed), []
    for n in blocks:
        row = multivariate(rng, left, n)
        left = [a - b for a, b in zip(left, row)]
        matrix.append(row)
    return matrix


def shuffle_to_shards(
    docs: DataFrame, shards: int = 8, seed: int = 17, id_col: str = "doc_id", rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """All rows with their shard and their slot in it: columns doc (the whole row), shard, slot.

    Rows lie in blocks by a hash of their contents, MOST_BLOCKS of them at most, so that the matrix stays small. A matrix of
    exact counts (block x shard) is drawn hypergeometrically from the block sizes alone; each block is permuted by a
    seeded hash and dealt out by its row of the matrix; after the exchange each shard is permuted again by another hash.
    Both permutations go in ranges of the hash, so that no block and no shard is in one task.
    Equal seeds give equal results, whatever the partitions; a lost task repeats the same choices.

    Rows that agree in all columns are interchangeable. NULLs are values like others. Columns named like the results
    stay inside ``doc``. An empty table gives an empty result. Copies of a text are separate rows: they are not kept
    together, as a group larger than a shard could not be.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), row_hash(docs).alias("_tie"))
    total = docs.count()
    blocks = max(1, min(MOST_BLOCKS, -(-total // rows_per_block)))
    rows = rows.withColumns({
        "block": F.pmod(F.xxhash64(F.lit(seed), "_tie"), F.lit(blocks)).cast("int"),
        "_first": F.xxhash64(F.lit(seed + 1), "_tie"),
        "_second": F.xxhash64(F.lit(seed + 2), "_tie"),
    })
    counted = {r["block"]: r["count"] for r in rows.groupBy("block").count().collect()}  # one row per block
    matrix = communication_matrix([counted.get(b, 0) for b in range(blocks)], shards, seed)
    ends = [(b, [int(v) for v in np.cumsum(row)]) for b, row in enumerate(matrix)]
    dealt = docs.sparkSession.createDataFrame(ends, "block int, ends array<bigint>")

    rows = rows.withColumn("_one", F.lit(1))
    rows = with_running(rows, "block", "_first", {"_place": "_one"}, total, blocks, rows_per_block)
    rows = rows.join(F.broadcast(dealt), "block")
    rows = rows.withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("_place")))).drop("ends", "_place", "_first", "block")
    out = with_running(rows, "shard", "_second", {"slot": "_one"}, total, shards, rows_per_block)
    return out.select("doc", "shard", "slot")
