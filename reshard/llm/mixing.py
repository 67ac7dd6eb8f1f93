"""Mixing sources to target weights."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reshard.llm.common import multivariate, row_hash, stored, with_running, word_count
from reshard.session import BROADCAST_ROWS, broadcast_if_small

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BLOCK_DOCS = 32
FILL_ROUNDS = 2


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MOST_REPEATS) -> DataFrame:
    """source, source_size -> with target: sources by code point (NULL last) share all words by the repeating weights;
    what exceeds ``cap`` times a source's own size is shared among the others, until none is above.

    The fixed point in closed form: in the order of cap / weight, the first source that is not cut off sets the level.
    One row per source is handled here, never documents.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight.cast("long")).withColumn("most", F.col("source_size") * cap)
    rows = rows.withColumn("ratio", F.col("most") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", F.col("source").isNull(), "source")
    earlier, everything = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(earlier), F.lit(0))).cast("double") / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0))
    )
    rows = rows.withColumn("level", level)
    first = F.when(F.col("level") <= F.col("ratio"), F.struct(F.row_number().over(by_ratio).alias("place"), F.col("level")))
    rows = rows.withColumn("first", first)
    level = F.min("first").over(everything)["level"]
    target = F.least(F.col("most").cast("double"), level * F.col("weight"))
    return rows.select("source", "source_size", target.alias("target"))


def splitting_tree(blocks: list[int], shards: int, seed: int) -> list[list[int]]:
    """Blocks of each source in each shard: the shards are halved again and again, and each node draws how many blocks
    of each source go left. All blocks are placed, and shards differ by one block at most."""
    rng, total = np.random.default_rng(seed), sum(blocks)
    room = [total // shards + (s < total % shards) for s in range(shards)]

    def split(have: list[int], a: int, b: int) -> list[list[int]]:
        if b - a == 1:
            return [have]
        middle = (a + b) // 2
        left = multivariate(rng, have, sum(room[a:middle]))
        return split(left, a, middle) + split([x - y for x, y in zip(have, left)], middle, b)

    return split(list(blocks), 0, shards)


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    cap: int = MOST_REPEATS,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    carry: list[str] | None = None,
    fill: bool = True,
) -> DataFrame:
    """How often each document is taken: doc (the row, or its columns in ``carry``), source, size, source_size, target, order_key, times, rank.

    Each source is taken whole as often as its target allows; the rest of the target is filled by documents in the
    order of a seeded hash while they fit, and what then is open by the largest document that fits, twice. With ``fill``
    documents that are larger than what is open are set aside and the others are taken in order while they fit, again
    and again, until none fits. Then a source misses its target by less than its smallest untaken document. ``rank`` numbers the documents of a source in
    that order. Equal seeds give equal results.

    Sizes are words between ASCII white space; NULL and empty texts have none and are taken as often as their source is
    taken whole. NULL is a source, the last one. Copies are documents of their own. An empty table gives no rows. Other
    columns stay inside ``doc``.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(text)))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in (carry or docs.columns)]).alias("doc"),
        F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"),
        key.alias("order_key"),
        row_hash(docs).alias("_tie"),
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = stored(
        source_targets(sizes, weights, cap)
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("rest", F.floor(F.col("target") - F.col("whole") * F.col("source_size")).cast("long"))
    )
    # The leading 64 bits of the digest, in unsigned order.
    rows = rows.withColumn("_key", F.conv(F.left("order_key", F.lit(16)), 16, -10).cast("long"))
    rows = rows.withColumn("_tie", F.struct("order_key", "_tie")).withColumn("_one", F.lit(1))
    sources = plan.count()
    ranked = with_running(rows, "source", "_key", {"before": "size", "rank": "_one"}, docs.count(), sources)
    plan = plan.withColumnRenamed("source", "_s")
    plan = F.broadcast(plan) if sources <= BROADCAST_ROWS else plan
    ranked = ranked.join(plan, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    ranked = stored(ranked.withColumn("extra", (F.col("size") > 0) & (F.col("before") + F.col("size") <= F.col("rest"))))

    # What is open after the documents in order: whoever does not fit there may fit in what is left, largest first.
    out = ranked
    for _ in range(FILL_ROUNDS):
        taken = F.sum(F.when(F.col("extra"), F.col("size")).otherwise(0))
        gaps = out.groupBy(F.col("source").alias("_s")).agg((F.first("rest") - taken).alias("gap"))
        fits = out.join(F.broadcast(gaps) if sources <= BROADCAST_ROWS else gaps, F.col("source").eqNullSafe(F.col("_s")))
        fits = fits.where(~F.col("extra") & (F.col("size") > 0) & (F.col("size") <= F.col("gap")))
        best = stored(fits.groupBy("_s").agg(F.max(F.struct("size", "_tie"))["_tie"].alias("_best")))
        best = F.broadcast(best) if sources <= BROADCAST_ROWS else best  # one row per source
        out = out.join(best, F.col("source").eqNullSafe(F.col("_s")), "left")
        chosen = F.coalesce(F.col("_tie") == F.col("_best"), F.lit(False))
        out = out.withColumn("extra", F.col("extra") | chosen).drop("_s", "_best")
    if fill:
        more = _filling(out, sources)
        out = out.join(broadcast_if_small(more), F.col("source").eqNullSafe(F.col("_s")) & (F.col("rank") == F.col("_r")), "left")
        out = out.withColumn("extra", F.col("extra") | F.col("_r").isNotNull()).drop("_s", "_r")
    times = F.col("whole") + F.col("extra").cast("long")
    return out.select(
        "doc", "source", "size", "source_size", "target", "order_key", "rank", times.alias("times")
    )


def _filling(rows: DataFrame, sources: int) -> DataFrame:
    """_s (source), _r (rank): the documents that fill what is open after ``extra``, so that none that is left fits.

    In each round the first document that does not fit is larger than what then is open; it and all such are set aside.
    """
    slim = stored(rows.select("source", "size", "rank", "_key", "_tie", "rest", "extra"))
    taken = F.sum(F.when(F.col("extra"), F.col("size")).otherwise(0))
    gaps = slim.groupBy(F.col("source").alias("_s")).agg((F.first("rest") - taken).alias("gap"))

    def fitting(left: DataFrame, of: DataFrame) -> DataFrame:
        of = F.broadcast(of) if sources <= BROADCAST_ROWS else of  # one row per source
        return stored(left.join(of, F.col("source").eqNullSafe(F.col("_s"))).where("size <= gap").drop("_s"))

    left = fitting(slim.where(~F.col("extra") & (F.col("size") > 0)).drop("rest", "extra"), gaps)
    chosen = slim.limit(0).select(F.col("source").alias("_s"), F.col("rank").alias("_r"))
    while count := left.count():
        placed = with_running(left, "source", "_key", {"_before": "size"}, count, sources)
        placed = stored(placed.withColumn("_more", F.col("_before") + F.col("size") <= F.col("gap")).drop("_before"))
        chosen = chosen.unionByName(placed.where("_more").select(F.col("source").alias("_s"), F.col("rank").alias("_r")))
        used = F.sum(F.when(F.col("_more"), F.col("size")).otherwise(0))
        gaps = placed.groupBy(F.col("source").alias("_s")).agg((F.first("gap") - used).alias("gap"))
        left = fitting(placed.where(~F.col("_more")).drop("_more", "gap"), gaps)
    return chosen


def deal_blocks(mixed: DataFrame, shards: int = 8, seed: int = 23, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Result of :func:`mix` dealt to shards, one row per taken copy: doc, source, rank, copy, shard, slot. It is read several
    times, so it should be stored.

    Copies of a source lie in blocks of neighbours in its permuted order. Exact numbers of blocks per source and shard
    come from a splitting tree over one count per source; a source's blocks are disjoint and go to the shards in turn.
    Within a shard all rows are permuted by a hash.
    """
    copies = mixed.where(F.col("times") > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    # Copies of the same rank range share a block number per round; rounds follow each other.
    ends = mixed.groupBy("source").agg((F.max("rank") + 1).alias("_docs"))
    copies = copies.join(ends.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    per_round = F.ceil(F.col("_docs") / block_docs)
    copies = copies.withColumn("block", (F.col("copy") - 1) * per_round + F.floor(F.col("rank") / block_docs))
    counts = copies.groupBy("source").agg((F.max("block") + 1).alias("n")).orderBy(F.col("source").isNull(), "source").collect()
    tree = splitting_tree([r["n"] for r in counts], shards, seed)
    dealt = [
        (r["source"], [int(v) for v in np.cumsum([leaf[i] for leaf in tree])]) for i, r in enumerate(counts)
    ]
    dealt = docs_frame(mixed, dealt)
    copies = copies.join(dealt, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    copies = copies.withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("block"))))
    copies = copies.withColumns({
        "_tie": F.struct("order_key", "copy"),
        "_key": F.xxhash64(F.lit(seed), "order_key", "copy"),
        "_one": F.lit(1),
    })
    copied = mixed.agg(F.sum("times")).first()[0] or 0
    return with_running(copies, "shard", "_key", {"slot": "_one"}, copied, shards).select("doc", "source", "rank", "copy", "shard", "slot")


def docs_frame(like: DataFrame, rows: list) -> DataFrame:
    """One row per source for the join with its blocks."""
    kind = dict(like.dtypes)["source"]
    return like.sparkSession.createDataFrame(rows, f"_s {kind}, ends array<bigint>")
