"""Exact dedup by sorting contents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reshard.llm.common import ascii_lower, partitions, stored

# Characters of the text a splitter carries; the digest behind it keeps equal texts together.
HEAD_CHARS = 24
SAMPLES_PER_RANGE = 40


def _range_of(key: Column, splitters: list) -> Column:
    """Number of splitters at or below the key: first among the heads of chunks, then within one chunk."""
    if not splitters:
        return F.lit(0)
    width = max(1, int(len(splitters) ** 0.5))
    chunks = [splitters[i : i + width] for i in range(0, len(splitters), width)]

    def literal(rows: list) -> Column:
        return F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("head", "digest", "salt"), r)]) for r in rows])

    def below(rows: Column) -> Column:
        return F.size(F.filter(rows, lambda s: s <= key))

    chunk = below(literal([c[0] for c in chunks]))
    inner = below(F.element_at(F.array(*[literal(c) for c in chunks]), F.greatest(chunk, F.lit(1))))
    return F.when(chunk == 0, F.lit(0)).otherwise((chunk - 1) * width + inner)


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", ranges: int | None = None
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256. Texts are equal when they agree after A-Z is
    lower-cased; the row with the smallest (or largest) id of each group stays.

    Sampled splitters over (head of the text, digest, hash of the id) cut the contents into ranges; a text held by a
    third of all rows falls into many ranges. Within a range rows are sorted by content and each is compared in full
    with its neighbour. Runs that touch a border of a range are joined over the digest: at most two per range.

    NULL text counts as empty. NULL ids come last for either choice; of rows with equal text and id one stays. Empty
    input gives an empty result. Other columns are ignored.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be 'smallest' or 'largest', not {keep!r}")
    ranges = ranges or 3 * partitions(docs.sparkSession)
    text = ascii_lower(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("norm")).withColumn("digest", F.sha2("norm", 256))
    key = F.struct(
        F.left("norm", F.lit(HEAD_CHARS)).alias("head"), F.col("digest"), F.xxhash64("id").alias("salt")
    )

    wanted = SAMPLES_PER_RANGE * ranges
    share = min(1.0, wanted / max(1, docs.count()))
    sample = rows.sample(share, seed=11) if share < 1 else rows
    sample = sorted(tuple(r["key"]) for r in sample.select(key.alias("key")).limit(2 * wanted).collect())
    splitters = sorted({sample[len(sample) * i // ranges] for i in range(1, ranges)} if sample else [])

    placed = rows.withColumn("range", _range_of(key, splitters)).withColumn("head", F.left("norm", F.lit(HEAD_CHARS)))
    order = Window.partitionBy("range").orderBy("head", "digest", "id")
    same = F.coalesce(F.lag("norm").over(order) == F.col("norm"), F.lit(False))
    runs = placed.withColumn("opens", (~same).cast("int")).drop("norm")
    runs = runs.withColumn("run", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = stored(
        runs.select("range", "run", "id", F.unhex("digest").alias("digest"), F.monotonically_increasing_id().alias("at"))
    )

    best = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("at"))
    if keep == "largest":
        best = F.struct(F.col("id").isNotNull().alias("some"), F.col("id"), F.col("at"))
    choose = F.max if keep == "largest" else F.min
    groups = runs.groupBy("range", "run").agg(
        F.count("*").alias("n"), choose(best).alias("best"), F.first("digest").alias("digest")
    )
    last = groups.groupBy("range").agg(F.max("run").alias("last"))
    borders = groups.join(F.broadcast(last), "range").where((F.col("run") == 1) | (F.col("run") == F.col("last")))
    wide = borders.groupBy("digest").agg(F.sum("n").alias("wide_n"), choose("best").alias("wide_best"))
    groups = groups.join(F.broadcast(wide), "digest", "left").select(  # at most two rows per range
        "range", "run", F.coalesce("wide_n", "n").alias("n"), F.coalesce("wide_best", "best").alias("best")
    )
    out = runs.join(groups, ["range", "run"])
    return out.select(
        F.col("id").alias(id_col),
        F.col("best.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("at") == F.col("best.at")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
