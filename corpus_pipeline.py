"""A corpus pipeline: toxic documents go, one of each group of near duplicates stays, contaminated documents go, sources
are mixed to their weights, and the rows are dealt to shards."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reshard.llm.common import ascii_lower, only, row_hash, same, stored
from reshard.llm.decontamination import decontaminate
from reshard.llm.jaccard_join import jaccard_components
from reshard.llm.mixing import deal_blocks, mix
from reshard.llm.sharding import shuffle_to_shards
from reshard.llm.toxicity import learn, toxicity_scores
from reshard.session import new_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _without(docs: DataFrame, dropped: DataFrame, text: Column) -> DataFrame:
    """Documents but for those of an operator's rows, which are told by id and text."""
    marked = docs.select("*", F.xxhash64(text).alias("_sum"), F.col("doc_id").alias("_id"))
    keys = dropped.select(F.col("doc_id").alias("_id"), F.col("text_sum").alias("_sum"))
    return only(marked, keys, ["_id", "_sum"], keep=False).drop("_id", "_sum")


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar, learned from the labels outside the held-out fold, does not reject."""
    grammar = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity_scores(docs, grammar, name="_score").where("_score < 0.5").drop("_score")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of near duplicates; rows that repeat an id and its text once."""
    found = jaccard_components(docs)
    kept = _without(docs, found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))), ascii_lower(F.col("text")))
    again = docs.groupBy("doc_id").count().where("count > 1").select("doc_id")
    single = only(kept, again, ["doc_id"], keep=False)
    return single.unionByName(only(kept, again, ["doc_id"]).dropDuplicates(["doc_id", "text"]))


def not_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without much text of the benchmark."""
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(docs, found.where("contaminated"), F.col("text"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, with the shard and slot that its copies are dealt to in blocks of their source;
    these replace columns of these names.

    The mix and the dealing handle ids and hashes only; whole rows meet their copies at the end. Rows that agree in all columns are
    interchangeable, so one of them stands for all their copies.
    """
    marked = _marked(docs)
    mixed = stored(mix(marked, carry=["_id", "_row"]))
    copies = deal_blocks(mixed).select("doc._id", "doc._row", "shard", "slot")
    return _with_places(marked, mixed.select("doc._id", "doc._row"), copies)


def _marked(docs: DataFrame) -> DataFrame:
    """Documents with the id and the hash that tell them apart."""
    return docs.withColumns({"_id": F.col("doc_id"), "_row": row_hash(docs)})


def _with_places(marked: DataFrame, rows: DataFrame, places: DataFrame) -> DataFrame:
    """Whole rows, told by id and hash, at all their places (shard, slot); they are shuffled once, here.

    ``rows`` has id and hash of every document, so that those of equal rows are known; one of them stands for all.
    """
    keys = ["_id", "_row"]
    again = rows.groupBy(*keys).count().where("count > 1")
    single = only(marked, again, keys, keep=False).unionByName(only(marked, again, keys).dropDuplicates(keys))
    placed = single.alias("a").join(places.alias("b"), same("a", "b", keys))
    return placed.select(*[f"a.`{c}`" for c in marked.columns if c not in ("shard", "slot", *keys)], "b.shard", "b.slot")


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot, which replace columns of these names.

    The shuffle deals ids and hashes; whole rows meet their places at the end.
    """
    marked = _marked(docs)
    rows = stored(marked.select("_id", "_row"))
    places = shuffle_to_shards(rows, 8).select("doc._id", "doc._row", "shard", "slot")
    return _with_places(marked, rows, places)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", not_toxic),
    ("near_duplicates", one_of_each_group),
    ("decontamination", not_contaminated),
    ("mixing", mix_sources),
    ("sharding", shards),
]

# The first stage is a learned classifier, which SQL cannot express; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each is written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
