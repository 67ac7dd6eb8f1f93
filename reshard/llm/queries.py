"""One query per operator over whole tables, with the columns agreed for it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reshard.llm.collocations import collocations
from reshard.llm.common import stored
from reshard.llm.decontamination import decontaminate
from reshard.llm.exact_dedup import exact_groups
from reshard.llm.html import extract_main_text
from reshard.llm.jaccard_join import jaccard_components
from reshard.llm.line_dedup import dedup_lines
from reshard.llm.mixing import deal_blocks, mix
from reshard.llm.sharding import shuffle_to_shards
from reshard.llm.substring_dedup import remove_repeats
from reshard.llm.suffix_dedup import remove_repeated_bytes
from reshard.llm.token_alignment import align_documents, link_quality, vocabulary_size
from reshard.llm.token_shards import read_documents, write_token_shards
from reshard.llm.toxicity import held_out, learn, toxicity_scores
from reshard.session import new_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document outside runs of 50 words that an earlier document has."""
    out = remove_repeats(table(spark, sf_dir, "documents"), with_text=False)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document that are no later occurrence of an equal or similar line."""
    return dedup_lines(table(spark, sf_dir, "documents"), by="grams").drop("kept")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that stand in a window of a benchmark item."""
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_sum")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each document outside strings of 400 bytes that begin anywhere else."""
    out = remove_repeated_bytes(table(spark, sf_dir, "documents"), with_bytes=False)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words each document gives to the mix: its copies in the blocks that are dealt to shards, times its size."""
    mixed = stored(mix(table(spark, sf_dir, "documents"), carry=["doc_id"]))
    # A document is told by its source and its rank there.
    copies = deal_blocks(mixed).groupBy(F.col("source").alias("_s"), F.col("rank").alias("_r")).agg(F.count("*").alias("n"))
    mixed = mixed.join(copies, F.col("source").eqNullSafe(F.col("_s")) & (F.col("rank") == F.col("_r")), "left")
    taken = (F.col("size") * F.coalesce("n", F.lit(0))).alias("taken")
    return mixed.select(F.col("doc.doc_id").alias("doc_id"), "size", "source_size", "target", taken)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts; the largest id stays."""
    return exact_groups(table(spark, sf_dir, "documents"), keep="largest")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of equal row counts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    out = shuffle_to_shards(docs, 8)
    return out.select(
        "doc.doc_id", "doc.size", "doc.text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with similar sets of shingles."""
    return jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text_sum")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each page."""
    out = extract_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each document, learned from the labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    grammar = learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity_scores(docs.select("doc_id", "text"), grammar)
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer's file on the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op11_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, written as compressed shards and read back."""
    path = new_folder(spark, "token-shards")
    docs = table(spark, sf_dir, "documents")
    write_token_shards(docs, path, tokenizer_file("word_bpe_49k.json"), end_id=1, by_word=True)
    return read_documents(spark, path, with_ids=False)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 phrases of each language whose words belong together most."""
    return collocations(table(spark, sf_dir, "documents"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned tokens of two tokenizers per document, and how common the linked pairs are."""
    second = tokenizer_file("piece_bpe_32k.model")
    rows = align_documents(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), second)
    keep = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    return link_quality(rows, vocabulary_size(second), keep)


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_line_dedup": op2_line_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_mixing": op5_mixing,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_sharding": op7_sharding,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_html_extraction": op9_html_extraction,
    "op10_toxicity": op10_toxicity,
    "op11_token_output": op11_token_output,
    "op12_collocations": op12_collocations,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}
