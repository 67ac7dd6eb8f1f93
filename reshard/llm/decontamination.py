"""Benchmark decontamination by a positional inverted index of the training text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reshard.llm.common import ascii_lower, stored, written
from reshard.session import broadcast_if_small

WINDOW_WORDS = 13
# What separates words: ASCII but digits and a-z, after A-Z is lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# A word before A-Z is lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-cased words of a text in order; NULL has none."""
    inner = F.regexp_replace(ascii_lower(text), rf"^{BETWEEN}", "")
    words = F.split(inner, BETWEEN)
    # A separator at the end leaves an empty last word, a text without words one empty word.
    return F.when(F.element_at(words, -1) == "", F.slice(words, 1, F.size(words) - 1)).otherwise(words)


def words_in(text: Column) -> Column:
    """How many words a text has. No list of them is made, and lower case changes no border between words."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0))


def row_key(id_col: str, text_col: str) -> Column:
    """Rows with equal ids and texts share their matches."""
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("sum"))


def test_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", width: int = WINDOW_WORDS) -> DataFrame:
    """item, words: each run of ``width`` words of an item; a shorter item is one run, one without words has none.
    Ids are taken as strings, NULL as the empty one; equal runs of an item count once."""
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), words_of(F.col(text_col)).alias("all"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - width + 1, F.lit(1)))
    rows = rows.where(F.size("all") > 0).select("item", "all", F.explode(starts).alias("at"))
    return rows.select("item", F.slice("all", F.col("at"), width).alias("words")).distinct()


def split_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, words, n_words of each row. NULL has no words."""
    rows = docs.select(row_key(id_col, text_col).alias("doc"), words_of(F.col(text_col)).alias("words"))
    return rows.select("doc", "words", F.size("words").cast("long").alias("n_words"))


def with_rarest_term(windows: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Windows whose words all occur in the documents, with their rarest word (``term``) and its place (``offset``).

    Occurrences are counted over all documents, added up before the shuffle.
    """
    return _with_rarest_term(windows, split_texts(docs, id_col, text_col))


def _with_rarest_term(windows: DataFrame, split: DataFrame) -> DataFrame:
    """The same for texts that are split already."""
    terms = windows.select(F.explode("words").alias("term")).distinct()
    counted = split.select(F.explode("words").alias("term")).join(broadcast_if_small(terms), "term")
    counted = stored(counted.groupBy("term").agg(F.count("*").alias("n")))
    placed = windows.select("item", "words", F.posexplode("words").alias("offset", "term"))
    placed = placed.join(broadcast_if_small(counted), "term", "left")
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("term"), F.col("offset"))).alias("rarest")
    chosen = placed.groupBy("item", "words").agg(rarest).where(F.col("rarest.n") > 0)
    return chosen.select("item", "words", "rarest.term", "rarest.offset")


def build_index(
    docs: DataFrame, terms: DataFrame, radius: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Postings of the given terms in the documents: term, doc, at (place of the word), before, context.

    ``context`` holds the words up to ``radius`` places around, ``before`` how many of them come first, so that the
    lists of all other terms near a posting are at hand without a further shuffle. Every occurrence in every document
    is stored, in the shared folder. The documents are not shuffled while the terms are few enough to be broadcast.
    """
    return _build_index(split_texts(docs, id_col, text_col), terms, radius)


def _build_index(split: DataFrame, terms: DataFrame, radius: int) -> DataFrame:
    """The same for texts that are split already."""
    found = split.select("doc", "words", F.posexplode("words").alias("at", "term")).join(broadcast_if_small(terms.select("term").distinct()), "term")
    first = F.greatest(F.col("at") - radius, F.lit(0))
    context = F.slice("words", first + 1, F.col("at") - first + radius + 1)
    return stored(found.select("term", "doc", "at", (F.col("at") - first).alias("before"), context.alias("context")))


def phrase_matches(index: DataFrame, windows: DataFrame) -> DataFrame:
    """doc, item, start, length of each exact occurrence of a window.

    The list of the window's rarest term is shifted by the term's offset; where the words around agree with all other
    terms at their offsets, the lists intersect.
    """
    met = index.join(broadcast_if_small(windows), "term")
    length = F.size("words")
    first = F.col("before") - F.col("offset")
    met = met.where((first >= 0) & (F.slice("context", F.greatest(first, F.lit(0)) + 1, length) == F.col("words")))
    return met.select("doc", "item", (F.col("at") - F.col("offset")).alias("start"), length.alias("length"))


def proximity_matches(index: DataFrame, windows: DataFrame, span: int) -> DataFrame:
    """doc, item, at: places of the rarest term with all words of the window at most ``span`` places away, in any order.

    The index must have been built with at least this radius.
    """
    met = index.join(broadcast_if_small(windows), "term")
    first = F.greatest(F.col("before") - span, F.lit(0))
    near = F.slice("context", first + 1, F.col("before") - first + span + 1)
    return met.where(F.size(F.array_except("words", near)) == 0).select("doc", "item", "at").distinct()


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WINDOW_WORDS,
    one_in: int = 20,
) -> DataFrame:
    """Per document: id, n_words, n_hit (words inside an occurrence of a window), n_items, items_sha256, contaminated
    (at least one word of ``one_in`` is hit), text_sum (xxhash64 of the text, tells rows with equal ids apart).

    Whole texts are read. NULL and empty texts have no words and are clean, also against an empty benchmark. A word hit
    by several windows counts once. Rows with equal id and text get equal results; other columns are ignored. Texts are split
    once: their words go to the shared folder.
    """
    split = written(split_texts(docs, id_col, text_col), "words")
    windows = stored(_with_rarest_term(stored(test_windows(items, item_id, item_text, width)), split))
    index = _build_index(split, windows, width - 1)
    found = stored(phrase_matches(index, windows))
    spans = found.select("doc", "start", (F.col("start") + F.col("length")).alias("end")).distinct()
    # At most one place after the other within one document.
    earlier = Window.partitionBy("doc").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.greatest(F.coalesce(F.max("end").over(earlier), F.lit(0)), F.col("start"))
    spans = spans.withColumn("new", F.greatest(F.col("end") - reached, F.lit(0)))
    hits = spans.groupBy("doc").agg(F.sum("new").alias("n_hit"))
    named = found.select("doc", "item").distinct().groupBy("doc").agg(F.sort_array(F.collect_list("item")).alias("items"))
    hits = hits.join(named, "doc")

    rows = split.select("doc", "n_words")
    on = F.col("doc.id").eqNullSafe(F.col("hit.id")) & (F.col("doc.sum") == F.col("hit.sum"))
    out = rows.join(hits.withColumnRenamed("doc", "hit"), on, "left")
    n_hit = F.coalesce("n_hit", F.lit(0))
    items_found = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        F.col("doc.id").alias(id_col),
        "n_words",
        n_hit.cast("long").alias("n_hit"),
        F.size(items_found).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_found, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (one_in * n_hit >= F.col("n_words"))).alias("contaminated"),
        F.col("doc.sum").alias("text_sum"),
    )
