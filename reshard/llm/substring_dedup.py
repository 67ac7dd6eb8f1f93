"""Substring dedup: long repeats of words, found from fixed blocks of earlier documents."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reshard.llm.common import attach, covered, join_counted, only, pieces, rolled, same, stored, window_minimum, word_hashes, written

REPEAT_WORDS = 50
# Words of the anchor of a block: its run of this length with the smallest hash.
ANCHOR_WORDS = 9


def block_words(width: int) -> int:
    """Blocks of half a repeat: wherever a repeat lies in a document, it holds one whole block."""
    return max(1, width // 2)


def anchors(words: np.ndarray, width: int) -> np.ndarray:
    """Anchor of every rolling window of one block's length. Equal windows have equal anchors, and neighbouring windows
    mostly share theirs, so that all windows of a document probe the index by few rows."""
    block = block_words(width)
    gram = min(ANCHOR_WORDS, block)
    grams = rolled(words, gram)
    return grams[window_minimum(grams, block - gram + 1)] if len(grams) >= block - gram + 1 else grams[:0]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("sum"), text.alias("text"))


def later_copies(rows: DataFrame) -> DataFrame:
    """id, sum of documents whose whole text also stands in a document with a smaller id."""
    kept = rows.select("id", "sum", F.md5("text").alias("digest"))
    first = kept.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    found = join_counted(kept, first, "digest", "n").where(F.col("first").isNotNull() & F.coalesce(F.col("first") < F.col("id"), F.lit(True)))
    return found.select("id", "sum").distinct()


def block_index(rows: DataFrame, width: int) -> DataFrame:
    """anchor, id, block: whether the anchor belongs to one of the non-overlapping blocks of the document, or only to
    other rolling windows of it. One row per document and anchor."""
    block = block_words(width)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            words, ends = word_hashes(piece.column("text"))
            found, owner, fixed = [], [], []
            for i in range(piece.num_rows):
                own = words[ends[i] : ends[i + 1]]
                if len(own) < width:
                    continue
                at = anchors(own, width)
                # Windows in a row share the anchor's hash; the fixed blocks are every block-th window.
                keys, inverse = np.unique(at, return_inverse=True)
                is_block = np.zeros(len(keys), bool)
                is_block[inverse[::block]] = True
                found.append(keys.view(np.int64))
                fixed.append(is_block)
                owner.append(np.full(len(keys), i))
            if found:
                ids = piece.column("id").take(pa.array(np.concatenate(owner)))
                columns = [pa.array(np.concatenate(found)), ids, pa.array(np.concatenate(fixed))]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "id", "block"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "text").mapInArrow(probe, f"anchor bigint, id {kind}, block boolean")


def live_anchors(index: DataFrame) -> DataFrame:
    """id, probes, blocks: anchors of a document's windows that an earlier document has in a block, and anchors of its
    blocks that a later document has in a window. NULL ids come after all others."""
    shared = index.groupBy("anchor").agg(
        F.min(F.when(F.col("block"), F.col("id"))).alias("first"),
        F.max("id").alias("last"),
        F.bool_or(F.col("id").isNull()).alias("open"),
    )
    # Stored, so that the join meets plain exchanges, whose crowded partitions can be split.
    shared = stored(shared.where(F.col("first").isNotNull() & (F.col("open") | (F.col("first") < F.col("last")))))
    met = index.join(shared, "anchor")
    probes = F.coalesce(F.col("first") < F.col("id"), F.lit(True))
    blocks = F.col("block") & F.col("id").isNotNull() & (F.col("open") | (F.col("last") > F.col("id")))
    met = met.select("id", F.when(probes, F.col("anchor")).alias("probe"), F.when(blocks, F.col("anchor")).alias("of"))
    met = met.where("probe IS NOT NULL OR of IS NOT NULL")
    return met.groupBy("id").agg(F.collect_set("probe").alias("probes"), F.collect_set("of").alias("blocks"))


def extended(rows: DataFrame, live: DataFrame, width: int) -> DataFrame:
    """All windows of the full length around a hit: w1, w2 (hash), id, sum, at, earlier (may be the first occurrence),
    later (may be a repeat)."""
    block = block_words(width)

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            words, ends = word_hashes(piece.column("text"))
            probes, blocks = piece.column("probes"), piece.column("blocks")
            out: list[list[np.ndarray]] = [[] for _ in range(6)]
            for i in range(piece.num_rows):
                own = words[ends[i] : ends[i + 1]]
                n = len(own) - width + 1
                if n <= 0:
                    continue
                at = anchors(own, width).view(np.int64)
                hit = np.isin(at, probes[i].values.to_numpy(zero_copy_only=False))
                fixed = np.zeros(len(at), bool)
                fixed[::block] = np.isin(at[::block], blocks[i].values.to_numpy(zero_copy_only=False))
                # A window of the full length counts when it holds a hit window of block length.
                later, earlier = (np.concatenate(([0], np.cumsum(x))) for x in (hit, fixed))
                reach = width - block + 1
                later, earlier = (x[reach : reach + n] > x[:n] for x in (later, earlier))
                starts = np.flatnonzero(later | earlier)
                if len(starts):
                    for column, values in zip(out, (
                        rolled(own, width)[starts].view(np.int64),
                        rolled(own, width, 1)[starts].astype(np.uint32).view(np.int32),
                        np.full(len(starts), i), starts.astype(np.int32), earlier[starts], later[starts],
                    )):
                        column.append(values)
            if out[0]:
                w1, w2, owner, starts, earlier, later = (np.concatenate(x) for x in out)
                owner = pa.array(owner)
                columns = [pa.array(w1), pa.array(w2), piece.column("id").take(owner), piece.column("sum").take(owner), pa.array(starts), pa.array(earlier), pa.array(later)]
                yield pa.RecordBatch.from_arrays(columns, ["w1", "w2", "id", "sum", "at", "earlier", "later"])

    joined = rows.alias("a").join(live.alias("b"), same("a", "b", ["id"])).select("a.*", "probes", "blocks")
    kind = rows.schema["id"].dataType.simpleString()
    return joined.mapInArrow(extend, f"w1 bigint, w2 int, id {kind}, sum bigint, at int, earlier boolean, later boolean")


def repeated_windows(
    docs: DataFrame, width: int = REPEAT_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, sum, starts: where windows of ``width`` words begin that also stand in a document with a smaller id.
    ``starts`` is NULL for a whole copy of an earlier document: all its windows are repeats.

    1. Documents are cut into non-overlapping blocks of half a repeat; the index holds the anchor of each block.
    2. Every rolling window of all documents probes it by its anchor, windows in a row by one row.
    3. Around hits all windows of full length are compared: the smallest id of each is added up before the shuffle, so a
       passage in a third of all documents is one row per task. The union of such windows is the maximal repeat.

    Anchors only choose what is compared; equality is by 96 bits of two independent hashes of the whole window.
    """
    rows = _keyed(docs, id_col, text_col)
    copies = stored(later_copies(rows))
    rows = only(rows, copies, ["id", "sum"], keep=False)
    live = stored(live_anchors(block_index(rows, width)))
    windows = written(extended(only(rows, live, ["id"]), live, width), "windows")
    first = stored(windows.where("earlier").groupBy("w1", "w2").agg(F.min("id").alias("first")))
    found = windows.where("later").select("w1", "w2", "id", "sum", "at").join(first, ["w1", "w2"])
    found = found.where(F.col("first").isNotNull() & F.coalesce(F.col("first") < F.col("id"), F.lit(True)))
    starts = found.groupBy("id", "sum").agg(F.collect_set("at").alias("starts"))  # at most one per word
    return stored(starts.unionByName(copies.withColumn("starts", F.lit(None).cast("array<int>"))))


def remove_repeats(
    docs: DataFrame,
    width: int = REPEAT_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_text: bool = True,
) -> DataFrame:
    """Per document: id, n_words, n_removed, spans (first word and end of each maximal removed run), kept (the words
    that stay, joined by spaces; left out unless ``with_text``) and kept_sha256.

    A word goes if a window of ``width`` words covers it that also starts in a document with a smaller id. Windows are
    judged on the input. NULL and empty texts have no words. Documents with equal ids do not remove each other's words;
    a NULL id counts as larger than all others. Texts shorter than a window keep all words. Other columns are ignored.
    """
    marks = repeated_windows(docs, width, id_col, text_col).withColumn("marked", F.lit(True))
    rows = attach(_keyed(docs, id_col, text_col), marks, ["id", "sum"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            out: list[list] = [[] for _ in range(5)]
            starts_of, marked_of = piece.column("starts"), piece.column("marked").to_pylist()
            for i, text in enumerate(piece.column("text")):
                words = text.as_py().encode().split()
                gone = np.zeros(len(words), bool)
                if marked_of[i]:
                    starts = starts_of[i].values
                    gone = np.full(len(words), len(words) >= width) if starts is None else covered(starts.to_numpy(), width, len(words))
                edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
                kept = b" ".join(words if not len(edges) else [w for w, g in zip(words, gone.tolist()) if not g])
                for column, value in zip(out, (len(words), int(gone.sum()), edges.reshape(-1, 2).tolist(), kept if with_text else None, hashlib.sha256(kept).hexdigest())):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int32())), pa.string(), pa.string())
            kept = pa.array(out[3], pa.binary()).cast(pa.string()) if with_text else pa.nulls(piece.num_rows, pa.string())
            columns = [kept if j == 3 else pa.array(c, k) for j, (c, k) in enumerate(zip(out, kinds))]
            yield pa.RecordBatch.from_arrays([piece.column("id"), *columns], ["id", "n_words", "n_removed", "spans", "kept", "kept_sha256"])

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_words bigint, n_removed bigint, spans array<array<int>>, kept string, kept_sha256 string"
    out = rows.select("id", "text", "starts", "marked").mapInArrow(cut, schema).withColumnRenamed("id", id_col)
    return out if with_text else out.drop("kept")
