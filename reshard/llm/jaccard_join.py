"""N-gram Jaccard join that skips by relations between sets.

Index lists are cut into blocks by set size, and a pair of blocks whose sizes rule out the threshold is skipped whole.
Within a pair of blocks the overlaps of a set are derived from those of the most similar set before it: only postings of
the shingles in which the two differ are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from reshard.llm.common import ascii_lower, join_counted, only, pieces, rolled, stored, word_hashes, written
from reshard.llm.components import components

SHINGLE_WORDS = 5
# Links need this many hundredths of the union in common.
THRESHOLD = 80
# Hundredths of a set's shingles, by smallest hash, that are compared to find candidates.
SAMPLED = 32
# Lists up to this length give candidate pairs; longer ones go to blocks of sets.
SHORT_LIST = 24
# Tokens of a block; a set counts as LEAST_TOKENS at least.
BLOCK_TOKENS = 200_000
LEAST_TOKENS = 500


def shingle_sets(texts: pa.Array, width: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle, one without words has none."""
    words, ends = word_hashes(texts, lower=True)
    out = []
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        own = words[a:b]
        short = min(len(own), width)
        # The seed sets short sequences apart from full shingles.
        out.append(np.unique(rolled(own, short, width - short)) if short else own[:0])
    return out


def sampled(docs: DataFrame, threshold: int) -> DataFrame:
    """doc, n (size of its set), need, sample: the smallest hashes of its set.

    A set of n keeps at least t n shingles of any set it is linked with. Of its first s n by hash, the linked set of the
    pair whose sample ends first has at least (s - 1 + t) n in common with the other's sample; linked sizes differ by
    the factor t at most, so ``need`` holds for both.
    """
    share = min(100, max(SAMPLED, 100 - threshold + 2))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            sets = shingle_sets(piece.column("text"))
            n = np.array([len(s) for s in sets])
            kept = [s[: min(len(s), share * len(s) // 100 + 1)].view(np.int64) for s in sets]
            ends = np.concatenate(([0], np.cumsum([len(k) for k in kept]))).astype(np.int32)
            need = (share - 100 + threshold) * threshold * n // 10_000 + 1
            columns = [piece.column("doc"), pa.array(n.astype(np.int32)), pa.array(np.where(n > 0, need, 1).astype(np.int32))]
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(kept))))
            yield pa.RecordBatch.from_arrays(columns, ["doc", "n", "need", "sample"])

    schema = docs.select("doc").schema.add("n", "integer").add("need", "integer").add("sample", ArrayType(LongType()))
    return docs.select("doc", "text").mapInArrow(sample, schema)


def full_sets(docs: DataFrame) -> DataFrame:
    """doc, n, digest (of the whole set), tokens."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            sets = [s.view(np.int64) for s in shingle_sets(piece.column("text"))]
            ends = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            columns = [piece.column("doc"), pa.array(np.diff(ends)), pa.array(digests, pa.binary())]
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets))))
            yield pa.RecordBatch.from_arrays(columns, ["doc", "n", "digest", "tokens"])

    schema = docs.select("doc").schema.add("n", "integer").add("digest", "binary").add("tokens", ArrayType(LongType()))
    return docs.select("doc", "text").mapInArrow(collect, schema)


def derived_overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> Iterator[np.ndarray]:
    """For each set on the left its overlaps with all sets on the right.

    The first overlaps are counted from the postings of all tokens; later ones follow from the set before, by the
    postings of the tokens that came and went, when these are fewer.
    """
    tokens, owner = np.concatenate(right), np.repeat(np.arange(len(right)), [len(r) for r in right])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]

    def posted(of: np.ndarray) -> np.ndarray:
        a, b = np.searchsorted(tokens, of, "left"), np.searchsorted(tokens, of, "right")
        size = b - a
        places = np.arange(size.sum()) + np.repeat(a - np.concatenate(([0], np.cumsum(size)[:-1])), size)
        return np.bincount(owner[places], minlength=len(right))

    last, overlaps = np.zeros(0, np.int64), np.zeros(len(right), np.int64)
    for own in left:
        came, went = np.setdiff1d(own, last, True), np.setdiff1d(last, own, True)
        if len(came) + len(went) < len(own):
            overlaps = overlaps + posted(came) - posted(went)
        else:
            overlaps = posted(own)
        last = own
        yield overlaps


def similar_order(sets: list[np.ndarray]) -> list[int]:
    """Places of the sets so that neighbours are alike: by their smallest tokens."""
    return sorted(range(len(sets)), key=lambda i: sets[i][:8].tolist())


def linked_in_block(a: list[np.ndarray], b: list[np.ndarray], weight: np.ndarray, same_block: bool, threshold: int):
    """Links of one pair of blocks: how many rows each set of ``a`` and of ``b`` is linked with, and edges that connect
    what is linked (a forest, not all links)."""
    sizes_a, sizes_b = (np.array([len(s) for s in x]) for x in (a, b))
    links_a, links_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    parent = list(range(len(a) + (0 if same_block else len(b))))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    forest = []
    order = similar_order(a)
    for i, overlaps in zip(order, derived_overlaps([a[i] for i in order], b)):
        hit = (100 + threshold) * overlaps >= threshold * (sizes_a[i] + sizes_b)
        if same_block:
            hit[i] = False
        places = np.flatnonzero(hit)
        links_a[i] = weight[1][places].sum()
        if not same_block:
            links_b[places] += weight[0][i]
        for j in places.tolist():
            x, y = root(i), root(j if same_block else len(a) + j)
            if x != y:
                parent[x] = y
                forest.append((i, j))
    return links_a, links_b, forest


def block_links(sets: DataFrame, groups: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame]:
    """Links within groups of sets that long lists hold together: (edges a, b; doc, links).

    ``groups`` is doc, root. The sets of a group are sorted by size and cut into blocks; pairs of blocks are tasks of
    their own, so a group of any size is spread, and pairs whose sizes differ too much are never formed.
    """
    rows = sets.alias("s").join(groups.alias("g"), F.col("s.doc") == F.col("g.doc")).select("s.*", "g.root")
    # One row per group and size; a size with many sets is dealt to several blocks by a hash.
    volume = F.sum(F.greatest(F.col("n"), F.lit(LEAST_TOKENS))).alias("volume")
    smaller = Window.partitionBy("root").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("root", "n").agg(volume).select(
        "root", "n", F.ceil(F.col("volume") / BLOCK_TOKENS).alias("parts"),
        F.floor(F.coalesce(F.sum("volume").over(smaller), F.lit(0)) / BLOCK_TOKENS).alias("from"),
    )
    block = (F.col("from") + F.pmod(F.xxhash64("doc"), F.col("parts"))).cast("int").alias("block")
    sizes = stored(rows.select("doc", "root", "n").join(sizes, ["root", "n"]).select("doc", "root", "n", block))
    blocks = stored(sizes.groupBy("root", "block").agg(F.min("n").alias("low"), F.max("n").alias("high")))
    a, b = blocks.alias("a"), blocks.alias("b")
    near = F.col("a.high") * 100 >= F.col("b.low") * threshold
    pairs = a.join(b, (F.col("a.root") == F.col("b.root")) & (F.col("a.block") <= F.col("b.block")) & near)
    pairs = pairs.select(F.col("a.root").alias("root"), F.col("a.block").alias("i"), F.col("b.block").alias("j"))
    ends = pairs.withColumn("end", F.explode(F.array("i", "j"))).distinct()
    rows = rows.join(sizes.select("doc", "block"), "doc")
    rows = rows.alias("r").join(
        ends.alias("e"), (F.col("r.root") == F.col("e.root")) & (F.col("r.block") == F.col("e.end"))
    )
    rows = rows.select(F.col("r.root").alias("root"), "i", "j", "block", "doc", "tokens", "weight")

    def link(key: tuple, table: pa.Table) -> pa.Table:
        i, j = (v.as_py() for v in key[1:])
        table = table.combine_chunks()
        where = table.column("block").to_numpy()
        tokens = table.column("tokens").chunk(0)
        ends, flat = tokens.offsets.to_numpy(), tokens.values.to_numpy(zero_copy_only=False)
        sets = [flat[ends[k] : ends[k + 1]] for k in range(len(where))]
        weight = table.column("weight").to_numpy()
        left, right = np.flatnonzero(where == i), np.flatnonzero(where == j)
        links_a, links_b, forest = linked_in_block([sets[k] for k in left], [sets[k] for k in right], (weight[left], weight[right]), i == j, threshold)
        first = [int(left[x]) for x, _ in forest] + left.tolist() + ([] if i == j else right.tolist())
        second = [int(right[y]) for _, y in forest] + [None] * (len(left) + (0 if i == j else len(right)))
        links = [0] * len(forest) + links_a.tolist() + ([] if i == j else links_b.tolist())
        docs = table.column("doc").chunk(0)
        return pa.table([docs.take(pa.array(first, pa.int64())), docs.take(pa.array(second, pa.int64())), pa.array(links, pa.int64())], ["a", "b", "links"])

    schema = rows.select(F.col("doc").alias("a"), F.col("doc").alias("b")).schema.add("links", "long")
    found = stored(rows.groupBy("root", "i", "j").applyInArrow(link, schema))
    counted = found.where("b IS NULL").groupBy(F.col("a").alias("doc")).agg(F.sum("links").alias("links"))
    return found.where("b IS NOT NULL").select("a", "b"), counted


def pair_links(sets: DataFrame, pairs: DataFrame, threshold: int) -> DataFrame:
    """a, b, wa, wb: candidate pairs that are linked, compared by their whole sets."""
    a = pairs.join(sets.select(F.col("doc").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"), F.col("weight").alias("wa")), "a")
    both = a.join(sets.select(F.col("doc").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"), F.col("weight").alias("wb")), "b")
    common = F.size(F.array_intersect("ta", "tb"))
    return both.where((100 + threshold) * common >= threshold * (F.col("na") + F.col("nb"))).select("a", "b", "wa", "wb")


def jaccard_components(
    docs: DataFrame, threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id reachable by links), n_links (rows it is linked
    with), text_sum (xxhash64 of the lower-cased text, tells rows with equal ids apart). Two rows are linked when their sets of distinct shingles have ``threshold`` hundredths of the union in common.

    1. Equal texts, later equal sets, are one set with a weight.
    2. Only sets that share enough of the sample of their smallest hashes with others can have a link; the rest is done.
    3. Of the shared hashes the rarest are kept, as many as a link must meet. Short lists give candidate pairs, which are
       compared in full. Sets connected by long lists are compared block by block, with skipping.
    4. Components are found by rounds of joins.

    All links between different sets are found; copies are counted, not paired. NULL and empty texts have no shingles
    and are linked with nothing. A NULL id is larger than all others. Rows with equal id and text get equal rows.
    """
    text = ascii_lower(F.col(text_col))
    rows = docs.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("sum")).alias("doc"), text.alias("text"))
    texts = rows.select("doc", F.md5("text").alias("digest"))
    first = texts.groupBy("digest").agg(F.min("doc").alias("first"), F.count("*").alias("weight"))
    texts = written(join_counted(texts, first, "digest", "weight").select("doc", "first", "weight"), "texts")
    again = texts.where(F.col("doc") != F.col("first")).select("doc")
    single = only(rows, again, ["doc"], keep=False)

    samples = written(sampled(single, threshold), "samples")
    hashes = samples.select("doc", "need", F.explode("sample").alias("h"))
    # Stored, so that the join meets plain exchanges, whose crowded partitions can be split.
    shared = stored(hashes.groupBy("h").agg(F.count("*").alias("df")).where("df > 1"))
    met = written(hashes.join(shared, "h"), "shared")
    enough = met.groupBy("doc", "need").agg(F.count("*").alias("q")).where("q >= need")
    enough = stored(enough.select("doc", (F.col("q") - F.col("need") + 1).alias("keep")))

    sets = full_sets(only(single, enough, ["doc"]))
    sets = sets.join(texts.where(F.col("doc") == F.col("first")).select("doc", F.col("weight").alias("copies")).distinct(), "doc")
    sets = written(sets.dropDuplicates(["doc"]), "sets")
    kinds = sets.groupBy("digest").agg(F.min("doc").alias("set"), F.sum("copies").alias("weight"))
    members = stored(sets.select("doc", "digest").join(kinds, "digest").select("doc", "set", "weight"))
    leaders = members.where(F.col("doc") == F.col("set")).select("doc", "weight")
    sets = written(sets.drop("copies", "digest").join(leaders, "doc"), "leaders")

    rarest = Window.partitionBy("doc").orderBy("df", "h")
    signs = met.join(enough, "doc").join(leaders.select("doc"), "doc").select("doc", "h", "keep", F.row_number().over(rarest).alias("r"))
    signs = signs.where("r <= keep").select("doc", "h").join(sets.select("doc", "n"), "doc")
    signs = written(signs, "signs")
    lists = stored(signs.groupBy("h").agg(F.count("*").alias("c"), F.min("doc").alias("hub")).where("c > 1"))

    long = signs.join(lists.where(F.col("c") > SHORT_LIST), "h").select("doc", "hub").distinct()
    groups = stored(components(long, "doc", "hub").select(F.col("node").alias("doc"), "root"))
    inner, counted = block_links(sets, groups, threshold)

    short = signs.join(lists.where(F.col("c") <= SHORT_LIST).select("h"), "h").join(groups, "doc", "left")
    a, b = short.alias("a"), short.alias("b")
    apart = ~F.coalesce(F.col("a.root") == F.col("b.root"), F.lit(False))
    near = (F.least("a.n", "b.n") * 100 >= F.greatest("a.n", "b.n") * threshold) & apart
    pairs = a.join(b, (F.col("a.h") == F.col("b.h")) & (F.col("a.doc") < F.col("b.doc")) & near)
    pairs = pairs.select(F.col("a.doc").alias("a"), F.col("b.doc").alias("b")).distinct()
    pairs = stored(pair_links(sets, pairs, threshold))

    links = pairs.select(F.col("a").alias("doc"), F.col("wb").alias("links"))
    links = links.unionByName(pairs.select(F.col("b").alias("doc"), F.col("wa").alias("links"))).unionByName(counted)
    links = links.groupBy("doc").agg(F.sum("links").alias("links"))
    roots = components(pairs.select("a", "b").unionByName(inner)).select(F.col("node").alias("doc"), "root")
    sets_out = leaders.join(links, "doc", "left").join(roots, "doc", "left")
    sets_out = sets_out.select(F.col("doc").alias("set"), F.coalesce("root", "doc").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    by_text = members.join(sets_out, "set").select(F.col("doc").alias("first"), "root", "links", F.col("weight").alias("all"))

    of_text = samples.select(F.col("doc").alias("first"), "n").distinct().join(by_text, "first", "left")
    counted = texts.where(F.col("doc") == F.col("first")).select("first", F.col("weight").alias("size")).distinct()
    out = join_counted(texts, of_text.join(counted, "first"), "first", "size")
    root = F.when(F.col("n") > 0, F.coalesce("root", "first")).otherwise(F.col("doc"))
    links = F.when(F.col("n") > 0, F.coalesce("links", F.lit(0)) + F.coalesce("all", "weight") - 1).otherwise(F.lit(0))
    out = out.select("doc", "n", root.alias("root"), links.alias("links"))
    out = written(out, "rooted")
    lowest = out.groupBy("root").agg(F.min("doc.id").alias("lowest"), F.count("*").alias("size"))
    out = join_counted(out, lowest, "root", "size")
    return out.select(
        F.col("doc.id").alias(id_col),
        F.col("n").cast("long").alias("n_shingles"),
        F.col("lowest").alias("component_id"),
        F.col("links").alias("n_links"),
        F.col("doc.sum").alias("text_sum"),
    )
