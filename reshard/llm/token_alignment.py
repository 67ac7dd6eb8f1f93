"""Alignment of the tokens of two tokenizers, and what pairs of ids are linked in how many documents.

Both tokenizers read a space and the text. Byte offsets at which a token of either ends cut the tokens into groups; every
token of one side is linked with every token of the other side in its group.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reshard.llm.common import pieces, written
from reshard.llm.tokens import JOINED, KEPT_CHARS, Kept, bpe_tokenizer, byte_classes, loaded, ranges, shipped, strings, words_of

# Pairs that are broadcast at most: the most frequent ones. Rarer pairs meet by shuffle, and none of them can be hot.
FREQUENT_PAIRS = 1 << 19
# Pieces of a text begin at spaces behind anything but white space.
PIECE_CLASSES = byte_classes(b"", b" ", b"\t\n\v\f\r")
PIECE_CUTS = ((3, 1),)
# Pieces whose alignment a worker keeps.
KEPT_PIECES = 250_000
# Characters of new pieces that are encoded and aligned at once; a longer piece is alone. Tokens take some hundred times that.
ALIGNED_CHARS = 1 << 18
# White space beyond ASCII, where rules of tokenizers differ: texts with it are one piece.
ODD_SPACE = r"[\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _byte_of() -> dict[str, int]:
    """Byte for each character of byte-level vocabularies: printable bytes stand for themselves, others follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(other)}}


class Sides:
    """Both tokenizers, and what is known of pieces of text: their ids, groups and links."""

    def __init__(self, byte_level: bytes, pieces_model: bytes) -> None:
        import sentencepiece

        self.a = bpe_tokenizer(byte_level, plain_specials=True)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces_model)
        byte_of = _byte_of()
        special = {i: t.content for i, t in self.a.get_added_tokens_decoder().items()}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for entry, i in self.a.get_vocab().items():
            self.a_bytes[i] = entry.encode() if i in special else bytes(byte_of[c] for c in entry)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            entry = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(entry[3:5], 16)]) if self.b.is_byte(i) else entry.replace("▁", " ").encode())
        self.b_space = self.b.piece_to_id("▁")
        self.a_lengths = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_lengths = np.array([len(x) for x in self.b_bytes], np.int64)
        self.a_parts, self.b_parts = pa.array(self.a_bytes, pa.large_binary()), pa.array(self.b_bytes, pa.large_binary())
        # Ids as they stand in the text of groups: behind each of the first side `,` or `|`, of the second `,` or `;`.
        shown = [f"{i}{end}" for i in range(len(self.a_bytes)) for end in ",|"] + [f"{i}{end}" for i in range(len(self.b_bytes)) for end in ",;"]
        self.shown = pa.array(shown, pa.large_string())
        self.kept = Kept(KEPT_PIECES)

    def _ids(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
        """Ids of both sides for texts that begin with a space, and which texts both sides give back byte by byte."""
        a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        # The second tokenizer adds the space itself, but makes nothing of nothing.
        b = [ids or [self.b_space] for ids in self.b.encode([t[1:] for t in texts], num_threads=1)]
        whole = [t.encode() for t in texts]
        same = np.ones(len(texts), bool)
        for ids, lengths, parts in ((a, self.a_lengths, self.a_parts), (b, self.b_lengths, self.b_parts)):
            flat = np.fromiter(chain.from_iterable(ids), np.int64)
            data = parts.take(pa.array(flat)).buffers()[2].to_pybytes()
            ends = np.cumsum(lengths[flat])[np.cumsum(list(map(len, ids))) - 1].tolist()
            start = 0
            for i, end in enumerate(ends):
                same[i] &= data[start:end] == whole[i]
                start = end
        return a, b, same

    def known(self, texts: list[str]) -> list[tuple]:
        """For texts that begin with a space: n_a, n_b, n_groups, groups as text, pairs and how often each is linked.

        The groups are None for a text that the tokens of one side do not give back. A pair is a * (size of the second
        vocabulary) + b. Texts that do not end with white space are encoded many at once, as neither tokenizer joins across
        the space that follows. A worker holds the tokens of ALIGNED_CHARS at a time, however many texts are new.
        """
        out, start, chars = [], 0, 0
        for i, text in enumerate(texts):
            if i > start and chars + len(text) > ALIGNED_CHARS:
                out += self._known(texts[start:i])
                start, chars = i, 0
            chars += len(text)
        return out + self._known(texts[start:])

    def _known(self, texts: list[str]) -> list[tuple]:
        """The same for a few texts, all at once."""
        out: list = [(0, 0, 0, None, b"", b"")] * len(texts)
        open_ = [i for i, t in enumerate(texts) if not t[-1].isspace() and len(t) <= KEPT_CHARS]
        units = [open_[i : i + JOINED] for i in range(0, len(open_), JOINED)]
        alone = set(range(len(texts))).difference(open_)
        a, b, same = self._ids(["".join([texts[i] for i in unit]) for unit in units]) if units else ([], [], [])
        good = [(unit, x, y) for unit, x, y, fine in zip(units, a, b, same) if fine]
        alone.update(i for unit, fine in zip(units, same) if not fine for i in unit)
        if alone:
            single = sorted(alone)
            good += [([i], x, y) for i, x, y, fine in zip(single, *self._ids([texts[i] for i in single])) if fine]
        if good:
            order = [i for unit, _, _ in good for i in unit]
            found = self._aligned(
                *(np.fromiter(chain.from_iterable([g[side] for g in good]), np.int64) for side in (1, 2)),
                np.cumsum([len(texts[i].encode()) for i in order]),
            )
            for i, value in zip(order, found):
                out[i] = value
        return out

    def _aligned(self, a: np.ndarray, b: np.ndarray, text_ends: np.ndarray) -> list[tuple]:
        """The same for texts that stand one behind the other, whose ends are ends of tokens on both sides."""
        size = len(self.b_bytes)
        a_at, b_at = end_index(self.a_lengths[a]), end_index(self.b_lengths[b])
        common = sorted(a_at.keys() & b_at.keys())
        groups = len(common)
        # Groups of a text, and tokens of a group on both sides.
        group_ends = np.searchsorted(np.array(common), text_ends, "right")
        a_ends = np.fromiter(map(a_at.__getitem__, common), np.int64, groups) + 1
        b_ends = np.fromiter(map(b_at.__getitem__, common), np.int64, groups) + 1
        a_sizes, b_sizes = np.diff(a_ends, prepend=0), np.diff(b_ends, prepend=0)
        a_group, b_group = np.repeat(np.arange(groups), a_sizes), np.repeat(np.arange(groups), b_sizes)
        texts = len(text_ends)
        text_of = np.repeat(np.arange(texts), np.diff(group_ends, prepend=0))

        # Text of the groups: tokens of a group's first side, then those of its second.
        a_last, b_last = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        a_last[a_ends - 1] = 1
        b_last[b_ends - 1] = 1
        codes = np.zeros(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + (b_ends - b_sizes)[a_group]] = 2 * a + a_last
        codes[np.arange(len(b)) + a_ends[b_group]] = 2 * len(self.a_bytes) + 2 * b + b_last
        shown = self.shown.take(pa.array(codes))
        data = shown.buffers()[2].to_pybytes()
        token_ends = (a_ends + b_ends)[group_ends - 1]
        shown_ends = np.frombuffer(shown.buffers()[1], np.int64)[token_ends]

        # Links: the different ids of both sides of each group, with how often they stand there, all with all.
        (a_of, a_ids, a_times), (b_of, b_ids, b_times) = _times(a_group, a), _times(b_group, b)
        b_starts, b_counts = np.searchsorted(b_of, np.arange(groups)), np.bincount(b_of, minlength=groups)
        each = b_counts[a_of]
        others = ranges(b_starts[a_of], each)
        pairs = np.repeat(a_ids, each) * size + b_ids[others]
        links = np.repeat(a_times, each) * b_times[others]
        of_text = np.repeat(text_of[a_of], each)
        order = np.lexsort((pairs, of_text))
        pairs, links, of_text = pairs[order], links[order], of_text[order]
        first = np.flatnonzero(np.concatenate(([True], (pairs[1:] != pairs[:-1]) | (of_text[1:] != of_text[:-1]))))
        pairs, links = pairs[first], np.add.reduceat(links, first)
        pair_ends = np.searchsorted(of_text[first], np.arange(texts), "right")

        n_a, n_b = np.diff(a_ends[group_ends - 1], prepend=0), np.diff(b_ends[group_ends - 1], prepend=0)
        n_groups = np.diff(group_ends, prepend=0)
        pairs_data, links_data = pairs.tobytes(), links.tobytes()
        out, shown_at, pair_at = [], 0, 0
        for x, y, g, s, p in zip(n_a.tolist(), n_b.tolist(), n_groups.tolist(), shown_ends.tolist(), (8 * pair_ends).tolist()):
            out.append((x, y, g, data[shown_at : s - 1], pairs_data[pair_at:p], links_data[pair_at:p]))
            shown_at, pair_at = s, p
        return out


def end_index(lengths: np.ndarray) -> dict[int, int]:
    """Byte offset at which each token ends -> its number."""
    ends = np.cumsum(lengths).tolist()
    return dict(zip(ends, range(len(ends))))


def _times(groups: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different (group, id) in order, with how often each occurs."""
    both = np.sort(groups << 32 | ids)
    first = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1])))
    return both[first] >> 32, both[first] & 0xFFFFFFFF, np.diff(np.append(first, len(both)))


def _cut(texts: pa.Array, whole: bool) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Different pieces of the texts, number of the piece at each place, and where each text's pieces begin (and the end)."""
    spaced = pc.binary_join_element_wise("", pc.fill_null(texts, ""), " ")
    if whole:
        names = spaced.to_pylist()
        return names, np.arange(len(names)), np.arange(len(names) + 1)
    found, _, offsets = words_of(spaced, PIECE_CLASSES, PIECE_CUTS)
    found = found.dictionary_encode()
    return strings(found.dictionary, "\0"), found.indices.to_numpy(zero_copy_only=False), offsets


def _documents(sides: Sides, texts: pa.Array, whole: bool) -> tuple[list, list[np.ndarray], list[np.ndarray]]:
    """Per text: (n_a, n_b, n_groups, n_links, groups as text or None), its different pairs, and links of each."""
    names, codes, offsets = _cut(texts, whole)
    found = sides.kept.of(names, sides.known)
    numbers = np.array([f[:3] for f in found], np.int64).reshape(-1, 3)
    shown = [f[3] for f in found]
    pairs = np.frombuffer(b"".join([f[4] for f in found]), np.int64)
    often = np.frombuffer(b"".join([f[5] for f in found]), np.int64)
    sizes = np.fromiter((len(f[4]) // 8 for f in found), np.int64, len(found))
    starts = np.cumsum(sizes) - sizes
    of_batch, pairs = np.unique(pairs, return_inverse=True)
    broken = np.fromiter((s is None for s in shown), bool, len(shown))
    sums = np.concatenate((np.zeros((1, 3), np.int64), np.cumsum(numbers[codes], axis=0)))
    totals = sums[offsets[1:]] - sums[offsets[:-1]]
    bad = np.concatenate(([0], np.cumsum(broken[codes])))
    bad = (bad[offsets[1:]] > bad[offsets[:-1]]) | pc.equal(pc.binary_length(pc.fill_null(texts, "")), 0).to_numpy(zero_copy_only=False)
    rows, per_pairs, per_often = [], [], []
    for i in range(len(texts)):
        if bad[i]:
            rows.append((0, 0, 0, 0, None))
            per_pairs.append(np.zeros(0, np.int64)), per_often.append(np.zeros(0, np.int64))
            continue
        mine = codes[offsets[i] : offsets[i + 1]]
        different, times = np.unique(mine, return_counts=True)
        places = ranges(starts[different], sizes[different])
        # Pieces share pairs, so their links are added up.
        numbers_of, links = pairs[places], often[places] * np.repeat(times, sizes[different])
        order = np.argsort(numbers_of, kind="stable")
        numbers_of, links = numbers_of[order], links[order]
        first = np.flatnonzero(np.concatenate(([True], numbers_of[1:] != numbers_of[:-1])))
        links = np.add.reduceat(links, first)
        per_pairs.append(of_batch[numbers_of[first]]), per_often.append(links)
        rows.append((*totals[i].tolist(), int(links.sum()), b";".join([shown[c] for c in mine.tolist()])))
    return rows, per_pairs, per_often


def align_documents(
    docs: DataFrame, byte_level: str, pieces_model: str, id_col: str = "doc_id", text_col: str = "text", with_groups: bool = False
) -> DataFrame:
    """row, id_col, n_a, n_b, n_groups, n_links, groups_sha256, pairs, links (of each pair) and, if asked for, groups.

    ``byte_level`` is the path of a byte-level BPE of the tokenizers library, ``pieces_model`` that of a sentencepiece model
    with byte fallback that adds the space itself; both are read on the driver. The groups are `a1,a2|b1;a3|b2,b3`.

    NULL and empty texts, and texts that the tokens of one side do not give back byte by byte, have no tokens. Repeated rows
    and ids are rows of their own, told apart by ``row``. A text is never cut, but pieces of it that come again are aligned
    only once, as both tokenizers never join across a space behind something else. An empty table gives none. Columns other
    than the two are not read, so their names do not matter. The result is written once to the shared folder.
    """
    spark = docs.sparkSession
    a_file, b_file = shipped(spark, byte_level), shipped(spark, pieces_model)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, links array<bigint>"
    schema += ", groups string" if with_groups else ""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = a_file.value + b_file.value
        sides = loaded("sides", files, lambda _: Sides(a_file.value, b_file.value))
        for batch in pieces(batches):
            odd = pc.fill_null(pc.match_substring_regex(batch.column("text"), ODD_SPACE), False)
            for whole in (False, True):
                part = batch.filter(odd if whole else pc.invert(odd))
                if not part.num_rows:
                    continue
                found, pairs, links = _documents(sides, part.column("text"), whole)
                at = np.concatenate(([0], np.cumsum([len(p) for p in pairs]))).astype(np.int32)
                shown = [f[4] for f in found]
                columns = [part.column("id"), *[pa.array([f[k] for f in found], pa.int64()) for k in range(4)]]
                columns.append(pa.array(["" if s is None else sha256(s).hexdigest() for s in shown]))
                columns += [pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(v))) for v in (pairs, links)]
                names = ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "links"]
                if with_groups:
                    columns.append(pa.array(["" if s is None else s.decode() for s in shown]))
                    names.append("groups")
                yield pa.RecordBatch.from_arrays(columns, names)

    out = rows.mapInArrow(read, schema).withColumn("row", F.monotonically_increasing_id())
    return written(out.withColumnRenamed("id", id_col), "aligned")


def pair_counts(aligned_rows: DataFrame) -> DataFrame:
    """pair, n (documents that hold it linked). Added up before the shuffle."""
    return aligned_rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))


def least_count(counts: DataFrame, most: int) -> int:
    """The smallest power of two such that at most ``most`` pairs have that count or more."""
    size = F.floor(F.log2("n")).cast("int").alias("size")
    by_size = {r["size"]: r["count"] for r in counts.groupBy(size).count().collect()}
    total, least = 0, 64
    while least > 0 and total + by_size.get(least - 1, 0) <= most:
        least -= 1
        total += by_size.get(least, 0)
    return 1 << min(least, 62)


def link_quality(aligned_rows: DataFrame, second_size: int, keep: list[str], frequent: int = FREQUENT_PAIRS) -> DataFrame:
    """Columns of ``keep``, n_best (links whose pair's count is the highest of its first id) and count_sum (over links).

    The most frequent pairs, at most ``frequent``, are broadcast; they meet the rows where these are. The rows of rarer pairs
    are shuffled by pair. None of these is hot: their counts lie below the smallest count of the others.
    """
    counts = written(pair_counts(aligned_rows), "pair-counts")
    a = F.floor(F.col("pair") / F.lit(second_size)).cast("bigint").alias("a")
    highest = counts.groupBy(a).agg(F.max("n").alias("highest"))
    judged = counts.withColumn("a", a).join(highest, "a").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))
    judged = written(judged, "pairs")
    least = least_count(counts, frequent)
    heavy, light = F.broadcast(judged.where(F.col("n") >= least)), judged.where(F.col("n") < least)
    row = ["row", *keep]

    def summed(rows: DataFrame) -> DataFrame:
        best, total = F.sum(F.when(F.col("best"), F.col("link")).otherwise(0)), F.sum(F.col("n") * F.col("link"))
        return rows.groupBy(*row).agg(F.coalesce(best, F.lit(0)).alias("n_best"), F.coalesce(total, F.lit(0)).alias("count_sum"))

    def linked(rows: DataFrame, how: str) -> DataFrame:
        explode = F.explode_outer if how == "outer" else F.explode
        zipped = explode(F.arrays_zip("pairs", "links")).alias("p")
        return rows.select(*row, zipped).select(*row, F.col("p.pairs").alias("pair"), F.col("p.links").alias("link"))

    out = summed(linked(aligned_rows, "outer").join(heavy, "pair", "left"))
    if least > 1 and not light.isEmpty():
        rest = linked(aligned_rows, "inner").join(heavy.select("pair"), "pair", "left_anti").join(light, "pair")
        parts = out.unionByName(summed(rest))
        out = parts.groupBy(*row).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return out.drop("row")


def vocabulary_size(pieces_model: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces_model).get_piece_size()


def shown_pair(pair: Column, second_size: int) -> Column:
    """The two ids of a pair."""
    return F.struct(F.floor(pair / F.lit(second_size)).cast("bigint").alias("a"), (pair % F.lit(second_size)).alias("b"))
