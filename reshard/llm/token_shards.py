"""Token ids as binary shards, compressed by a grammar of frequent pairs, with random access.

Documents are dealt to tasks by ranges of their ids, so that the order of shards is the order of documents. A task encodes
them, cuts the ids into shards and writes each as one binary body:

    header      magic "RPG2", first nonterminal, rules, symbols, ids, documents, bits per symbol, bits per length
    rules       two symbols per rule; rule k makes the nonterminal first + k, from symbols below it
    lengths     ids that each rule stands for
    symbols     the compressed ids
    ends        ids up to the end of each document, 64 bits each

Rules and symbols are packed to the bits that the largest symbol needs, lengths to those of the largest length. A place in the ids is found by adding up the lengths
of the symbols before it, so a range of ids is decoded from the symbols that cover it and the rules alone.

The folder has ``shards`` (part, shard, n_docs, n_ids, doc_ids, body) and ``index`` (part, shard, start, n_docs, n_ids),
which are Parquet files: Spark commits them as a whole, and the index is read without any body.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reshard.llm.common import PIECE_BYTES, pieces
from reshard.llm.tokens import WordIds, bpe_tokenizer, loaded, ranges, shipped
from reshard.session import broadcast_if_small

MAGIC = b"RPG2"
HEADER = struct.Struct("<4sIIIQQII")
# A shard ends with the document that reaches so many ids.
SHARD_IDS = 1 << 20
# A pair becomes a rule while it occurs so often without overlaps: all that repeats is replaced.
LEAST_PAIRS = 2
# A round replaces all pairs that are at least 1 / ROUND_SHARE as frequent as the most frequent one.
ROUND_SHARE = 128
# Slots of the table in which a round looks pairs up; of pairs that meet in a slot the less frequent ones wait.
TABLE_BITS = 17
# Slots in which a round counts pairs before it counts the frequent ones exactly.
COUNT_BITS = 20


# --- grammar ---------------------------------------------------------------------------------------------------------


def _chosen(places: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Which of the places of pairs to replace, so that none overlap: the better ranked of neighbours, every other in a run.
    Ranks begin at 1, the best."""
    near = places[1:] == places[:-1] + 1
    better, same = ranks[1:] < ranks[:-1], ranks[1:] == ranks[:-1]
    chosen = np.ones(len(places), bool)
    chosen[:-1] &= ~(near & better)
    chosen[1:] &= ~near | better | same
    run = near & same
    if run.any():
        at = np.arange(len(places))
        begin = np.maximum.accumulate(np.where(np.concatenate(([True], ~run)), at, 0))
        chosen &= ((at - begin) & 1) == 0
    return chosen


def _spread(pairs: np.ndarray, turn: int) -> np.ndarray:
    """Hashes of pairs whose high bits depend on both symbols. Pairs that meet in one turn do not meet in the next."""
    factor = np.uint64((0x9E3779B97F4A7C15 + turn * 0xD6E8FEB86659FD92) & 0xFFFFFFFFFFFFFFFF)
    hashed = pairs * factor
    hashed ^= hashed >> np.uint64(32)
    hashed *= factor
    return hashed


def _apart(symbols: np.ndarray, places: np.ndarray) -> np.ndarray | slice:
    """Which places to take without every other one in a run of one symbol, where a pair overlaps itself."""
    alike = np.flatnonzero(symbols[places] == symbols[places + 1])
    if not len(alike):
        return slice(None)
    at, runs = np.arange(len(alike)), places[alike]
    begin = np.maximum.accumulate(np.where(np.concatenate(([True], runs[1:] != runs[:-1] + 1)), at, 0))
    out = np.ones(len(places), bool)
    out[alike[(at - begin) & 1 == 1]] = False
    return out


def compress(ids: np.ndarray, least: int = LEAST_PAIRS) -> tuple[int, np.ndarray, np.ndarray]:
    """First nonterminal, rules (pairs of symbols) and symbols of a grammar that yields the ids.

    The frequent pairs of neighbours are replaced by nonterminals, the most frequent ones first where pairs overlap, round
    by round, until none occurs ``least`` times without overlaps. A pair that is hardly left when its turn comes, as its
    symbols went to better ones, gets no rule then. The most frequent pair of a round always gets one, so rounds end.

    A pair only gets rarer, and new pairs hold a nonterminal of the last round. So a round looks only at places that had
    a pair frequent enough (by a hash, which counts too many at most), or that are beside a new nonterminal.
    """
    first = int(ids.max()) + 1 if len(ids) else 0
    symbols, rules, made = ids.astype(np.uint32), [np.zeros(0, np.uint64)], 0
    shift, count_shift = np.uint64(64 - TABLE_BITS), np.uint64(64 - COUNT_BITS)
    live = np.arange(len(symbols) - 1)
    while len(live):
        pairs = symbols[live].astype(np.uint64)
        pairs <<= np.uint64(32)
        pairs |= symbols[live + 1]
        hashed = _spread(pairs, len(rules))
        if made:
            slots = (hashed >> count_shift).astype(np.intp)
            enough = np.bincount(slots, minlength=1 << COUNT_BITS)[slots] >= least
            live, pairs, hashed = live[enough], pairs[enough], hashed[enough]
        apart = _apart(symbols, live)
        at, pairs, hashed = live[apart], pairs[apart], hashed[apart]
        if not len(at):
            break
        ordered = np.sort(pairs)
        edges = np.concatenate(([0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1, [len(ordered)]))
        counts = np.diff(edges)
        often = np.flatnonzero(counts >= max(least, int(counts.max()) // ROUND_SHARE))
        if not len(often):
            break
        # Ascending, so that of pairs that meet in a slot of the table the most frequent one is written last. Equally
        # frequent ones are spread, or a text of neighbouring ids would keep all but one of them for later.
        wanted, counts = ordered[edges[often]], counts[often]
        keys = _spread(wanted, len(rules))
        order = np.lexsort((keys, counts))
        wanted, slots = wanted[order], keys[order] >> shift
        table, rank_of = np.zeros(1 << TABLE_BITS, np.uint64), np.zeros(1 << TABLE_BITS, np.int32)
        table[slots] = wanted
        rank_of[slots] = np.arange(len(wanted), 0, -1, dtype=np.int32)
        slots = hashed >> shift
        # The pair of two zeros looks like an empty slot, of which it has one when it is wanted.
        found = np.flatnonzero((table[slots] == pairs) & (rank_of[slots] > 0))
        places, ranks = at[found], rank_of[slots[found]]
        chosen = _chosen(places, ranks)
        places, ranks = places[chosen], ranks[chosen]
        kept = np.bincount(ranks, minlength=len(wanted) + 1) >= min(least, 4)
        places, ranks = places[kept[ranks]], ranks[kept[ranks]]
        symbols[places] = (np.cumsum(kept) - 1 + first + made)[ranks]
        again = np.zeros(len(symbols), bool)
        again[live] = again[places] = again[np.maximum(places - 1, 0)] = True
        left = np.ones(len(symbols), bool)
        left[places + 1] = False
        symbols = symbols[left]
        live = np.flatnonzero(again[left][:-1])
        new = wanted[len(wanted) - np.flatnonzero(kept)]
        rules.append(new)
        made += len(new)
    sides = np.concatenate(rules)
    return first, np.stack((sides >> np.uint64(32), sides & np.uint64(0xFFFFFFFF)), axis=1).astype(np.uint32), symbols


def rule_lengths(first: int, rules: np.ndarray) -> np.ndarray:
    """How many ids each rule stands for. Rules refer to earlier ones only, so whole levels are added up at once."""
    lengths = np.zeros(len(rules), np.int64)
    while len(open_ := np.flatnonzero(lengths == 0)):
        sides = rules[open_].astype(np.int64)
        known = np.where(sides < first, 1, lengths[np.maximum(sides - first, 0)])
        ready = (known > 0).all(axis=1)
        lengths[open_[ready]] = known[ready].sum(axis=1)
    return lengths


def expand(first: int, rules: np.ndarray, lengths: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Ids that the symbols stand for. Rules are written out first, then all symbols are looked up at once."""
    out = rules.reshape(-1)
    while (deep := out >= first).any():
        children = np.where(deep, 2, 1)
        starts = np.cumsum(children) - children
        grown = np.zeros(int(children.sum()), np.uint32)
        grown[starts] = np.where(deep, rules[np.where(deep, out - first, 0), 0] if len(rules) else 0, out)
        grown[starts[deep] + 1] = rules[out[deep] - first, 1]
        out = grown
    rule_starts = np.cumsum(lengths) - lengths
    # Terminals follow the written-out rules in one table of places.
    terminal = symbols < first
    which = np.where(terminal, 0, symbols.astype(np.int64) - first)
    sizes = np.where(terminal, 1, lengths[which] if len(lengths) else 1)
    starts = np.where(terminal, len(out) + np.arange(len(symbols)), rule_starts[which] if len(lengths) else 0)
    return np.concatenate((out, symbols))[ranges(starts, sizes)]


# --- bodies ----------------------------------------------------------------------------------------------------------


def _packed(values: np.ndarray, bits: int) -> bytes:
    wide = values.astype(">u4").view(np.uint8).reshape(-1, 4)
    return np.packbits(np.unpackbits(wide, axis=1)[:, 32 - bits :]).tobytes()


def _unpacked(data: memoryview, count: int, bits: int) -> np.ndarray:
    flags = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits).reshape(count, bits)
    wide = np.zeros((count, 32), np.uint8)
    wide[:, 32 - bits :] = flags
    return np.packbits(wide, axis=1).view(">u4").reshape(-1).astype(np.uint32)


def make_body(ids: np.ndarray, ends: np.ndarray, least: int = LEAST_PAIRS) -> bytes:
    """Binary form of a shard with these ids, whose documents end at ``ends``."""
    first, rules, symbols = compress(ids, least)
    bits = max(1, (first + len(rules)).bit_length())
    lengths = rule_lengths(first, rules)
    wide = int(lengths.max(initial=1)).bit_length()
    head = HEADER.pack(MAGIC, first, len(rules), len(symbols), len(ids), len(ends), bits, wide)
    parts = (_packed(rules.reshape(-1), bits), _packed(lengths, wide), _packed(symbols, bits), ends.astype("<u8").tobytes())
    return b"".join((head, *parts))


class Body:
    """A shard's body, of which ranges of ids can be read."""

    def __init__(self, data: bytes) -> None:
        magic, self.first, n_rules, n_symbols, self.n_ids, n_docs, bits, wide = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at, view = HEADER.size, memoryview(data)

        def take(size: int) -> memoryview:
            nonlocal at
            at += size
            return view[at - size : at]

        self.rules = _unpacked(take(-(-2 * n_rules * bits // 8)), 2 * n_rules, bits).reshape(-1, 2)
        self.lengths = _unpacked(take(-(-n_rules * wide // 8)), n_rules, wide).astype(np.int64)
        self.symbols = _unpacked(take(-(-n_symbols * bits // 8)), n_symbols, bits)
        self.ends = np.frombuffer(take(8 * n_docs), "<u8").astype(np.int64)

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """The ids [start, stop): only the symbols that cover them are expanded."""
        stop = self.n_ids if stop is None else min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, np.uint32)
        if start == 0 and stop == self.n_ids:
            return expand(self.first, self.rules, self.lengths, self.symbols)
        nested = self.symbols.astype(np.int64) - self.first
        sizes = np.where(nested < 0, 1, self.lengths[np.maximum(nested, 0)] if len(self.lengths) else 1)
        ends = np.cumsum(sizes)
        a, z = np.searchsorted(ends, [start, stop - 1], "right")
        found = expand(self.first, self.rules, self.lengths, self.symbols[a : z + 1])
        skipped = int(ends[a] - sizes[a])
        return found[start - skipped : stop - skipped]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.ends[i - 1]) if i else 0, int(self.ends[i]))


# --- Spark -----------------------------------------------------------------------------------------------------------


def write_token_shards(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, by_word: bool = False,
    id_col: str = "doc_id", text_col: str = "text", shard_ids: int = SHARD_IDS,
) -> None:
    """Encode documents and write their ids to ``path`` in ascending order of ``id_col``, ``end_id`` behind each.

    ``tokenizer`` is the path of a file of the tokenizers library, on the driver; ``by_word`` see ``WordIds``.

    NULL texts have no ids but the end; rows without id come first. Rows that share an id are ordered by their text, so
    that repeated rows may be dealt anyhow. A document is never cut: one of more than ``shard_ids`` ids makes a shard that
    is longer. An empty table has no shards. Other columns are not read, so their names do not matter.
    """
    spark, shipped_file = docs.sparkSession, shipped(docs.sparkSession, tokenizer)
    keys = [F.col("id").asc_nulls_first(), F.col("sum")]
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    rows = rows.withColumn("sum", F.xxhash64("text"))
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys, "text")
    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"part int, shard int, n_docs bigint, n_ids bigint, doc_ids array<{id_type}>, body binary"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = loaded(f"word-ids-{by_word}", shipped_file.value, lambda c: WordIds(bpe_tokenizer(c), by_word))
        part, made = TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        names: list[pa.Array] = []

        def shard() -> pa.RecordBatch:
            ends = np.cumsum(np.concatenate(sizes))
            whole, of = np.concatenate(ids), pa.concat_arrays(names)
            columns = [
                pa.array([part], pa.int32()), pa.array([made], pa.int32()),
                pa.array([len(ends)], pa.int64()), pa.array([len(whole)], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(of)], pa.int32()), of),
                pa.array([make_body(whole, ends)], pa.binary()),
            ]
            ids.clear(), sizes.clear(), names.clear()
            return pa.RecordBatch.from_arrays(columns, ["part", "shard", "n_docs", "n_ids", "doc_ids", "body"])

        for batch in pieces(batches, limit=2 * PIECE_BYTES):
            found, lengths = encode(batch.column("text"))
            ends = np.cumsum(lengths)
            # The end id goes behind the ids of each document.
            found, lengths = np.insert(found, ends, end_id), lengths + 1
            ends += np.arange(1, len(ends) + 1)
            done = 0
            while done < len(ends):
                base = int(ends[done - 1]) if done else 0
                room = shard_ids - sum(map(len, ids))
                stop = min(len(ends), int(np.searchsorted(ends, base + room)) + 1)
                ids.append(found[base : int(ends[stop - 1])])
                sizes.append(lengths[done:stop])
                names.append(batch.column("id").slice(done, stop - done))
                done = stop
                if sum(map(len, ids)) >= shard_ids:
                    yield shard()
                    made += 1
        if ids:
            yield shard()

    placed.mapInArrow(pack, schema).write.parquet(f"{path}/shards")
    _index(spark.read.parquet(f"{path}/shards")).write.parquet(f"{path}/index")


def _index(shards: DataFrame) -> DataFrame:
    """Where each shard's ids begin. Parts are added up first: only one row per part meets in one task."""
    few = shards.select("part", "shard", "n_docs", "n_ids")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = few.groupBy("part").agg(F.sum("n_ids").alias("of_part"))
    parts = parts.select("part", F.coalesce(F.sum("of_part").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("n_ids").over(within), F.lit(0))
    return few.join(broadcast_if_small(parts), "part").select("part", "shard", start.alias("start"), "n_docs", "n_ids")


def _bodies(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/shards").select("part", "shard", "doc_ids", "body"), spark.read.parquet(f"{path}/index")


def read_documents(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked for, the ids of all documents.

    The checksum is that of the ids as little-endian unsigned 32-bit integers.
    """
    shards, index = _bodies(spark, path)
    rows = shards.join(broadcast_if_small(index.select("part", "shard", "start")), ["part", "shard"]).select("start", "doc_ids", "body")
    id_type = shards.schema["doc_ids"].dataType.elementType
    schema = f"doc_id {id_type.simpleString()}, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<bigint>" if with_ids else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                body = Body(batch.column("body")[i].as_py())
                ids, ends = body.ids().astype("<u4"), body.ends
                starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
                data = memoryview(ids.tobytes())
                sums = [zlib.crc32(data[4 * a : 4 * z]) for a, z in zip(starts.tolist(), ends.tolist())]
                columns = [
                    batch.column("doc_ids").slice(i, 1).flatten(), pa.array(starts + batch.column("start")[i].as_py()),
                    pa.array(ends - starts), pa.array(sums, pa.int64()),
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(ids.astype(np.int64))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(read, schema)


def read_range(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """at, id: the ids [start, stop) of the whole corpus. Only the shards they lie in are read, and of these only a range."""
    shards, index = _bodies(spark, path)
    wanted = index.where((F.col("start") < stop) & (F.col("start") + F.col("n_ids") > start)).select("part", "shard", "start")
    rows = shards.join(broadcast_if_small(wanted), ["part", "shard"]).select("start", "body")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data in zip(batch.column("start").to_pylist(), batch.column("body")):
                a = max(0, start - first)
                ids = Body(data.as_py()).ids(a, stop - first).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(first + a + np.arange(len(ids))), pa.array(ids)], ["at", "id"])

    return rows.mapInArrow(read, "at bigint, id bigint")
