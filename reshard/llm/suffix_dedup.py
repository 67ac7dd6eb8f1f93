"""Suffix-array dedup of bytes: intervals of a Burrows-Wheeler transform, expanded up to the least length.

All strings of the least length that contain the same anchor meet in one group, so the groups can be searched apart. In
each group the transform of its texts is built, and the intervals of all strings of length 1, 2, 3, ... are extended
backwards, breadth first. The level at which two neighbouring suffixes first part is their common prefix; who has not
parted when the least length is reached begins a repeat. No level beyond it is looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reshard.llm.common import attach, join_counted, mixed, only, pieces, stored, written

REPEAT_BYTES = 400
ANCHOR_BYTES = 128
# Bytes of text that one transform covers; a larger group is compared window by window, spread over tasks.
GROUP_BYTES = 1 << 20
# Bytes of text searched for anchors at once.
SLICE_BYTES = 1 << 20

_BASE = 0xD6E8FEB86659FD93


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & 0xFFFFFFFFFFFFFFFF, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def rolled_bytes(data: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """64-bit hash of every run of ``width`` bytes."""
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base = _BASE + 8 * seed
    table = mixed(np.arange(256, dtype=np.uint64) + np.uint64(1), seed + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * _powers(base, len(data)), out=sums[1:])
    return mixed((sums[width:] - sums[:-width]) * _powers(pow(base, -1, 1 << 64), n))


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest value in each window of ``width``."""
    out, span = values, 1
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[: len(values) - width + 1], out[width - span :][: len(values) - width + 1]) if width > span else out


def anchored_runs(data: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, number of windows and anchor of each run of neighbouring windows of ``width`` bytes around one anchor.

    A window's anchor is the first of the shorter strings in it with the smallest leading 40 bits of hash. It is found
    from the window's bytes alone, so equal windows have equal anchors at equal places.
    """
    starts, anchors, base = [], [], 0
    total = len(data) - width + 1
    gram = min(ANCHOR_BYTES, width)
    low_bits = np.uint64((1 << 24) - 1)
    while base < total:  # slices overlap by a window; a run cut by a slice is two runs
        part = data[base : base + SLICE_BYTES + width - 1]
        hashes = rolled_bytes(part, gram)
        ranked = (hashes & ~low_bits) | np.arange(len(hashes), dtype=np.uint64)
        place = (sliding_minimum(ranked, width - gram + 1) & low_bits).astype(np.int64)
        at = np.concatenate(([0], np.flatnonzero(place[1:] != place[:-1]) + 1))
        starts.append(at + base)
        anchors.append(hashes[place[at]])
        base += SLICE_BYTES
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.concatenate(starts)
    return at, np.diff(np.concatenate((at, [total]))), np.concatenate(anchors).view(np.int64)


# --- the transform ---------------------------------------------------------------------------------------------------


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes in the order of their first ``depth`` symbols at least (symbols below 2**9)."""
    n, known = len(text), 7
    padded = np.concatenate((text, np.zeros(known, text.dtype))).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(known):
        key = (key << np.uint64(9)) | padded[i : i + n]
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    rank = np.empty(n, np.int64)
    heads = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    group = np.maximum.accumulate(np.where(heads, np.arange(n), 0))  # rank: first place of the group
    rank[order] = group
    open_ = np.flatnonzero(~(heads & np.concatenate((heads[1:], [True]))))  # places whose group is not single
    while len(open_) and known < depth:
        who = order[open_]
        after = who + known
        then = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        pair = (rank[who].astype(np.uint64) << np.uint64(32)) | then.astype(np.uint64)
        by = np.argsort(pair, kind="stable")
        who, pair = who[by], pair[by]
        order[open_] = who
        heads = np.concatenate(([True], pair[1:] != pair[:-1]))
        group = open_[np.maximum.accumulate(np.where(heads, np.arange(len(who)), 0))]
        rank[who] = group
        open_ = open_[~(heads & np.concatenate((heads[1:], [True])))]
        known *= 2
    return order


def parted(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For each place in the order (and the end): whether its suffix and the one before part within ``depth`` symbols.

    Symbol 0 separates texts. An interval [left, right] of the order holds the suffixes that begin with some string; the
    symbols before them in the transform lead to the intervals of all strings one longer. The right end of an interval is
    where its suffixes part from the next; only intervals with a new right end are followed, so that every place is
    reached once, at the level of its common prefix.
    """
    n = len(text)
    before = text[order - 1]  # of the suffix at 0: the last symbol, a separator
    by_symbol = np.argsort(before, kind="stable")
    lead = np.empty(n, np.int64)  # where the suffix that is one longer stands
    lead[by_symbol] = np.arange(n)
    same = before[by_symbol][1:] == before[by_symbol][:-1]
    later, earlier = np.full(n, n), np.full(n, -1)  # next and last place with the same symbol before
    later[by_symbol[:-1][same]] = by_symbol[1:][same]
    earlier[by_symbol[1:][same]] = by_symbol[:-1][same]
    out = np.zeros(n + 1, bool)
    counts = np.bincount(text)
    ends = np.cumsum(counts)[counts > 0]
    left, right = np.concatenate(([0], ends[:-1])), ends - 1
    out[0] = out[ends] = True
    for _ in range(depth - 1):
        if not len(left):
            break
        size = right - left + 1
        place = np.arange(size.sum()) + np.repeat(left - np.concatenate(([0], np.cumsum(size)[:-1])), size)
        inner = before[place] != 0  # strings across texts are not followed
        last = lead[place[inner & (later[place] > np.repeat(right, size))]]
        first = lead[place[inner & (earlier[place] < np.repeat(left, size))]]
        last.sort()
        first.sort()
        new = ~out[last + 1]
        left, right = first[new], last[new]
        out[right + 1] = True
    return out


def repeats_within(texts: list[bytes], width: int) -> list[np.ndarray]:
    """For each text the places where a string of ``width`` bytes begins that also begins elsewhere in the texts."""
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes + 1)
    text = np.zeros(int(ends[-1]), np.uint16)
    data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    text[:] = data
    text += 1
    text[ends - 1] = 0
    order = suffix_order(text, width + 1)
    apart = parted(text, order, width)
    shared = ~(apart[:-1] & apart[1:])
    found = np.zeros(len(text), bool)
    found[order[shared]] = True
    out = []
    for size, end in zip(sizes.tolist(), ends.tolist()):
        out.append(np.flatnonzero(found[end - 1 - size : end - width] if size >= width else found[:0]))
    return out


# --- Spark -----------------------------------------------------------------------------------------------------------

KEYS = ["id", "sum"]


def _each_text(piece: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    for i, text in enumerate(piece.column("text")):
        yield i, np.frombuffer(text.as_buffer(), np.uint8) if text.is_valid else np.zeros(0, np.uint8)


def _batch(piece: pa.RecordBatch, owner: list, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    owner = pa.array(np.concatenate(owner))
    kept = {k: piece.column(k).take(owner) for k in KEYS}
    return pa.RecordBatch.from_arrays([*kept.values(), *columns.values()], [*kept, *columns])


def anchor_counts(rows: DataFrame, width: int) -> DataFrame:
    """anchor, id, sum, n: runs with this anchor in the document."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            owner, anchors, counts = [], [], []
            for i, data in _each_text(piece):
                _, _, anchor = anchored_runs(data, width)
                if len(anchor):
                    keys, n = np.unique(anchor, return_counts=True)
                    anchors.append(keys)
                    counts.append(n.astype(np.int32))
                    owner.append(np.full(len(keys), i))
            if owner:
                yield _batch(piece, owner, {"anchor": pa.array(np.concatenate(anchors)), "n": pa.array(np.concatenate(counts))})

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select(*KEYS, "text").mapInArrow(count, f"id {kind}, sum bigint, anchor bigint, n int")


def live_runs(rows: DataFrame, live: DataFrame, width: int) -> DataFrame:
    """id, sum, anchor, at, n, h1, h2 (hash of the run's bytes) of all runs whose anchor is found twice at least."""

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            owner, found = [], []
            for i, data in _each_text(piece):
                at, n, anchor = anchored_runs(data, width)
                hit = np.isin(anchor, piece.column("anchors")[i].values.to_numpy())
                for a, k, key in zip(at[hit].tolist(), n[hit].tolist(), anchor[hit].tolist()):
                    digest = hashlib.blake2b(data[a : a + k + width - 1], digest_size=16).digest()
                    found.append((key, a, k, int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)))
                owner.append(np.full(int(hit.sum()), i))
            if found:
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
                columns = {k: pa.array(v, t) for k, v, t in zip(("anchor", "at", "n", "h1", "h2"), zip(*found), kinds)}
                yield _batch(piece, owner, columns)

    kind = rows.schema["id"].dataType.simpleString()
    joined = attach(rows, live, KEYS).where("anchors IS NOT NULL")
    return joined.mapInArrow(select, f"id {kind}, sum bigint, anchor bigint, at int, n int, h1 bigint, h2 bigint")


def run_texts(rows: DataFrame, chosen: DataFrame, width: int) -> DataFrame:
    """anchor, h1, h2, part: the bytes of the chosen runs, read from one document that has them."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            found = []
            for i, data in _each_text(piece):
                for run in piece.column("runs")[i].as_py():
                    found.append((run["anchor"], run["h1"], run["h2"], data[run["at"] : run["at"] + run["n"] + width - 1].tobytes()))
            if found:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*found), kinds)], ["anchor", "h1", "h2", "part"])

    per_doc = chosen.groupBy(*KEYS).agg(F.collect_list(F.struct("anchor", "h1", "h2", "at", "n")).alias("runs"))
    joined = attach(rows, stored(per_doc), KEYS).where("runs IS NOT NULL")
    return joined.mapInArrow(take, "anchor bigint, h1 bigint, h2 bigint, part binary")


def expanded(parts: DataFrame, width: int) -> DataFrame:
    """anchor, h1, h2, at, n: repeats within groups of runs that share an anchor, by interval expansion."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        volume, last = 0, None

        def flush() -> pa.RecordBatch:
            out = []
            for (anchor, h1, h2, _), places in zip(held, repeats_within([h[3] for h in held], width)):
                cut = np.flatnonzero(np.diff(places) > 1) + 1
                out += [(anchor, h1, h2, int(g[0]), len(g)) for g in np.split(places, cut) if len(g)]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
            columns = list(zip(*out)) if out else [[]] * 5
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, kinds)], ["anchor", "h1", "h2", "at", "n"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != last and volume >= GROUP_BYTES // 2:  # groups stay whole
                    yield flush()
                    held, volume = [], 0
                held.append(row)
                volume, last = volume + len(row[3]), row[0]
        if held:
            yield flush()

    placed = parts.repartition("anchor").sortWithinPartitions("anchor")
    return placed.mapInArrow(search, "anchor bigint, h1 bigint, h2 bigint, at int, n int")


def compared(parts: DataFrame, width: int) -> DataFrame:
    """The same for groups too large for one transform: window by window, by 128 bits of hash, over all tasks."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, h1, h2, part in zip(*(c.to_pylist() for c in batch.columns)):
                data = np.frombuffer(part, np.uint8)
                a, b = (rolled_bytes(data, width, s).view(np.int64) for s in (0, 1))
                same = [pa.array(np.full(len(a), v)) for v in (anchor, h1, h2)]
                columns = [*same, pa.array(a), pa.array(b), pa.array(np.arange(len(a), dtype=np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "h1", "h2", "w1", "w2", "at"])

    found = written(parts.mapInArrow(windows, "anchor bigint, h1 bigint, h2 bigint, w1 bigint, w2 bigint, at int"), "windows")
    twice = stored(found.groupBy("w1", "w2").agg(F.count("*").alias("c")).where("c > 1").drop("c"))
    return found.join(twice, ["w1", "w2"]).select("anchor", "h1", "h2", "at", F.lit(1).alias("n"))


def repeated_runs(docs: DataFrame, width: int = REPEAT_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, sum, runs (at, n: neighbouring windows of ``width`` bytes that also begin elsewhere), whole (the text as a
    whole stands in another row too).

    1. Whole copies are known by their digest; one of them takes part in the search for the others.
    2. Each window's anchor is the smallest hash of the strings of ANCHOR_BYTES in it. Windows whose anchor is found
       once cannot be repeats; counts are added up over all documents.
    3. Runs of windows with the same anchor and the same bytes are repeats as they are.
    4. Different runs with the same anchor are searched by interval expansion. Groups beyond GROUP_BYTES are compared
       window by window instead, since a passage in a third of all documents makes one large group.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("sum"), text.alias("text"))
    digests = rows.select(*KEYS, F.md5("text").alias("digest"))
    several = digests.groupBy("digest").agg(F.count("*").alias("c"), F.min(F.struct(*KEYS)).alias("first")).where("c > 1")
    copies = stored(
        join_counted(digests, several, "digest", "c").groupBy(*KEYS).agg(F.bool_or(F.struct(*KEYS) == F.col("first")).alias("is_first"))
    )
    singles = only(rows, copies.where("NOT is_first"), KEYS, keep=False)

    counts = anchor_counts(singles, width)
    # Stored, so that joins meet plain exchanges, whose crowded partitions can be split.
    shared = stored(counts.groupBy("anchor").agg(F.sum("n").alias("c")).where("c > 1").drop("c"))
    live = counts.drop("n").join(shared, "anchor").groupBy(*KEYS).agg(F.collect_set("anchor").alias("anchors"))
    live = stored(live)

    runs = written(live_runs(singles, live, width), "runs")
    one = F.min(F.struct(*KEYS, "at", "n"))
    kinds = runs.groupBy("anchor", "h1", "h2").agg(F.count("*").alias("c"), one.alias("one"))
    kinds = stored(kinds.select("anchor", "h1", "h2", "c", "one", F.col("one.n").alias("n")))
    groups = kinds.groupBy("anchor").agg(F.sum(F.col("n") + width - 1).alias("bytes"), F.count("*").alias("different"))
    groups = stored(groups.where("different > 1").select("anchor", (F.col("bytes") > GROUP_BYTES).alias("large")))
    chosen = kinds.join(groups, "anchor").select("one.id", "one.sum", "one.at", "anchor", "h1", "h2", "n", "large")
    parts = written(
        run_texts(singles, chosen, width).join(groups.where("large"), "anchor", "left").withColumn("large", F.coalesce("large", F.lit(False))),
        "parts",
    )
    inner = expanded(parts.where("NOT large").drop("large"), width).unionByName(compared(parts.where("large").drop("large"), width))

    same = ["anchor", "h1", "h2"]
    equal = runs.join(kinds.where("c > 1").select(*same), same).select(*KEYS, "at", "n")
    partly = runs.drop("n").join(inner.withColumnRenamed("at", "off"), same).select(*KEYS, (F.col("at") + F.col("off")).alias("at"), "n")
    found = equal.unionByName(partly).groupBy(*KEYS).agg(F.collect_set(F.struct("at", "n")).alias("runs"))
    empty = F.lit(None).cast("array<struct<at:int,n:int>>")
    out = found.withColumn("whole", F.lit(False)).unionByName(copies.select(*KEYS, empty.alias("runs"), F.lit(True).alias("whole")))
    return out.groupBy(*KEYS).agg(F.max("whole").alias("whole"), F.max("runs").alias("runs"))


def remove_repeated_bytes(
    docs: DataFrame, width: int = REPEAT_BYTES, id_col: str = "doc_id", text_col: str = "text", with_bytes: bool = True
) -> DataFrame:
    """Per document: id, n_bytes, n_removed, n_spans, spans (first byte and end of each maximal removed run), kept (the
    remaining bytes; left out unless ``with_bytes``) and kept_sha256.

    A byte goes if a string of ``width`` bytes covers it that also begins anywhere else, in the same document or in any
    other; strings overlap, do not cross documents and are judged on the input. So all copies of a passage go. NULL and
    empty texts have no bytes. Repeated rows are copies of each other. Other columns are ignored.
    """
    marks = stored(repeated_runs(docs, width, id_col, text_col))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = attach(docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("sum"), text.alias("text")), marks, KEYS)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            out: list[list] = [[] for _ in range(6)]
            whole = piece.column("whole").to_pylist()
            for i, data in _each_text(piece):
                edges = np.zeros((0, 2), np.int64)
                kept = data
                if whole[i] and len(data) >= width:
                    edges, kept = np.array([[0, len(data)]]), data[:0]
                elif whole[i] is not None and (runs := piece.column("runs")[i].values) is not None:
                    at, n = (runs.field(k).to_numpy().astype(np.int64) for k in ("at", "n"))
                    change = np.zeros(len(data) + 1, np.int64)
                    np.add.at(change, at, 1)
                    np.add.at(change, at + n + width - 1, -1)
                    gone = np.cumsum(change[:-1]) > 0
                    edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0])))).reshape(-1, 2)
                    kept = data[~gone]
                kept = kept.tobytes()
                removed = len(data) - len(kept)
                for column, value in zip(out, (len(data), removed, len(edges), edges.tolist(), kept if with_bytes else None, hashlib.sha256(kept).hexdigest())):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int32())), pa.binary(), pa.string())
            columns = [pa.array(c, k) for c, k in zip(out, kinds)]
            yield pa.RecordBatch.from_arrays([piece.column("id"), *columns], ["id", "n_bytes", "n_removed", "n_spans", "spans", "kept", "kept_sha256"])

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, spans array<array<int>>, kept binary, kept_sha256 string"
    out = rows.select("id", "text", "runs", "whole").mapInArrow(cut, schema).withColumnRenamed("id", id_col)
    return out if with_bytes else out.drop("kept")
