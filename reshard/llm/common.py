"""Helpers shared by the operators: text columns, splitting of batches, distributed ranks, exact draws."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reshard.session import BROADCAST_ROWS, broadcast_if_small, checkpointed, new_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words separated by ASCII white space.
SPACED_WORD = r"[^\x20\x09-\x0D]+"
# Rows of one group that may meet in one task of a join.
HOT_ROWS = 500
# Bytes of text a Python task works on at once; a longer text is a piece of its own.
PIECE_BYTES = 4 << 20


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; NULL counts as the empty text. Where a text is all ASCII, the faster function does the same."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACED_WORD)), F.lit(0)).cast("long")


def row_hash(rows: DataFrame) -> Column:
    """Hash of all columns Spark can hash: separates rows that share their id."""
    return F.xxhash64(*[F.col(f"`{n}`") for n, kind in rows.dtypes if "map<" not in kind and "variant" not in kind])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(rows: DataFrame) -> DataFrame:
    """Rows written once to the shared folder, with their lineage cut."""
    return checkpointed(rows)


def with_running(
    rows: DataFrame, group: str, key: str, totals: dict[str, str], count: int, groups: int, bucket_rows: int = 200_000
) -> DataFrame:
    """Add the sum of all earlier rows of a group, in the order of a uniform 64-bit ``key`` (then ``_tie``), for each of
    ``totals``. ``count`` is about the number of rows and ``groups`` that of groups; they only choose the plan.

    A group of any size is cut into ranges of the key, as many as there are shuffle partitions at least, so that no task
    holds it whole: ranges are summed first, the sums of earlier ranges are carried in, and only the rows of one range
    are sorted together. NULL is a group.
    """
    ranges = max(-(-count // bucket_rows), partitions(rows.sparkSession))
    bits = min(40, (ranges - 1).bit_length())
    cut = rows.withColumn("_range", F.shiftrightunsigned(F.col(key), 64 - bits) if bits else F.lit(0).cast("long"))
    # The key is signed: its ranges follow the unsigned order, and so must the rows within.
    unsigned = F.col(key).bitwiseXOR(F.lit(-(2**63)))
    before = Window.partitionBy("_group").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    sums = cut.groupBy(F.col(group).alias("_group"), F.col("_range").alias("_of")).agg(
        *[F.sum(v).alias(f"_t_{n}") for n, v in totals.items()]
    )
    sums = sums.select(
        "_group", "_of", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_b_{n}") for n in totals]
    )
    if groups << bits <= BROADCAST_ROWS:
        sums = F.broadcast(sums)
    within = Window.partitionBy(group, "_range").orderBy(unsigned, "_tie").rowsBetween(Window.unboundedPreceding, -1)
    out = cut.withColumns({f"_n_{n}": F.coalesce(F.sum(v).over(within), F.lit(0)) for n, v in totals.items()})
    out = out.join(sums, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_of")))
    out = out.withColumns({n: F.col(f"_n_{n}") + F.col(f"_b_{n}") for n in totals})
    return out.drop("_range", "_group", "_of", *[f"_n_{n}" for n in totals], *[f"_b_{n}" for n in totals])


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """Good ones among ``drawn`` without replacement. Beyond the generator's 10**9, from the normal limit."""
    total = good + bad
    if drawn == 0 or good == 0:
        return 0
    if total < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, drawn))
    mean = drawn * good / total
    spread = (mean * (bad / total) * ((total - drawn) / max(1, total - 1))) ** 0.5
    return int(min(good, drawn, max(0, drawn - bad, round(rng.normal(mean, spread)))))


def multivariate(rng: np.random.Generator, counts: list[int], drawn: int) -> list[int]:
    """How many of each kind are among ``drawn`` taken without replacement."""
    left, out = sum(counts), []
    for n in counts:
        got = hypergeometric(rng, n, left - n, drawn)
        out.append(got)
        left, drawn = left - n, drawn - got
    return out


def written(rows: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Rows written as Parquet to the shared folder and read from there: smaller than a checkpoint, lineage cut alike."""
    folder = new_folder(rows.sparkSession, name)
    rows.write.parquet(folder, compression=codec)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def same(left: str, right: str, keys: list[str]) -> Column:
    """Null-safe equality of the keys of two aliased sides."""
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return out


def attach(rows: DataFrame, marks: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of long rows with what is known about some of them.

    While the marked keys are few enough to be broadcast, only marked rows are shuffled; above that all rows are.
    """
    a, b = rows.alias("a"), marks.alias("b")
    added = [F.col(f"b.{c}") for c in marks.columns if c not in keys]
    marked = marks.select(*keys).distinct()
    few = broadcast_if_small(marked)
    if few is marked:
        return a.join(b, same("a", "b", keys), "left").select("a.*", *added)
    few = few.alias("b")
    plain = a.join(few, same("a", "b", keys), "left_anti")
    for c in marks.columns:
        if c not in keys:
            plain = plain.withColumn(c, F.lit(None).cast(marks.schema[c].dataType))
    touched = a.join(few, same("a", "b", keys), "left_semi").alias("a")
    return plain.unionByName(touched.join(b, same("a", "b", keys)).select("a.*", *added))


def only(rows: DataFrame, keys_of: DataFrame, keys: list[str], keep: bool = True) -> DataFrame:
    """Rows whose keys are (or are not) in another table; the keys are broadcast while they are few."""
    few = broadcast_if_small(keys_of.select(*keys).distinct()).alias("b")
    return rows.alias("a").join(few, same("a", "b", keys), "left_semi" if keep else "left_anti")


def join_counted(rows: DataFrame, groups: DataFrame, key: str, count: str) -> DataFrame:
    """Inner join of rows with their groups, one row per ``key``, where a group may have any share of the rows.

    ``count`` has the rows of each group. Those of a group beyond HOT_ROWS are dealt to several tasks by a hash of the row, and the
    group's one row is repeated for each. Rows that agree in everything are dealt alike; HOT_ROWS keeps such groups together.
    """
    most = 4 * partitions(rows.sparkSession)
    salts = F.least(F.ceil(F.col(count) / HOT_ROWS), F.lit(most)).cast("int")
    groups = stored(groups.withColumn("_salts", salts))
    hot = broadcast_if_small(groups.where("_salts > 1").select(F.col(key).alias("_hot"), F.col("_salts").alias("_own")))
    salt = F.coalesce(F.pmod(row_hash(rows), F.col("_own")).cast("int"), F.lit(0)).alias("_salt")
    dealt = rows.join(hot, F.col(key) == F.col("_hot"), "left").select(*rows.columns, salt)
    repeated = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")
    return dealt.join(repeated, [key, "_salt"]).drop("_salt")


# --- in Python tasks -------------------------------------------------------------------------------------------------


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that one piece holds little text, unless a single text is longer."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """Finish a 64-bit hash so that all its bits depend on all others."""
    v = values ^ np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    v = (v ^ (v >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    v = (v ^ (v >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return v ^ (v >> np.uint64(31))


def word_hashes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each white-space separated word of all texts, and where each text's words begin (and the end)."""
    texts = pc.fill_null(texts, "")
    if lower:
        texts = pc.ascii_lower(texts)
    split = pc.ascii_split_whitespace(texts)
    offsets = split.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    words = split.flatten().dictionary_encode()
    names = words.dictionary.to_pylist()
    hashed = np.fromiter((xxhash.xxh3_64_intdigest(w.encode()) for w in names), np.uint64, len(names))
    codes = words.indices.to_numpy(zero_copy_only=False)
    if "" in names:  # leading and trailing space split off empty words
        full = codes != names.index("")
        offsets = np.concatenate(([0], np.cumsum(full)))[offsets]
        codes = codes[full]
    return hashed[codes], offsets


def rolled(hashes: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``width`` neighbours: a polynomial modulo 2**64 by differences of running sums."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base = 0xD6E8FEB86659FD93 + 8 * seed
    powers = np.full(len(hashes) + 1, base, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    inverse = np.full(n, pow(base, -1, 1 << 64), np.uint64)
    inverse[0] = 1
    inverse = np.multiply.accumulate(inverse)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mixed(hashes, seed) * powers[:-1], out=sums[1:])
    return mixed((sums[width:] - sums[:-width]) * inverse)


def window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest value in each window of ``width``."""
    n = len(values)
    best = np.arange(n)
    span = 1
    while span * 2 <= width:  # best[i] covers [i, i + span)
        right = best[span:]
        left = best[: len(right)]
        best = np.where(values[right] < values[left], right, left)
        span *= 2
    if span < width:
        right = best[width - span :]
        left = best[: len(right)]
        best = np.where(values[right] < values[left], right, left)
    return best


def covered(starts: np.ndarray, width: int, length: int) -> np.ndarray:
    """Which of ``length`` places lie in a window of ``width`` beginning at one of ``starts``."""
    edges = np.zeros(length + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, np.minimum(starts + width, length), -1)
    return np.cumsum(edges[:-1]) > 0
