"""Reading the table that is to be split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reshard.functions.search import count_up_to
from reshard.session import broadcast_if_small

PAGE_ROWS = 2000
# Pieces per range when their borders are searched, and pieces at most.
PIECES, MOST_PIECES = 16, 1 << 16


def read_snapshot(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    return spark.read.format(fmt).options(**options).load(path)


def jdbc_options(
    url: str, table: str, lowest: int, highest: int, partitions: int, snapshot_id: str = "id", fetch_rows: int = PAGE_ROWS
) -> dict[str, str]:
    """Options for a parallel read over equal id ranges; give ``user`` and ``password`` separately."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": snapshot_id,
        "lowerBound": str(lowest),
        "upperBound": str(highest + 1),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_rows),
    }


def read_jdbc_snapshot(spark: SparkSession, options: dict[str, str], **access: str) -> DataFrame:
    return spark.read.format("jdbc").options(**options, **access).load()


def keyset_page(rows: DataFrame, last_id: int, limit: int = PAGE_ROWS, snapshot_id: str = "id") -> DataFrame:
    """The next page after ``last_id`` in id order, for resumable reading."""
    return rows.where(F.col(snapshot_id) > last_id).orderBy(snapshot_id).limit(limit)


def chunk_plan(rows: DataFrame, width: int, snapshot_id: str = "id", by: tuple[str, ...] = ()) -> DataFrame:
    """Id ranges that cover the table: first and last id and rows of each, counted before the shuffle."""
    chunk = F.floor(F.col(snapshot_id) / F.lit(width)).alias("chunk")
    return rows.groupBy(*by, chunk).agg(
        F.min(snapshot_id).alias("lo"), F.max(snapshot_id).alias("hi"), F.count("*").alias("rows")
    )


def _placed(ids: DataFrame, marks: DataFrame, by: tuple[str, ...], snapshot_id: str, most: int, name: str) -> DataFrame:
    """Ids with the number of marks of their group that are not above them; 0 for NULL."""
    few = marks.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("marks").alias("_marks"))
    same: Column = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    joined = ids.join(broadcast_if_small(few), same, "left")
    place = F.coalesce(count_up_to(F.col(snapshot_id), F.col("_marks"), most), F.lit(0))
    return joined.select(*by, snapshot_id, place.alias(name))


def snapshot_ranges(rows: DataFrame, chunk_rows: int, snapshot_id: str = "id", by: tuple[str, ...] = ()) -> DataFrame:
    """Id ranges of ``chunk_rows`` rows each, however the ids lie: chunk, lo, hi, rows and predicate, per ``by``.

    The predicates do not overlap and cover every row, also rows that are added later outside of the ids seen, and NULL ids,
    which the first one takes. Ranges end exactly after every ``chunk_rows`` rows; only an id that occurs often makes a range longer.

    No sort of the table: an approximate quantile sketch cuts the ids into many pieces, these are counted, and only the pieces
    that hold a border are looked into. Each step reads nothing but the id, and is added up before its shuffle.
    """
    ids = rows.select(*by, snapshot_id)
    known = ids.where(F.col(snapshot_id).isNotNull())
    most = known.groupBy(*by).count().agg(F.max("count")).first()[0] or 0
    chunks = max(1, -(-most // chunk_rows))
    pieces = min(MOST_PIECES, PIECES * chunks)
    grid = F.array(*[F.lit(i / pieces) for i in range(1, pieces)])
    sketch = F.array_sort(F.array_distinct(F.percentile_approx(snapshot_id, grid, F.lit(8 * pieces))))
    marks = known.groupBy(*by).agg(sketch.alias("marks"))

    counted = _placed(known, marks, by, snapshot_id, pieces, "_piece").groupBy(*by, "_piece", snapshot_id).count()
    totals = counted.groupBy(*by, "_piece").agg(F.sum("count").alias("_rows"))
    earlier = Window.partitionBy(*by).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))

    def has_border(start: Column, size: Column) -> Column:
        """Whether a chunk but the first begins among rows [start, start + size) of a group."""
        step = F.lit(chunk_rows)
        return F.floor((start + size - 1) / step) > F.when(start == 0, F.lit(0)).otherwise(F.floor((start - 1) / step))

    wanted = before.where(has_border(F.col("_before"), F.col("_rows")))
    same: Column = F.lit(True)
    for c in (*by, "_piece"):
        same = same & F.col(f"i.{c}").eqNullSafe(F.col(f"w.{c}"))
    inside = counted.alias("i").join(broadcast_if_small(wanted).alias("w"), same).select("i.*", "w._before")
    within = Window.partitionBy(*by, "_piece").orderBy(snapshot_id).rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_before") + F.coalesce(F.sum("count").over(within), F.lit(0))
    # A range is not cut within an id; the first id of all begins the first range.
    borders = inside.withColumn("_start", start).where((F.col("_start") > 0) & has_border(F.col("_start"), F.col("count")))
    borders = borders.groupBy(*by).agg(F.array_sort(F.collect_list(snapshot_id)).alias("marks"))

    placed = _placed(ids, borders, by, snapshot_id, chunks, "chunk")
    found = placed.groupBy(*by, "chunk").agg(
        F.min(snapshot_id).alias("lo"), F.max(snapshot_id).alias("hi"), F.count("*").alias("rows")
    )
    following = F.lead("lo").over(Window.partitionBy(*by).orderBy("chunk"))
    least = F.when(F.col("chunk") > 0, F.concat(F.lit(f"{snapshot_id} >= "), F.col("lo").cast("string")))
    upto = F.concat(F.lit(f"{snapshot_id} < "), F.col("_following").cast("string"))
    text = F.when(F.col("chunk") == 0, F.coalesce(F.concat(upto, F.lit(f" or {snapshot_id} is null")), F.lit("1 = 1")))
    return found.withColumn("_following", following).select(
        *by, "chunk", "lo", "hi", "rows", text.otherwise(F.concat_ws(" and ", least, upto)).alias("predicate")
    )


def range_predicates(plan: DataFrame) -> list[str]:
    """Predicates of a plan of one source in order: one string per range, as ``read_jdbc_ranges`` takes them."""
    return [r["predicate"] for r in plan.select("chunk", "predicate").orderBy("chunk").collect()]


def read_jdbc_ranges(spark: SparkSession, url: str, table: str, predicates: list[str], **access: str) -> DataFrame:
    """The table read by one task per range."""
    return spark.read.jdbc(url, table, predicates=predicates, properties=access)
