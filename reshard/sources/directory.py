"""The shard directory: entries of the form ``alias:database@host[@port]``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_PORT = 3306


def parse_entries(entries: DataFrame, entry: str = "entry") -> DataFrame:
    """Split entries into alias, database, host and port; ``error`` tells what is wrong with a used one.

    Comments (``#``) and entries without exactly one ``:`` are left out.
    """
    text = F.col(entry)
    halves = F.split(text, ":")
    places = F.split(F.get(halves, F.lit(1)), "@")
    port = F.get(places, F.lit(2))
    number = F.when(port.rlike(r"\A[+-]?[0-9]+\z"), port.try_cast("bigint"))
    error = F.when(F.size(places) < 2, "no host").when(port.isNotNull() & number.isNull(), "bad port")
    return entries.where(~text.startswith("#") & (F.size(halves) == 2)).select(
        "*",
        F.get(halves, F.lit(0)).alias("alias"),
        F.when(error.isNull(), F.get(places, F.lit(0))).alias("db"),
        F.when(error.isNull(), F.get(places, F.lit(1))).alias("host"),
        F.when(error.isNull(), F.coalesce(number, F.lit(DEFAULT_PORT).cast("bigint"))).alias("port"),
        error.alias("error"),
    )


def shard_map(entries: DataFrame, order: str, entry: str = "entry") -> DataFrame:
    """One row per alias: its first entry in ``order``."""
    first = (
        parse_entries(entries, entry)
        .groupBy("alias")
        .agg(F.min_by(F.struct("db", "host", "port", "error"), order).alias("_first"))
    )
    return first.select("alias", "_first.*")


def lookup(directory: DataFrame, aliases: DataFrame) -> DataFrame:
    """Places of the wanted aliases; an alias that is not listed or has a bad entry raises when read."""
    found = aliases.join(directory, "alias", "left")
    bad = F.col("db").isNull()
    message = F.concat(F.lit("no usable directory entry for "), F.col("alias"))
    return found.select(
        "alias",
        F.when(bad, F.raise_error(message).cast("string")).otherwise(F.col("db")).alias("db"),
        "host",
        "port",
    )
