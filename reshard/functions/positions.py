"""Log positions: (file, offset), ordered by file name and then offset."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"\A[+-]?[0-9]+\z"
# Fixed value: how names of detached log files look.
_DETACHED = r"//([^/:]+):([\d]+)"


def position(log_file: Column, log_pos: Column) -> Column:
    """Comparable struct; Spark compares the fields from left to right."""
    return F.struct(log_file.alias("log_file"), log_pos.cast("bigint").alias("log_pos"))


def change_position(log_file: Column, log_pos: Column, row_idx: Column, sub: Column | int = 0) -> Column:
    """Total order of changes: rows of one event share (file, offset), so the row number is part of it."""
    sub = F.lit(sub) if isinstance(sub, int) else sub
    return F.struct(
        log_file.alias("log_file"),
        log_pos.cast("bigint").alias("log_pos"),
        row_idx.cast("int").alias("row_idx"),
        sub.cast("int").alias("sub"),
    )


def parse_position(text: Column) -> Column:
    """``file:offset`` -> struct, or NULL when it does not have that form."""
    log_file = F.substring_index(text, ":", 1)
    rest = F.substring(text, F.length(log_file) + F.lit(2), F.length(text))
    offset = F.when(rest.rlike(_NUMBER), rest.try_cast("bigint"))
    return F.when(text.contains(":") & offset.isNotNull(), position(log_file, offset))


def show_position(log_file: Column, log_pos: Column) -> Column:
    return F.concat(log_file, F.lit(":"), log_pos.cast("string"))


def _number_part(log_file: Column) -> Column:
    return F.split_part(log_file, F.lit("."), F.lit(-1))


def _file_number(log_file: Column) -> Column:
    part = _number_part(log_file)
    return F.when(part.rlike(_NUMBER), part.try_cast("bigint"))


def file_number(log_file: Column) -> Column:
    """Number at the end of the file name, 0 when there is none."""
    return F.coalesce(_file_number(log_file), F.lit(0).cast("bigint"))


def file_number_width(log_file: Column) -> Column:
    """Number of characters of that number, 0 when there is none."""
    return F.when(_file_number(log_file).isNotNull(), F.length(_number_part(log_file))).otherwise(0)


def file_distance(log_file: Column, other: Column) -> Column:
    return file_number(other) - file_number(log_file)


def _renumbered(log_file: Column, number: Column, width: Column | None = None) -> Column:
    part = _number_part(log_file)
    stem = F.substring(log_file, F.lit(1), F.length(log_file) - F.length(part))
    digits = number.cast("string")
    width = F.length(part) if width is None else width
    return F.concat(stem, F.lpad(digits, F.greatest(width, F.length(digits)), F.lit("0")))


def padded_file(log_file: Column, width: int = 20) -> Column:
    """The name with its number padded, so that order by name is also order by number."""
    number = _file_number(log_file)
    return F.when(number.isNotNull(), _renumbered(log_file, number, F.lit(width))).otherwise(log_file)


def next_file(log_file: Column) -> Column:
    """Following file name; the width grows when the digits run out. NULL without a number."""
    number = _file_number(log_file)
    return F.when(number.isNotNull(), _renumbered(log_file, number + 1))


def previous_file(log_file: Column, back: int = 1) -> Column:
    """Name ``back`` files earlier. NULL without a number, for number 0 and below it."""
    number = _file_number(log_file)
    return F.when((number != 0) & (number >= back), _renumbered(log_file, number - back))


def is_detached(log_file: Column) -> Column:
    return log_file.rlike(_DETACHED)


def detached_position(log_file: Column) -> Column:
    """Position written inside a detached name ``//file:offset``; NULL for other names."""
    return F.when(
        is_detached(log_file),
        position(F.regexp_extract(log_file, _DETACHED, 1), F.regexp_extract(log_file, _DETACHED, 2).try_cast("bigint")),
    )
