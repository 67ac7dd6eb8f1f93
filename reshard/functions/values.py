"""Conversions of logged column values."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from reshard.spec import ColumnSpec

# Windows-1252 places 27 characters where ISO-8859-1 has control codes; five codes stay unassigned.
_MOVED = {
    chr(code): bytes([code]).decode("cp1252")
    for code in range(0x80, 0xA0)
    if code not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)
}


def latin1_text(data: Column) -> Column:
    """Bytes of a latin1 column, which the database means as Windows-1252."""
    return F.translate(F.decode(data, "ISO-8859-1"), "".join(_MOVED), "".join(_MOVED.values()))


def unsigned_value(value: Column, bits: int) -> Column:
    """A logged signed integer read as unsigned of the same width (24 bits: mediumint)."""
    if bits == 64:
        wide = value.cast("decimal(20,0)")
        return F.when(wide < 0, wide + F.lit(Decimal(2**64))).otherwise(wide).cast("decimal(20,0)")
    target = "bigint" if bits == 32 else "int"
    wide = value.cast(target)
    return F.when(wide < 0, wide + F.lit(2**bits).cast(target)).otherwise(wide)


def unsigned_text(value: Column) -> Column:
    """Unsigned 64-bit value as decimal text."""
    return unsigned_value(value, 64).cast("string")


def image_text(image: Column) -> Column:
    """A row image as comma-joined text; a missing value prints as <nil>."""
    return F.array_join(image.cast("array<string>"), ",", "<nil>")


def image_value(image: Column, column: ColumnSpec, binary: bool | None = None) -> Column:
    """Typed value of one column of a row image; NULL when the image is too short.

    An image of bytes has latin1 columns as the database stores them. An image of text holds decoded text already;
    bytes that travel in text messages should be sent base64-coded and unpacked with ``unbase64`` before.
    """
    raw = F.get(image, F.lit(column.ordinal))
    if column.charset == "latin1":
        return raw.cast("string") if binary is False else latin1_text(raw.cast("binary"))
    if binary and column.type != "binary":
        raw = raw.cast("string")
    if column.unsigned:
        return unsigned_value(raw.cast("bigint"), column.bits)
    return raw.cast(column.type)
