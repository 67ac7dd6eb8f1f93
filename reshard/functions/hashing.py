"""Key -> 64-bit hash -> slot -> shard, as column expressions.

A hash is an unsigned 64-bit number kept in a BIGINT with the same bits.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The slot is 12 bits wide and starts at bit 48.
SLOT_SHIFT = 48
SLOT_MASK = 4095

_TWO_63 = Decimal(2**63)
_TWO_64 = Decimal(2**64)


def wrap_unsigned(value: Column) -> Column:
    """DECIMAL(20,0) in 0 .. 2^64-1 -> BIGINT with the same bits."""
    return F.when(value >= F.lit(_TWO_63), value - F.lit(_TWO_64)).otherwise(value).cast("bigint")


def unsigned_bits(value: Column) -> Column:
    """Low 64 bits of a whole DECIMAL of any size and sign, as BIGINT."""
    return wrap_unsigned(F.pmod(value, F.lit(_TWO_64)).cast("decimal(20,0)"))


def hash_int(key: Column) -> Column:
    return key.cast("bigint")


def hash_bytes(key: Column) -> Column:
    """CRC-32 always, also when the bytes are digits."""
    return F.crc32(key.cast("binary"))


def hash_string(key: Column) -> Column:
    """A base-10 unsigned 64-bit number hashes to itself, any other text to its CRC-32."""
    digits = F.coalesce(F.nullif(F.ltrim(key, F.lit("0")), F.lit("")), F.lit("0"))
    wide = F.when(F.length(digits) <= 20, digits.try_cast("decimal(20,0)"))
    number = F.coalesce(
        digits.try_cast("bigint"),
        F.when(wide < F.lit(_TWO_64), wrap_unsigned(wide)),
    )
    return F.when(key.rlike(r"\A[0-9]+\z"), F.coalesce(number, hash_bytes(key))).otherwise(hash_bytes(key))


def hash_key(key: Column, data_type: T.DataType | str) -> Column:
    """Hash by declared type. Types without a hash are refused, not guessed."""
    kind = data_type if isinstance(data_type, str) else data_type.simpleString()
    kind = kind.lower()
    if kind in ("tinyint", "smallint", "int", "integer", "bigint", "long"):
        return hash_int(key)
    if kind == "string" or kind.startswith(("varchar", "char")):
        return hash_string(key)
    if kind == "binary":
        return hash_bytes(key)
    if kind == "decimal(20,0)":
        return wrap_unsigned(key)
    raise ValueError(f"no key hash for type {kind}")


def shard_slot(hashed: Column) -> Column:
    return F.shiftrightunsigned(hashed, SLOT_SHIFT).bitwiseAND(F.lit(SLOT_MASK)).cast("int")


def unsigned_mod(hashed: Column, divisor: int) -> Column:
    """Remainder of the hash read as unsigned."""
    carry = F.when(hashed < 0, F.lit(2**64 % divisor)).otherwise(F.lit(0))
    return F.pmod(F.pmod(hashed, F.lit(divisor)) + carry, F.lit(divisor))


def shard_index(hashed: Column, shard_num: int, location: int = 1) -> Column:
    """Shard number, or the sub-table number when every shard has ``location`` >= 2 tables."""
    shard = shard_slot(hashed) % F.lit(shard_num)
    if location >= 2:
        shard = shard * F.lit(location) + unsigned_mod(hashed, location)
    return shard.cast("int")


def database_index(table_index: Column, replication: int) -> Column:
    return F.floor(table_index / F.lit(replication)).cast("int")


def database_alias(table_index: Column, replication: int = 1) -> Column:
    return F.concat(F.lit("shard"), database_index(table_index, replication).cast("string"))
