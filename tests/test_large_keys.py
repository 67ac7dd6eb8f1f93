"""Key queries over user ids whose lifted keys leave 63 bits, against whole numbers in Python."""

import zlib

import pytest

from checks.fixtures import LIFT
from checks.queries import QUERIES

USERS = [0, 1, 1499, 32767, 32768, 40000, 65535, 65536, 89999, 2**40]


@pytest.fixture(scope="module")
def large(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("large"))
    rows = [(n * 100000 + 7 * (n % 3), user, "view") for n, user in enumerate(USERS)]
    spark.createDataFrame(rows, "event_id bigint, user_id bigint, event_type string").write.parquet(f"{folder}/events.parquet")
    return folder, [(event, user * LIFT + event) for event, user, _ in rows]


def signed(value):
    return (value + 2**63) % 2**64 - 2**63


def slot(value):
    return value % 2**64 // 2**48 % 4096


def crc(text):
    return zlib.crc32(text.encode())


def narrow(event, bits):
    """The query's logged value of this width, id - 2^(bits - 1), read as unsigned."""
    return (event - 2 ** (bits - 1)) % 2**bits


def table_index(value):
    return slot(value) % 32 * 10 + value % 2**64 % 10


MODELS = {
    "hash_value_int": lambda e, k: (signed(k), signed(-k)),
    "hash_value_string": lambda e, k: (signed(k) if k < 2**64 else crc(str(k)), crc(f"view-{e}")),
    "hash_value_bytes": lambda e, k: (crc(str(k)), crc(f"view-{e}")),
    "shard_slot": lambda e, k: (slot(k), slot(-k)),
    "shard_index": lambda e, k: (slot(k) % 32, slot(-k) % 32),
    "shard_table_index": lambda e, k: (table_index(k), table_index(-k)),
    "shard_to_database": lambda e, k: (table_index(k), slot(k) % 32, f"shard{slot(k) % 32}"),
    "unsigned_reinterpret": lambda e, k: (*(narrow(e, bits) for bits in (8, 16, 24, 32)), str(-k % 2**64)),
}


@pytest.mark.parametrize("name", sorted(MODELS))
def test_keys_beyond_63_bits(spark, large, name):
    folder, keys = large
    found = {row[0]: tuple(row[1:]) for row in QUERIES[name](spark, folder).collect()}
    assert found == {event: MODELS[name](event, key) for event, key in keys}
