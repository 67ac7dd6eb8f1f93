import pytest

import __spark_entry__ as contract
from checks.compare import compare, connect
from checks.oracles import ORACLES
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def tables(sf):
    return connect(sf)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf, tables, name):
    assert compare(QUERIES[name](spark, sf), tables, ORACLES[name]) is None


def test_entry_is_in_load_order(spark):
    rows = contract.entry(spark).collect()
    keys = [(r["shard"], r["user_id"], r["recording_id"]) for r in rows]
    assert keys and keys == sorted(keys)
    assert len(set(keys)) == len(keys)
    assert all(r["shard"] != 5 for r in rows)
