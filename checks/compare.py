"""Run queries in Spark and their SQL in DuckDB and compare all rows."""

from __future__ import annotations

import glob
import os
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _kind(name: str) -> str:
    name = name.lower()
    return {"string": "varchar", "int": "integer"}.get(name, name)


def _plain(value):
    return float(value) if isinstance(value, Decimal) else value


def compare(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both have the same columns, types and rows; else what differs."""
    relation = connection.sql(sql)
    here = {n: _kind(t) for n, t in result.dtypes}
    there = {n: _kind(str(t)) for n, t in zip(relation.columns, relation.types)}
    if here != there:
        return f"schema {sorted(set(here.items()) ^ set(there.items()))}"
    names = sorted(here)
    ours = Counter(tuple(_plain(row[n]) for n in names) for row in result.collect())
    places = [relation.columns.index(n) for n in names]
    theirs = Counter(tuple(_plain(row[p]) for p in places) for row in relation.fetchall())
    if ours != theirs:
        return f"rows {sum(ours.values())} / {sum(theirs.values())}, {list((ours - theirs).items())[:2]} / {list((theirs - ours).items())[:2]}"
    if not ours:
        return "no rows"
    return None
