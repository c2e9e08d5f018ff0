"""Registered queries against their SQL on the smallest tables, where these are there."""

import math
import os

import duckdb
import pytest

import __spark_entry__
from tributary.plans import oracles, queries

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_every_sql_has_a_query():
    assert set(oracles.SQL) <= set(queries.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(FOLDER):
        pytest.skip("no test data")
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def rows(names, values):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(repr(tuple(plain(v[k]) for k in order)) for v in values)


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = __spark_entry__.queries()[name](spark, FOLDER)
    want = duck.execute(oracles.SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, want.fetchall())


def test_entry(spark):
    if not os.path.isdir(FOLDER):
        pytest.skip("no test data")
    assert __spark_entry__.entry(spark).columns == ["source1_entity_id", "matched_entity_ids"]
