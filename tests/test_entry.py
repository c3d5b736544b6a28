"""Registered queries against their oracle on the smallest data."""

import collections

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def oracle(small):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{small}/{name}.parquet')")
    return con


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["stay_id", "charttime", "value_mean", "label"]


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_oracle(spark, small, oracle, name):
    df = entry.queries()[name](spark, small)
    columns = sorted(df.columns)
    result = oracle.execute(entry.oracle_sql()[name])
    found = [c[0] for c in result.description]
    assert sorted(found) == columns
    expected = collections.Counter(tuple(r[found.index(c)] for c in columns) for r in result.fetchall())
    assert collections.Counter(tuple(r[c] for c in columns) for r in df.collect()) == expected
