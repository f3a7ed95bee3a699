"""Every query against its SQL, on the smallest tables."""

import collections
import math

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def _value(v):
    return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_sql(spark, sql, name):
    df = entry.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = collections.Counter(
        tuple(_value(r[c]) for c in columns) for r in df.select(*[f"`{c}`" for c in columns]).collect()
    )
    oracle = entry.oracle_sql().get(name)
    if oracle is None:
        assert sum(got.values()) > 0
        return
    rel = sql.sql(oracle)
    assert sorted(rel.columns) == columns
    order = [rel.columns.index(c) for c in columns]
    expected = collections.Counter(tuple(_value(r[i]) for i in order) for r in rel.fetchall())
    assert got == expected


def test_entry(spark):
    assert entry.entry(spark).columns == ["kept", "drop_reason", "n_rows"]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
