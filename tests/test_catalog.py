"""Every registered query against its SQL on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import SMALL
from loanlake.plans import catalog, catalog_sql

TABLES = "region nation customer supplier part orders lineitem".split()
QUERIES, SQL = catalog.QUERIES, catalog_sql.statements()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SMALL}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        assert not math.isnan(value)
        return repr(value)
    return str(value)


def test_names_agree():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    cursor = duck.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    order = [columns.index(c) for c in sorted(columns)]
    expected = sorted(tuple(plain(row[i]) for i in order) for row in cursor.fetchall())
    got = sorted(tuple(plain(row[c]) for c in sorted(columns)) for row in df.collect())
    assert got == expected


def test_dimension_keys_are_unique(duck):
    """The loan view skips dimensions it does not need; that rests on unique keys."""
    for table, key in [
        ("orders", "o_orderkey"), ("customer", "c_custkey"), ("nation", "n_nationkey"),
        ("supplier", "s_suppkey"), ("part", "p_partkey"),
    ]:
        assert duck.execute(f"SELECT count(*) = count(DISTINCT {key}) FROM {table}").fetchone()[0]


def test_entry(spark):
    df = contract.entry(spark)
    assert "hhi" in df.columns and df.count() > 0
