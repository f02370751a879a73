"""Queries of the text operators against their SQL on the smallest tables."""

import duckdb
import pytest

from loanlake.llm import queries

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SMALL}/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SMALL)
    cursor = duck.execute(queries.SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    order = [columns.index(c) for c in sorted(columns)]
    expected = sorted(tuple(str(row[i]) for i in order) for row in cursor.fetchall())
    assert sorted(tuple(str(row[c]) for c in sorted(columns)) for row in df.collect()) == expected
