"""Every registered query against its DuckDB counterpart on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from parcelmart.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    ours = sorted((tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=str)
    result = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    theirs = sorted((tuple(row[i] for i in order) for row in result.fetchall()), key=str)
    assert ours and ours == theirs


def test_entry(spark):
    assert entry.entry(spark).count() > 0
