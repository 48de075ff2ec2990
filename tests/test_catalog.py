"""Every registered query against its SQL in DuckDB."""

import duckdb
import pytest

import __spark_entry__ as contract
from millrace import catalog

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
SQL = contract.oracle_sql()
#: The queries of the text operators have tests of their own.
QUERIES = {name: query for name, query in contract.queries().items() if name in catalog.QUERIES}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    before = spark.conf.getAll
    df = QUERIES[name](spark, SF)
    assert spark.conf.getAll == before
    got = [tuple(r[c] for c in sorted(df.columns)) for r in df.collect()]
    result = duck.execute(SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(range(len(names)), key=names.__getitem__)
    want = [tuple(r[i] for i in order) for r in result.fetchall()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_every_query_has_sql():
    assert set(QUERIES) == set(catalog.ORACLES) and set(catalog.ORACLES) <= set(SQL)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["event_type", "cnt", "max_k"] and df.count() == 5
