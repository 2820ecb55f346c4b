"""Every registered query gives the rows of its SQL, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import SF_SMALL
from ordinate.plans import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_SMALL}/{name}.parquet')")
    return connection


def comparable(rows):
    def cell(v):
        if isinstance(v, float):
            return None if math.isnan(v) else repr(v)
        return None if v is None else str(v)

    return sorted([tuple(map(cell, r)) for r in rows], key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    got = QUERIES[name](spark, SF_SMALL)
    columns = sorted(got.columns)
    found = comparable(got.select(*[f"`{c}`" for c in columns]).collect())
    assert found
    cursor = database.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    assert found == comparable([[row[names.index(c)] for c in columns] for row in cursor.fetchall()])


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())
