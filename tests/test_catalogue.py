"""Every query against its SQL, as the driver compares them."""

import math
from decimal import Decimal

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from orderlake.catalogue.queries import QUERIES
from tests.conftest import SF_DIR

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([repr(row[i]) for i in order] for row in rows))


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    got = [tuple(r) for r in df.collect()]
    relation = duck.sql(oracle_sql()[name])
    want = relation.fetchall()
    assert sorted(df.columns) == sorted(relation.columns)
    assert len(got) == len(want)
    assert canonical(got, df.columns) == canonical(want, relation.columns)
    assert len(want) > 0


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql())


def test_entry_is_sorted(spark):
    rows = entry(spark).collect()
    keys = [(r["order_date"], r["comune"] is not None, r["comune"] or "") for r in rows]
    assert rows and keys == sorted(keys)
