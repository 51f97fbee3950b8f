"""Every registered query against its SQL twin on the smallest test tables."""

import os

import duckdb
import pytest
from conftest import rows_of

from __spark_entry__ import entry, oracle_sql, queries
from queries.registry import TABLES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_twin_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, database, name):
    frame = queries()[name](spark, FOLDER)
    if name not in oracle_sql():
        assert frame.count() > 0
        return
    relation = database.sql(oracle_sql()[name])
    columns, wanted = list(relation.columns), relation.fetchall()
    assert sorted(columns) == sorted(frame.columns)
    order = [columns.index(c) for c in frame.columns]
    assert rows_of(frame) == sorted((tuple(row[i] for i in order) for row in wanted), key=repr)
