"""Every check query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, normalised
from riskloom.plans.oracles import all_oracles
from riskloom.plans.queries import all_queries

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_sql_belongs_to_a_query():
    assert set(all_oracles()) <= set(all_queries())
    assert set(all_queries()) - set(all_oracles()) == {
        "chunks_recursive", "trained_heads",
    }


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_query_equals_sql(spark, db, name):
    got = all_queries()[name](spark, FOLDER).toPandas()
    want = db.sql(all_oracles()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normalised(got) == normalised(want)


def test_flagship_query_has_rows(spark):
    assert entry.entry(spark).count() > 0
