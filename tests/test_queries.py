"""Every registered query against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from pruefspur.plans.oracles import ORACLES
from pruefspur.plans.queries import QUERIES
from tools.check_queries import TABLES, normal

FOLDER = os.environ.get("TEST_TABLES", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, FOLDER)
    got = normal(df.columns, df.collect())
    duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in duck.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == normal(columns, duck.fetchall())
    assert got


def test_flagship(spark):
    found = contract.entry(spark).collect()
    assert sum(r["rows"] for r in found) == 6000
