"""Every registered query against its SQL, run by DuckDB on the same tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from placemill.plans.oracles import ORACLES
from placemill.plans.queries import QUERIES

from .conftest import TESTDATA

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
SF_DIR = os.environ.get("ORACLE_SF_DIR", f"{TESTDATA}/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in [*TABLES.split(), "conversations"]:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def _sorted(rows):
    return sorted(rows, key=lambda r: [(v is not None, v) for v in r])


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    got = contract.queries()[name](spark, SF_DIR)
    columns = sorted(got.columns)
    wanted = duck.execute(f"SELECT {', '.join(columns)} FROM ({contract.oracle_sql()[name]})").fetchall()
    described = duck.execute(f"DESCRIBE {contract.oracle_sql()[name]}").fetchall()
    assert sorted(row[0] for row in described) == columns
    assert wanted
    assert _sorted(tuple(r) for r in got.select(*columns).collect()) == _sorted(wanted)


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["estado", "tipo_cervejaria", "count"]
    assert sum(row["count"] for row in result.collect()) == 150
