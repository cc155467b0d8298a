"""Every registered query against its SQL on the same tables."""

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from checks.catalog import QUERIES
from checks.oracles import ORACLES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


def _key(row):
    return tuple((value is not None, str(type(value)), value) for value in row)


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=_key)


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, database, name):
    actual = contract.queries()[name](spark, SF_DIR)
    expected = database.execute(contract.oracle_sql()[name])
    names = [column[0] for column in expected.description]
    assert sorted(actual.columns) == sorted(names)
    expected_rows = _rows(names, expected.fetchall())
    assert expected_rows
    assert _rows(actual.columns, actual.collect()) == expected_rows
