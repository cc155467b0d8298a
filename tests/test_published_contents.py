"""Every row of every published table against the SQL of its report."""

from functools import partial
from pathlib import Path

import duckdb
import pytest

from checks import star
from checks.oracles import ORACLES, PUBLISHED
from test_oracles import SF_DIR, _rows
from tillroll.job import publish_all
from tillroll.sinks.publish import write_files


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("published"))
    names = publish_all(*star.load(spark, SF_DIR), partial(write_files, folder=folder))
    return folder, names


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_report_is_published(published):
    assert sorted(published[1]) == sorted(PUBLISHED)


@pytest.mark.parametrize("name", sorted(PUBLISHED))
def test_published_rows_equal_sql(spark, database, published, name):
    actual = spark.read.parquet(f"{published[0]}/{name}")
    expected = database.execute(ORACLES[PUBLISHED[name]])
    names = [column[0] for column in expected.description]
    assert sorted(actual.columns) == sorted(names)
    assert _rows(actual.columns, actual.collect()) == _rows(names, expected.fetchall())
