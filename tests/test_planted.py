"""The test tables hold the faults that the operators are there for, and every row of their sources."""

import duckdb

from checks.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def test_every_kind_of_fault_is_there(spark):
    found = QUERIES["quality"](spark, SF_DIR).first().asDict()
    assert all(count > 0 for count in found.values()), found
    assert max(found.values()) == found["rows"]


def test_equal_stores_stand_at_the_border_of_the_best(spark):
    best = QUERIES["top_stores"](spark, SF_DIR).filter("customer_type = 'Overall'").collect()
    assert len(best) > 3
    assert len({row["total"] for row in best}) < len(best)


def test_no_dimension_row_is_left_out(spark):
    stores = duckdb.sql(f"SELECT count(*) FROM '{SF_DIR}/supplier.parquet'").fetchall()[0][0]
    assert QUERIES["union_all"](spark, SF_DIR).count() == 2 * stores
