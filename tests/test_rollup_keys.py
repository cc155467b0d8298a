"""A repeated dimension key stops every report over a rollup, whichever columns it uses."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillroll.operators import sum_by
from tillroll.plans import reports, rollups


@pytest.fixture(scope="module")
def fact(spark):
    rows = [("1", "7", "Loyalty", Decimal(10)), ("2", "8", "NonLoyalty", Decimal(5))]
    return spark.createDataFrame(
        rows, "store_location_key string, product_key string, customer_type string, sales decimal(28,6)"
    )


@pytest.fixture(scope="module")
def location(spark):
    rows = [("1", "ON", "501"), ("1", "ON", "502"), ("2", "QC", "601")]
    return spark.createDataFrame(rows, "store_location_key string, province string, store_num string")


def test_top_stores_refuse_a_repeated_location(fact, location):
    with pytest.raises(Exception, match="store_location_key is repeated"):
        reports.top_stores(rollups.store_sales(fact, location)).collect()
    once = location.filter(F.col("store_num") != "502")
    assert reports.top_stores(rollups.store_sales(fact, once)).count() > 0


@pytest.mark.parametrize("column", ["category", "department"])
def test_each_product_column_refuses_a_repeated_product(spark, fact, column):
    rows = [("7", "Milk", "Dairy"), ("7", "Cheese", "Dairy"), ("8", "Bread", "Bakery")]
    product = spark.createDataFrame(rows, "product_key string, category string, department string")
    with pytest.raises(Exception, match="product_key is repeated"):
        sum_by(rollups.category_sales(fact, product), [column], total="sales").collect()
