"""Small tables that the reports can be asked of instead of the wide table.

Sums add up, so a report over a rollup equals the report over the wide table. The fact is summed
by join key before it meets a dimension: only one row per key and customer type is shuffled and
joined, whatever the sizes of the dimension and of the hottest key. A repeated dimension key stops
the query, because it would multiply sales.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def _unique(dimension: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The columns by key; a key that comes twice is an error when the query runs."""
    dimension = dimension.filter(F.col(key).isNotNull())
    held = dimension.groupBy(key).agg(
        F.count(F.lit(1)).alias("_rows"), *(F.max(name).alias(name) for name in columns)
    )
    repeated = F.concat(F.lit(f"{key} is repeated in its dimension: "), F.col(key).cast("string"))
    # In every column, so that a report that uses only one of them does not prune the check.
    return held.select(
        key,
        *(
            F.when(F.col("_rows") > 1, F.raise_error(repeated)).otherwise(F.col(name)).alias(name)
            for name in columns
        ),
    )


def _summed(fact: DataFrame, keys: Sequence[str], counted: Sequence[str]) -> DataFrame:
    """Sales, the number of rows, and of rows for which each of the counted flags holds, by the keys."""
    flags = [F.count_if(name).alias(name) for name in counted]
    return fact.groupBy(*keys).agg(F.sum("sales").alias("sales"), F.count(F.lit(1)).alias("rows"), *flags)


def store_sales(
    fact: DataFrame, location: DataFrame, counted: Sequence[str] = (), is_unique: bool = False
) -> DataFrame:
    """Sales and rows of a cleaned fact per store key and customer type, with province and store number.

    ``counted`` names flags of the fact whose rows are counted, too. ``is_unique`` says that the caller
    has made sure that no key repeats (``require_unique``).
    """
    key, columns = "store_location_key", ["province", "store_num"]
    by_key = _summed(fact, [key, "customer_type"], counted)
    stores = location.select(key, *columns) if is_unique else _unique(location, key, columns)
    return by_key.join(stores, key, "left").select("customer_type", *columns, "sales", "rows", *counted)


def category_sales(fact: DataFrame, product: DataFrame, is_unique: bool = False) -> DataFrame:
    """Sales and rows of a cleaned fact per product key, with department and category."""
    key, columns = "product_key", ["department", "category"]
    by_key = _summed(fact, [key], ())
    products = product.select(key, *columns) if is_unique else _unique(product, key, columns)
    return by_key.join(products, key, "left").select(*columns, "sales", "rows")
