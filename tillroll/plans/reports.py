"""The sales reports.

Each takes a table that holds the columns it names: the wide table, or a rollup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillroll.functions import exact, percent_label, whole
from tillroll.operators.distinct import by_type, fewer_keys, per_value
from tillroll.operators.grouping import pivot_types, sum_by, to_long, with_overall
from tillroll.operators.ranking import top_n
from tillroll.schema import LOYALTY, MEASURE_LABELS, NON_LOYALTY


def _top_by_type(table: DataFrame, key: str, k: int, drop_null_keys: bool) -> DataFrame:
    totals = with_overall(table, [key], total="sales")
    best = top_n(totals, "total", k, ["customer_type"], [key] if drop_null_keys else [])
    return best.select("customer_type", key, exact(F.col("total")).alias("total"))


def top_provinces(table: DataFrame, k: int = 3, drop_null_keys: bool = False) -> DataFrame:
    """Provinces with the highest sales, by customer type and overall."""
    return _top_by_type(table, "province", k, drop_null_keys)


def top_stores(table: DataFrame, k: int = 3, drop_null_keys: bool = False) -> DataFrame:
    """Stores with the highest sales, by customer type and overall."""
    return _top_by_type(table, "store_num", k, drop_null_keys)


def top_to_average_overall(table: DataFrame) -> DataFrame:
    """Best store of each known province against the mean sales of the province's stores.

    Sales without a store number count as one more store of their province.
    """
    stores = sum_by(table, ["province", "store_num"], total="sales").filter(
        F.col("province").isNotNull()
    )
    # The mean of each province is one row, taken from partial sums.
    averages = stores.groupBy("province").agg(
        (F.sum("total").cast("double") / F.count(F.lit(1))).alias("average")
    )
    best = top_n(stores, "total", 1, ["province"])
    return best.join(averages, "province").select(
        "province",
        "store_num",
        exact(F.col("total")).alias("total"),
        "average",
        percent_label(F.col("total"), F.col("average")).alias("performance_to_average"),
    )


def loyalty_vs_nonloyalty(table: DataFrame) -> DataFrame:
    """One row: sales of both customer types and their ratio in percent."""
    loyalty, other = F.col(LOYALTY), F.col(NON_LOYALTY)
    return pivot_types(table, "sales").select(
        exact(loyalty).alias(LOYALTY),
        exact(other).alias(NON_LOYALTY),
        percent_label(loyalty, other).alias("performance"),
    )


def top10_categories(table: DataFrame, k: int = 10, drop_null_keys: bool = False) -> DataFrame:
    """Categories with the highest sales; sales without a category compete as one group."""
    totals = sum_by(table, ["category"], total="sales")
    best = top_n(totals, "total", k, drop_null_keys=["category"] if drop_null_keys else [])
    return best.select("category", exact(F.col("total")).alias("total"))


def top5_stores_by_province(table: DataFrame, k: int = 5, drop_null_keys: bool = False) -> DataFrame:
    """Stores with the highest sales in each province, in whole units of money."""
    totals = sum_by(table, ["province", "store_num"], total="sales")
    keys = ["province", "store_num"] if drop_null_keys else []
    best = top_n(totals, "total", k, ["province"], keys)
    return best.select("province", "store_num", whole(F.col("total")).alias("total"))


def top10_cat_by_dept(table: DataFrame, k: int = 10, drop_null_keys: bool = False) -> DataFrame:
    """Categories with the highest sales in each department, in whole units of money."""
    totals = sum_by(table, ["department", "category"], total="sales")
    keys = ["department", "category"] if drop_null_keys else []
    best = top_n(totals, "total", k, ["department"], keys)
    return best.select("department", "category", whole(F.col("total")).alias("total"))


def top_stores_provinces(table: DataFrame) -> DataFrame:
    """Best store of each province for each customer type, ties included."""
    totals = sum_by(table, ["customer_type", "province", "store_num"], total="sales")
    best = top_n(totals, "total", 1, ["customer_type", "province"])
    return best.select("customer_type", "province", "store_num", exact(F.col("total")).alias("total"))


DISTINCT = {"transactions": "trans_key", "collectors": "collector_key"}
ADDITIVE = ("sales", "units")


def totals_wide(fact: DataFrame) -> DataFrame:
    """Sales, units, distinct transactions and distinct collectors, by customer type and overall."""
    return _totals_wide(per_value(fact, [], list(DISTINCT.values()), ADDITIVE))


def _totals_wide(seen: DataFrame) -> DataFrame:
    return by_type(seen, [], DISTINCT, ADDITIVE).select(
        "customer_type",
        exact(F.col("sales")).alias("sales"),
        exact(F.col("units")).alias("units"),
        "transactions",
        "collectors",
    )


def totals(fact: DataFrame) -> DataFrame:
    """``totals_wide`` with one row per measure."""
    return to_long(totals_wide(fact), ["customer_type"], MEASURE_LABELS)


def totals_of_seen(seen: DataFrame) -> DataFrame:
    """``totals`` from ``per_value`` by month, rows without a month included."""
    wide = _totals_wide(fewer_keys(seen, [], ADDITIVE))
    return to_long(wide, ["customer_type"], MEASURE_LABELS)
