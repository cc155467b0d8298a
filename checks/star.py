"""The driver's TPC-H-like tables shaped into the text files a retailer would deliver.

The rules plant in the fact what real deliveries have: missing and malformed measures, amounts with
more decimals than are kept and very large ones, missing collectors and the collector 0, two date
spellings and an unreadable one, keys without a dimension row, and stores of equal sales at the
border of the best three. Every row of every table is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


# The columns used, so that no job has to read the files' own schema first.
TABLES = {
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    "l_quantity double, l_extendedprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz",
    "customer": "c_custkey long, c_acctbal double",
    "supplier": "s_suppkey long, s_nationkey int",
    "nation": "n_nationkey int, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "part": "p_partkey long, p_brand string, p_type string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _text(number: Column) -> Column:
    return number.cast("string")


def _money_text(number: Column) -> Column:
    return number.cast("decimal(18,2)").cast("string")


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delivered transaction rows, all columns as text."""
    order = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date")
    # Orders meet customers first: what an order decides is then worked out once, not once per line.
    headers = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            "o_orderkey",
            F.when(order % 103 == 0, F.lit(0)).when(order % 97 != 0, F.col("c_custkey") + 1).alias("customer"),
            (F.col("c_acctbal") < 0).alias("in_debt"),
            F.when(order % 101 == 0, F.date_format(day, "yyyyMMdd"))
            .when(order % 2 == 0, F.date_format(day, "M/d/yyyy"))
            .otherwise(F.date_format(day, "yyyy-MM-dd"))
            .alias("trans_dt"),
            F.when(order % 17 == 0, F.lit("unknown-")).otherwise(F.lit("")).alias("store_mark"),
            F.when(order % 13 == 0, F.lit("unknown-")).otherwise(F.lit("")).alias("product_mark"),
            (order % 221 == 0).alias("is_large"),
            (order == 0).alias("is_first"),
        )
    )
    line = F.col("l_orderkey") + F.col("l_linenumber")
    # Both sides grow with the data, so neither is ever broadcast.
    rows = table(spark, sf_dir, "lineitem").join(
        headers.hint("merge"), F.col("l_orderkey") == order
    )
    rows = rows.withColumns(
        {
            "by_100": line % 100,
            "by_70": line % 70,
            "price": _money_text(F.col("l_extendedprice")),
            "quantity": _money_text(F.col("l_quantity")),
        }
    )
    collector = F.when(
        F.col("in_debt") | (line % 11 == 0), -F.col("customer")
    ).otherwise(F.col("customer"))
    store, price, quantity = F.col("l_suppkey"), F.col("price"), F.col("quantity")
    by_100, by_70 = F.col("by_100"), F.col("by_70")
    sales = (
        # Order 0 is all that the stores 1 to 7 sell, once in each of its lines' stores.
        F.when(F.col("is_first"), F.lit("99000000.00"))
        .when(store.between(1, 7), F.lit("0.00"))
        .when((by_100 == 0) | (by_100 == 50), F.lit(None))
        .when(by_100 == 33, F.lit("n/a"))
        .when(by_100 == 41, F.lit("NaN"))
        .when(by_100 == 58, F.concat(price, F.lit("12345678")))
        .when(by_100 == 77, F.concat(price, F.lit("000000001")))
        .when(F.col("is_large"), F.lit("20000000000.25"))
        .otherwise(price)
    )
    units = (
        F.when(by_70 == 0, F.lit(None))
        .when(by_70 == 29, F.lit("one"))
        .when(by_70 == 43, F.concat(quantity, F.lit("00005")))
        .otherwise(quantity)
    )
    return rows.select(
        F.when(F.col("is_first"), _text(F.col("l_linenumber")))
        .otherwise(F.concat("store_mark", _text(store)))
        .alias("store_location_key"),
        F.concat("product_mark", _text(F.col("l_partkey"))).alias("product_key"),
        _text(collector).alias("collector_key"),
        "trans_dt",
        sales.alias("sales"),
        units.alias("units"),
        _text(F.col("l_orderkey")).alias("trans_key"),
    )


def location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            _text(F.col("s_suppkey")).alias("store_location_key"),
            F.col("r_name").alias("province"),
            _text(F.col("s_suppkey")).alias("store_num"),
        )
    )


def product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        _text(F.col("p_partkey")).alias("product_key"),
        F.col("p_brand").alias("category"),
        F.col("p_type").alias("department"),
    )


def load(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return fact(spark, sf_dir), location(spark, sf_dir), product(spark, sf_dir)
