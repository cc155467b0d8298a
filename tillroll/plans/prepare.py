"""From text rows to the typed, enriched wide table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillroll.functions import (
    customer_type,
    has_known_date,
    loses_digits,
    measure,
    month_of_known,
    month_start,
)
from tillroll.operators.lookup import BROADCAST_BYTES, HOT_SHARE, lookup, profile, with_spread
from tillroll.schema import LOYALTY, MEASURE_PRECISION, MEASURE_SCALE

# The counts of ``quality`` in their order.
QUALITY = (
    "rows",
    "without_month",
    "without_province",
    "without_category",
    "without_collector",
    "without_sales",
    "without_units",
    "inexact_sales",
    "inexact_units",
)

WIDE_COLUMNS = (
    "customer_type",
    "collector_key",
    "trans_key",
    "trans_dt",
    "sales",
    "units",
    "province",
    "store_num",
    "category",
    "department",
)


def clean(
    fact: DataFrame,
    null_as: str = LOYALTY,
    precision: int = MEASURE_PRECISION,
    scale: int = MEASURE_SCALE,
) -> DataFrame:
    """Type the measures (absent or malformed becomes zero) and classify the customer."""
    return fact.withColumns(
        {
            "sales": measure(F.col("sales"), precision, scale),
            "units": measure(F.col("units"), precision, scale),
            "customer_type": customer_type(F.col("collector_key"), null_as),
        }
    )


# What cleaning fills in or cannot place, one flag each.
FLAGS = (
    "without_month",
    "without_collector",
    "without_sales",
    "without_units",
    "inexact_sales",
    "inexact_units",
)


def _flags(precision: int, scale: int, month: Column) -> dict[str, Column]:
    """The flags of a row whose measures are still text."""
    return dict(
        zip(
            FLAGS,
            (
                month.isNull(),
                F.col("collector_key").isNull(),
                F.col("sales").isNull(),
                F.col("units").isNull(),
                loses_digits(F.col("sales"), precision, scale),
                loses_digits(F.col("units"), precision, scale),
            ),
        )
    )


def checked(
    fact: DataFrame,
    null_as: str = LOYALTY,
    precision: int = MEASURE_PRECISION,
    scale: int = MEASURE_SCALE,
) -> DataFrame:
    """``clean`` with each row's month in place of its date text, and its flags: all that any report or
    count asks of the text, in one pass."""
    month = month_start(F.col("trans_dt"))
    flagged = fact.withColumns({"month": month, **_flags(precision, scale, month)})
    return clean(flagged, null_as, precision, scale).drop("trans_dt")


def dated(fact: DataFrame) -> DataFrame:
    """The rows whose date text is understood, with the first day of their month.

    A fact that has its months already (see ``checked``) is not read for them again.
    """
    if "month" in fact.columns:
        return fact.filter(F.col("month").isNotNull())
    known = fact.filter(has_known_date(F.col("trans_dt")))
    return known.withColumn("month", month_of_known(F.col("trans_dt")))


def enrich(
    fact: DataFrame,
    location: DataFrame,
    product: DataFrame,
    broadcast_limit: int = BROADCAST_BYTES,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Add store and product columns to every fact row; null where a key has no match."""
    location = location.select("store_location_key", "province", "store_num")
    product = product.select("product_key", "category", "department")
    measured = profile({"store_location_key": location, "product_key": product})
    # One hash, taken before the first shuffle, spares the shuffles the columns it is made of.
    rows = with_spread(fact, "_row")
    for key, dimension in (("store_location_key", location), ("product_key", product)):
        rows = lookup(rows, dimension, key, measured[key], broadcast_limit, fact, hot_share, "_row")
    return rows.drop("_row")


def prepare_wide(
    fact: DataFrame,
    location: DataFrame,
    product: DataFrame,
    null_as: str = LOYALTY,
    broadcast_limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """The table every report can be asked of; join keys are left behind."""
    wide = enrich(clean(fact, null_as), location, product, broadcast_limit)
    return wide.select(*WIDE_COLUMNS)


def quality(
    rows: DataFrame, precision: int = MEASURE_PRECISION, scale: int = MEASURE_SCALE
) -> DataFrame:
    """One row of counts over an enriched but uncleaned fact: what cleaning fills in or cannot place."""
    flags = _flags(precision, scale, month_start(F.col("trans_dt")))
    flags |= {"without_province": F.col("province").isNull(), "without_category": F.col("category").isNull()}
    counts = [F.count_if(flags[name]).alias(name) for name in QUALITY[1:]]
    return rows.agg(F.count(F.lit(1)).alias(QUALITY[0]), *counts)


def quality_of_rollups(stores: DataFrame, categories: DataFrame) -> DataFrame:
    """``quality`` from the numbers of rows in the two rollups of a checked fact; no row of the fact is
    read or joined. ``stores`` is counted by ``FLAGS``."""
    without = F.sum(F.when(F.col("category").isNull(), F.col("rows")))
    no_category = categories.agg(without.alias("without_category")).scalar()
    found = {name: F.sum(name) for name in ("rows", *FLAGS)}
    found["without_province"] = F.sum(F.when(F.col("province").isNull(), F.col("rows")))
    counts = stores.agg(*(total.alias(name) for name, total in found.items()))
    counts = counts.withColumn("without_category", no_category)
    return counts.select(*(F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name) for name in QUALITY))
