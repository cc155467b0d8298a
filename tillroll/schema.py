"""Logical tables, header spellings and result labels."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType(), True) for name in names])


# Inputs are read as text and typed afterwards (plans.prepare.clean).
FACT = _strings(
    "store_location_key",
    "product_key",
    "collector_key",
    "trans_dt",
    "sales",
    "units",
    "trans_key",
)
LOCATION = _strings("store_location_key", "province", "store_num")
PRODUCT = _strings("product_key", "category", "department")

# Other header spellings of a declared column.
HEADER_ALIASES = {"trans_id": "trans_key"}

# A path holding the text has the role; any other path is a fact file.
ROLE_RULES = (("location", "location"), ("product", "product"))
DEFAULT_ROLE = "fact"

# Customer types and measure labels of the result tables.
LOYALTY = "Loyalty"
NON_LOYALTY = "NonLoyalty"
OVERALL = "Overall"
CUSTOMER_TYPES = (LOYALTY, NON_LOYALTY)
MEASURE_LABELS = {
    "sales": "total sales",
    "units": "total units",
    "transactions": "total distinct transactions",
    "collectors": "total distinct collectors",
}

# Default type of the two measures: exact, so sums do not depend on row order; a sum has ten digits more.
MEASURE_PRECISION = 28
MEASURE_SCALE = 6
