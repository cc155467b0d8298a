"""Column expressions: every function takes columns and returns a column."""

from tillroll.functions.dates import (
    date_label,
    has_known_date,
    month_index,
    month_of_known,
    month_start,
    padded_month,
)
from tillroll.functions.measures import (
    count_not_null,
    customer_type,
    exact,
    loses_digits,
    measure,
    percent,
    percent_label,
    whole,
)

__all__ = [
    "count_not_null",
    "customer_type",
    "date_label",
    "exact",
    "has_known_date",
    "loses_digits",
    "measure",
    "month_index",
    "month_of_known",
    "month_start",
    "padded_month",
    "percent",
    "percent_label",
    "whole",
]
