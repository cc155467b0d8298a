"""Grouped sums, rows for all customers together, pivot and long form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tillroll.schema import CUSTOMER_TYPES, OVERALL


def sum_by(df: DataFrame, keys: Sequence[str], **sums: str) -> DataFrame:
    """Sums (result name = column) for each combination of the keys, null keys included.

    Without keys there is always one row, whose sums are null if there is no input.
    """
    return df.groupBy(*keys).agg(*(F.sum(column).alias(name) for name, column in sums.items()))


def with_overall(
    df: DataFrame, keys: Sequence[str], overall: str = OVERALL, **sums: str
) -> DataFrame:
    """Sums by customer type and keys, and by the keys alone under the label ``overall``.

    The rows for all customers are added up from the rows by type, so the input is aggregated once
    and not copied for each grouping set. This holds for sums; distinct counts overlap between
    types (see ``distinct_by_type``).
    """
    by_type = sum_by(df, ["customer_type", *keys], **sums)
    names = list(keys)
    both = by_type.groupingSets(
        [["customer_type", *names], names], "customer_type", *names
    ).agg(
        F.grouping("customer_type").alias("_all"),
        *(F.sum(name).alias(name) for name in sums),
    )
    label = F.when(F.col("_all") == 1, F.lit(overall)).otherwise(F.col("customer_type"))
    return both.select(label.alias("customer_type"), *names, *sums)


def pivot_types(df: DataFrame, column: str, keys: Sequence[str] = ()) -> DataFrame:
    """One column per customer type with its sum; null for a type without rows."""
    return df.groupBy(*keys).pivot("customer_type", list(CUSTOMER_TYPES)).agg(F.sum(column))


def to_long(df: DataFrame, ids: Sequence[str], labels: Mapping[str, str]) -> DataFrame:
    """One row per measure column: the ids, its value as ``total`` and its label as ``measure``."""
    values = [F.col(name).cast("double").alias(label) for name, label in labels.items()]
    return (
        df.select(*ids, *values)
        .unpivot(list(ids), list(labels.values()), "measure", "total")
        .select(*ids, "total", "measure")
    )
