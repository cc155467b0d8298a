"""Distinct counts whose only large shuffle carries each key once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tillroll.schema import CUSTOMER_TYPES, OVERALL


def count_distinct(df: DataFrame, column: str, keys: Sequence[str] = (), name: str = "total") -> DataFrame:
    """Distinct non-null values in each group, in two steps.

    The first step groups by the value too, so a hot group is spread over all tasks and repeats of
    a hot value are dropped before the shuffle.
    """
    values = df.select(*keys, column).distinct()
    return values.groupBy(*keys).agg(F.count(column).alias(name))


def per_value(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], sums: Sequence[str] = (), apart: bool = False
) -> DataFrame:
    """One row per key and value of each column, flagged with the customer types it was seen under.

    Result: the keys, ``_column``, ``_value``, a flag ``_in_<type>`` per customer type, and the sums.
    The sums stand on the rows of a further column, the customer type itself: its copies shrink to a
    row per type before the shuffle, and the many other rows carry none.

    With ``apart`` the sums are added up in a pass of their own, and the rows of the other values need no
    room for them on the way: less work on a table that is as cheap to read twice.
    """
    kind_of = "customer_type"
    flags = [F.bool_or(F.col("_kind") == kind).alias(f"_in_{kind}") for kind in CUSTOMER_TYPES]
    if apart and sums:
        totals = df.groupBy(*keys, kind_of).agg(*(F.sum(name).alias(name) for name in sums))
        none = {name: F.lit(None).cast(totals.schema[name].dataType) for name in sums}
        of_kinds = totals.select(
            *keys,
            F.lit(kind_of).alias("_column"),
            F.col(kind_of).alias("_value"),
            *(F.col(kind_of).eqNullSafe(kind).alias(f"_in_{kind}") for kind in CUSTOMER_TYPES),
            *sums,
        )
        return per_value(df, keys, columns).withColumns(none).unionByName(of_kinds)
    columns = [*columns, *([kind_of] if sums else [])]
    copies = df.select(
        *keys,
        F.col(kind_of).alias("_kind"),
        *sums,
        *(F.col(column).cast("string").alias(column) for column in columns),
    ).unpivot([*keys, "_kind", *sums], columns, "_column", "_value")
    return copies.groupBy(*keys, "_column", "_value").agg(
        *flags,
        *(F.expr(f"sum(`{name}`) FILTER (WHERE _column = '{kind_of}')").alias(name) for name in sums),
    )


def fewer_keys(seen: DataFrame, keys: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """``per_value`` for some of the keys, or none, from ``per_value`` for all of them."""
    return seen.groupBy(*keys, "_column", "_value").agg(
        *(F.bool_or(f"_in_{kind}").alias(f"_in_{kind}") for kind in CUSTOMER_TYPES),
        *(F.sum(name).alias(name) for name in sums),
    )


def distinct_by_type(
    df: DataFrame,
    keys: Sequence[str],
    distinct: Mapping[str, str],
    sums: Sequence[str] = (),
    overall: str = OVERALL,
) -> DataFrame:
    """Distinct counts (result name = column) and sums, by type and for all customers together.

    A value seen under both types counts once in the overall row, so that row cannot be added up
    from the others. All rows are counted from ``per_value``: one pass over the input and one
    shuffle of (keys, value), without copies for each grouping set.
    """
    return by_type(per_value(df, keys, list(distinct.values()), sums), keys, distinct, sums, overall)


def by_type(
    seen: DataFrame,
    keys: Sequence[str],
    distinct: Mapping[str, str],
    sums: Sequence[str] = (),
    overall: str = OVERALL,
) -> DataFrame:
    """``distinct_by_type`` from the table that ``per_value`` makes for the same keys."""

    def counted(column: str, kind: str | None) -> Column:
        seen = (F.col("_column") == column) & F.col("_value").isNotNull()
        return F.count_if(seen & F.col(f"_in_{kind}") if kind else seen)

    kinds = (*CUSTOMER_TYPES, None)
    per_key = seen.groupBy(*keys).agg(
        *(F.bool_or(f"_in_{kind}").alias(f"_in_{kind}") for kind in CUSTOMER_TYPES),
        *(
            F.sum(F.when(F.col("_value") == kind, F.col(name)) if kind else F.col(name)).alias(
                f"_{name}_{kind}"
            )
            for kind in kinds
            for name in sums
        ),
        *(
            counted(column, kind).alias(f"_{name}_{kind}")
            for kind in kinds
            for name, column in distinct.items()
        ),
    )

    def row(kind: str | None) -> Column:
        return F.struct(
            F.lit(kind or overall).alias("customer_type"),
            (F.col(f"_in_{kind}") if kind else F.lit(True)).alias("_present"),
            *(F.col(f"_{name}_{kind}").alias(name) for name in (*sums, *distinct)),
        )

    rows = F.array(*(row(kind) for kind in kinds))
    return per_key.select(*keys, F.inline(rows)).filter("_present").drop("_present")
