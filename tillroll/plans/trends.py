"""Monthly trends and comparisons between months.

``monthly`` and ``trailing`` scan the fact; everything else works on the result of ``monthly``,
which has one row per month and customer type.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillroll.functions import date_label, exact, month_index, percent
from tillroll.operators.distinct import by_type, per_value
from tillroll.operators.grouping import to_long
from tillroll.plans.prepare import dated
from tillroll.plans.reports import ADDITIVE, DISTINCT
from tillroll.schema import CUSTOMER_TYPES, MEASURE_LABELS, OVERALL

EPOCH = date(1970, 1, 1)


def seen_by_month(fact: DataFrame) -> DataFrame:
    """``per_value`` by month of a checked fact, rows without a month included: what ``totals_of_seen``,
    ``monthly_of_seen`` and ``trailing_of_seen`` are taken from. All rows of a value are in one partition."""
    seen = per_value(fact, ["month"], list(DISTINCT.values()), ADDITIVE, apart=True)
    return seen.repartition("_column", "_value")


def monthly(fact: DataFrame) -> DataFrame:
    """The four measures per month and customer type, of the rows whose month is known."""
    return monthly_of_seen(per_value(dated(fact), ["month"], list(DISTINCT.values()), ADDITIVE))


def monthly_of_seen(seen: DataFrame) -> DataFrame:
    """``monthly`` from ``per_value`` by month."""
    return by_type(seen.filter(F.col("month").isNotNull()), ["month"], DISTINCT, list(ADDITIVE)).select(
        "customer_type",
        "month",
        *(exact(F.col(name)).alias(name) for name in ADDITIVE),
        *DISTINCT,
    )


def monthly_long(months: DataFrame) -> DataFrame:
    """``monthly`` with one row per measure."""
    return to_long(months, ["customer_type", "month"], MEASURE_LABELS)


def labelled(table: DataFrame) -> DataFrame:
    """Replace the month by its result spelling ``trans_dt``."""
    columns = [date_label(F.col(c)).alias("trans_dt") if c == "month" else c for c in table.columns]
    return table.select(*columns)


def trends_wide(fact: DataFrame) -> DataFrame:
    return labelled(monthly(fact))


def trends(fact: DataFrame) -> DataFrame:
    return labelled(monthly_long(monthly(fact)))


def _series() -> Window:
    return Window.partitionBy("customer_type", "measure").orderBy(month_index(F.col("month")))


def compare(long: DataFrame, months_back: int, name: str) -> DataFrame:
    """Each value beside the value ``months_back`` months earlier: difference and percent change.

    Looks up the exact month, so a month without rows leaves a null instead of shifting the others.
    """
    then = F.max("total").over(_series().rangeBetween(-months_back, -months_back))
    return long.withColumn(name, then).withColumns(
        {
            "delta": F.col("total") - F.col(name),
            "percent": percent(F.col("total") - F.col(name), F.col(name)),
        }
    )


def year_over_year(long: DataFrame) -> DataFrame:
    return compare(long, 12, "year_before")


def month_over_month(long: DataFrame) -> DataFrame:
    return compare(long, 1, "month_before")


def last_months(long: DataFrame, months: int = 12) -> DataFrame:
    """Rows of the last months, counted back from the latest month of the table."""
    latest = F.max("month").over(Window.partitionBy())
    return (
        long.withColumn("_latest", latest)
        .filter(F.col("month") > F.add_months("_latest", -months))
        .drop("_latest")
    )


def trailing(fact: DataFrame, months: int = 12) -> DataFrame:
    """All four measures of the months ending with each month.

    Distinct counts of months cannot be added up. A value seen in a month counts for that month
    and the ``months - 1`` after it; where two such stretches of a value overlap, the later one
    begins when the earlier one ends. The stretches that begin (+1) and end (-1) are counted per
    month, and the running sum is the result. One pass over the fact, whose work does not grow
    with ``months``.
    """
    return trailing_of_seen(per_value(dated(fact), ["month"], list(DISTINCT.values()), ADDITIVE), months)


def trailing_of_seen(seen: DataFrame, months: int = 12) -> DataFrame:
    """``trailing`` from ``per_value`` by month."""
    kinds = (*CUSTOMER_TYPES, OVERALL)
    seen = seen.filter(F.col("month").isNotNull()).withColumn("at", month_index(F.col("month")))

    # A value has at most one row per month, so none makes a large window partition.
    earlier = (
        Window.partitionBy("_column", "_value")
        .orderBy("at")
        .rowsBetween(Window.unboundedPreceding, -1)
    )

    def begin(kind: str) -> Column:
        present = F.lit(True) if kind == OVERALL else F.col(f"_in_{kind}")
        before = F.last(F.when(present, F.col("at")), ignorenulls=True).over(earlier)
        return F.when(present, F.greatest(F.col("at"), before + F.lit(months))).alias(f"begin_{kind}")

    # Null values, one row per month, are seen but not counted.
    stretches = (
        seen.select("_column", "_value", "at", *ADDITIVE, *map(begin, kinds))
        .groupBy("_column", "at", *(f"begin_{kind}" for kind in kinds))
        .agg(F.count("_value").alias("values"), *(F.sum(name).alias(name) for name in ADDITIVE))
    )

    def change(kind: str, at: Column, step: Column, has_rows: bool) -> Column:
        return F.struct(
            F.when(F.col(f"begin_{kind}").isNotNull(), F.lit(kind)).alias("customer_type"),
            at.alias("at"),
            step.alias("step"),
            F.lit(has_rows).alias("has_rows"),
            *(F.when(F.lit(has_rows), F.col(name)).alias(name) for name in ADDITIVE),
        )

    values, at = F.col("values"), F.col("at")
    changes = [
        one
        for kind in kinds
        for one in (
            change(kind, F.col(f"begin_{kind}"), values, False),
            change(kind, at + F.lit(months), -values, False),
            # Months in which the type has rows are the months of the result.
            change(kind, at, F.lit(0).cast("long"), True),
        )
    ]
    steps = (
        stretches.select("_column", F.inline(F.array(*changes)))
        .filter(F.col("customer_type").isNotNull())
        .groupBy("customer_type", "_column", "at")
        .agg(
            F.bool_or("has_rows").alias("has_rows"),
            *(F.sum(name).alias(name) for name in ("step", *ADDITIVE)),
        )
    )

    series = Window.partitionBy("customer_type", "_column").orderBy("at")
    window = series.rangeBetween(1 - months, 0)
    running = F.sum("step").over(series).cast("double")

    def result(name: str, total: Column) -> Column:
        return F.struct(total.alias("total"), F.lit(MEASURE_LABELS[name]).alias("measure"))

    by_column = [
        (F.col("_column") == column, F.array(result(name, F.col("running"))))
        for name, column in DISTINCT.items()
    ]
    measures = F.array(*(result(name, F.col(name)) for name in ADDITIVE))
    for is_column, counts in by_column:
        measures = F.when(is_column, counts).otherwise(measures)
    return (
        steps.withColumns(
            {"running": running, **{name: exact(F.sum(name).over(window)) for name in ADDITIVE}}
        )
        .filter("has_rows")
        .select(
            "customer_type",
            F.add_months(F.lit(EPOCH), F.col("at") - month_index(F.lit(EPOCH))).alias("month"),
            F.inline(measures),
        )
    )
