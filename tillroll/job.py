"""The whole batch: read a delivery, prepare it, publish every report."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession

from tillroll.operators import profile, require_unique, sum_by
from tillroll.plans import reports, rollups, trends
from tillroll.plans.prepare import FLAGS, checked, quality_of_rollups
from tillroll.schema import LOYALTY, MEASURE_PRECISION, MEASURE_SCALE
from tillroll.sinks import publish
from tillroll.sources import read_inputs
from tillroll.storage import cached, working_copy


def all_reports(
    seen: DataFrame, stores: DataFrame, categories: DataFrame, months: DataFrame
) -> dict[str, DataFrame]:
    """Result table by name, from the values by month, the two sales rollups and the monthly table."""
    long = trends.monthly_long(months)
    return {
        "top_provinces": reports.top_provinces(stores),
        "top_stores": reports.top_stores(stores),
        "top_to_average_overall": reports.top_to_average_overall(stores),
        "loyalty_vs_nonloyalty": reports.loyalty_vs_nonloyalty(stores),
        "top10_categories": reports.top10_categories(categories),
        "top5_stores_by_province": reports.top5_stores_by_province(stores),
        "top10_cat_by_dept": reports.top10_cat_by_dept(categories),
        "totals": reports.totals_of_seen(seen),
        "trends": trends.labelled(long),
        "top_stores_provinces": reports.top_stores_provinces(stores),
        "trends_yoy": trends.labelled(trends.year_over_year(long)),
        "trends_mom": trends.labelled(trends.month_over_month(long)),
        "trends_last12": trends.labelled(trends.last_months(long)),
    }


def publish_all(
    fact: DataFrame,
    location: DataFrame,
    product: DataFrame,
    write: Callable[[DataFrame, str], None],
    null_as: str = LOYALTY,
    precision: int = MEASURE_PRECISION,
    scale: int = MEASURE_SCALE,
) -> list[str]:
    """Publish every report of a conformed fact and its dimensions.

    The raw fact is read once: its cleaned rows, their months and what cleaning changed are kept as
    Parquet in the shared folder, and each report family then reads only its columns. Which transactions
    and collectors a month has is found once, for totals, trends and trailing values alike. That table and
    the small ones that several reports share are kept by the executors. A ``write`` that has ``commit`` and
    ``discard`` (see ``FileSet``) shows the tables as one set.
    """
    require_unique(profile({"store_location_key": location, "product_key": product}))
    with ExitStack() as stack:
        kept = stack.enter_context(working_copy(checked(fact, null_as, precision, scale), "fact"))
        stores = stack.enter_context(cached(rollups.store_sales(kept, location, FLAGS, is_unique=True)))
        by_product = rollups.category_sales(kept, product, is_unique=True)
        by_category = sum_by(by_product, ["department", "category"], sales="sales", rows="rows")
        categories = stack.enter_context(cached(by_category))
        seen = stack.enter_context(cached(trends.seen_by_month(kept)))
        months = stack.enter_context(cached(trends.monthly_of_seen(seen)))
        # Each is filled by one job, so that no two reports fill the same table. The months are counted from
        # the values, which are filled first; the two large reports of the values come before the small ones.
        with ThreadPoolExecutor(4) as pool:
            by_value, by_store, by_group = (pool.submit(shared.count) for shared in (seen, stores, categories))
            by_month = pool.submit(lambda: (by_value.result(), months.count()))
            tables = all_reports(seen, stores, categories, months)
            tables["trends_trailing12"] = trends.labelled(trends.trailing_of_seen(seen))
            tables["quality"] = quality_of_rollups(stores, categories)
            waits = {name: [by_value, by_month] if name.startswith("trends") else [by_store, by_group] for name in tables}
            waits |= dict.fromkeys(("totals", "trends_trailing12"), [by_value])
            return publish(tables, write, waits_for=waits)


def run(
    spark: SparkSession,
    root: str,
    write: Callable[[DataFrame, str], None],
    null_as: str = LOYALTY,
    by_folder: bool = False,
    precision: int = MEASURE_PRECISION,
    scale: int = MEASURE_SCALE,
) -> list[str]:
    """Publish every report of the files below ``root``."""
    return publish_all(*read_inputs(spark, root, by_folder=by_folder), write, null_as, precision, scale)
