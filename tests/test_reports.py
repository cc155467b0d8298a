"""Reports over the micro fixture against hand-checked results."""

import pytest
from pyspark.sql import functions as F

import micro
from micro import rows
from tillroll.operators import sum_by
from tillroll.plans import prepare, reports, rollups, trends
from tillroll.schema import MEASURE_LABELS
from tillroll.sources import read_inputs


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    return read_inputs(spark, micro.write(tmp_path_factory.mktemp("micro")))


@pytest.fixture(scope="module")
def wide(star):
    return prepare.prepare_wide(*star).cache()


@pytest.fixture(scope="module")
def fact(star):
    return prepare.clean(star[0]).cache()


def same(df, expected):
    assert rows(df) == sorted(expected, key=repr)


TOP_PROVINCES = [
    ("Loyalty", "ON", 70.5), ("Loyalty", "QC", 5.0), ("Loyalty", "MB", 5.0),
    ("NonLoyalty", None, 40.0), ("NonLoyalty", "ON", 10.0), ("NonLoyalty", "QC", 7.0),
    ("Overall", "ON", 80.5), ("Overall", None, 40.0), ("Overall", "QC", 12.0),
]
TOP_STORES = [
    ("Loyalty", "501", 40.0), ("Loyalty", "502", 30.5), ("Loyalty", "601", 5.0), ("Loyalty", "701", 5.0),
    ("NonLoyalty", None, 40.0), ("NonLoyalty", "501", 10.0), ("NonLoyalty", "601", 7.0),
    ("Overall", "501", 50.0), ("Overall", None, 40.0), ("Overall", "502", 30.5),
]
TOP_TO_AVERAGE = [
    ("MB", "701", 5.0, 5.0, "100.0%"), ("ON", "501", 50.0, 40.25, "124.0%"), ("QC", "601", 12.0, 12.0, "100.0%"),
]
TOP5_STORES = [
    (None, None, 40.0), ("MB", "701", 5.0), ("ON", "501", 50.0), ("ON", "502", 31.0), ("QC", "601", 12.0),
]
BEST_STORES = [
    ("Loyalty", "MB", "701", 5.0), ("Loyalty", "ON", "501", 40.0), ("Loyalty", "QC", "601", 5.0),
    ("NonLoyalty", None, None, 40.0), ("NonLoyalty", "ON", "501", 10.0), ("NonLoyalty", "QC", "601", 7.0),
]
CATEGORIES = [("Milk", 60.0), ("Cheese", 30.5), ("Bread", 27.0), (None, 20.0)]
CATEGORIES_BY_DEPARTMENT = [
    (None, None, 20.0), ("Bakery", "Bread", 27.0), ("Dairy", "Milk", 60.0), ("Dairy", "Cheese", 31.0),
]
TOTALS = [("Loyalty", 80.5, 8.0, 5, 3), ("NonLoyalty", 57.0, 6.0, 3, 1), ("Overall", 137.5, 14.0, 7, 4)]
TRENDS = [
    ("Loyalty", "01-01-2015", 40.0, 3.0, 1, 2), ("Loyalty", "02-01-2015", 30.5, 3.0, 2, 2),
    ("Loyalty", "01-01-2016", 5.0, 1.0, 1, 0), ("Loyalty", "02-01-2016", 5.0, 1.0, 1, 1),
    ("NonLoyalty", "01-01-2015", 10.0, 1.0, 1, 1),
    ("Overall", "01-01-2015", 50.0, 4.0, 1, 3), ("Overall", "02-01-2015", 30.5, 3.0, 2, 2),
    ("Overall", "01-01-2016", 5.0, 1.0, 1, 0), ("Overall", "02-01-2016", 5.0, 1.0, 1, 1),
]


@pytest.mark.parametrize(
    "report, expected",
    [
        (reports.top_provinces, TOP_PROVINCES),
        (reports.top_stores, TOP_STORES),
        (reports.top_to_average_overall, TOP_TO_AVERAGE),
        (reports.loyalty_vs_nonloyalty, [(80.5, 57.0, "141.0%")]),
        (reports.top5_stores_by_province, TOP5_STORES),
        (reports.top_stores_provinces, BEST_STORES),
    ],
)
def test_store_reports_over_wide_table_and_rollup(star, wide, fact, report, expected):
    same(report(wide), expected)
    same(report(rollups.store_sales(fact, star[1])), expected)


@pytest.mark.parametrize(
    "report, expected",
    [(reports.top10_categories, CATEGORIES), (reports.top10_cat_by_dept, CATEGORIES_BY_DEPARTMENT)],
)
def test_category_reports_over_wide_table_and_rollup(star, wide, fact, report, expected):
    same(report(wide), expected)
    same(report(rollups.category_sales(fact, star[2])), expected)


def test_null_keys_can_be_left_out(wide):
    same(reports.top10_categories(wide, drop_null_keys=True), CATEGORIES[:3])
    same(
        reports.top_provinces(wide, k=1, drop_null_keys=True),
        [("Loyalty", "ON", 70.5), ("NonLoyalty", "ON", 10.0), ("Overall", "ON", 80.5)],
    )
    same(reports.top5_stores_by_province(wide, drop_null_keys=True), TOP5_STORES[1:])
    same(reports.top10_cat_by_dept(wide, drop_null_keys=True), CATEGORIES_BY_DEPARTMENT[1:])


def test_best_stores_of_rows_with_a_month(wide):
    dated = prepare.dated(wide)
    same(reports.top_stores_provinces(dated), [row for row in BEST_STORES if row[:2] != ("NonLoyalty", None)
                                               and row != ("NonLoyalty", "QC", "601", 7.0)])


def test_totals(wide, fact):
    same(reports.totals_wide(wide), TOTALS)
    same(reports.totals_wide(fact), TOTALS)
    long = rows(reports.totals(fact))
    assert len(long) == 12
    assert ("Overall", 7.0, "total distinct transactions") in long
    assert {row[2] for row in long} == set(MEASURE_LABELS.values())


def test_trends(wide, fact):
    same(trends.trends_wide(wide), TRENDS)
    long = rows(trends.trends(fact))
    assert len(long) == 4 * len(TRENDS)
    assert ("Overall", "01-01-2015", 3.0, "total distinct collectors") in long


def overall_sales(df, *columns):
    chosen = (F.col("customer_type") == "Overall") & (F.col("measure") == "total sales")
    return rows(trends.labelled(df).filter(chosen), "trans_dt", *columns)


def test_comparisons_of_months(fact):
    long = trends.monthly_long(trends.monthly(fact))
    assert overall_sales(trends.year_over_year(long), "total", "year_before", "delta", "percent") == sorted([
        ("01-01-2015", 50.0, None, None, None), ("02-01-2015", 30.5, None, None, None),
        ("01-01-2016", 5.0, 50.0, -45.0, -90.0), ("02-01-2016", 5.0, 30.5, -25.5, -25.5 * 100 / 30.5),
    ], key=repr)
    assert overall_sales(trends.month_over_month(long), "total", "month_before", "delta") == sorted([
        ("01-01-2015", 50.0, None, None), ("02-01-2015", 30.5, 50.0, -19.5),
        ("01-01-2016", 5.0, None, None), ("02-01-2016", 5.0, 5.0, 0.0),
    ], key=repr)
    assert overall_sales(trends.last_months(long), "total") == [("01-01-2016", 5.0), ("02-01-2016", 5.0)]
    assert overall_sales(trends.last_months(long, 13), "total") == [
        ("01-01-2016", 5.0), ("02-01-2015", 30.5), ("02-01-2016", 5.0)]


@pytest.mark.parametrize("months", [1, 2, 11, 12, 13, 30])
def test_trailing_values_equal_looking_back_from_each_month(fact, months):
    dated = prepare.dated(fact).collect()
    expected = []
    for kind in ("Loyalty", "NonLoyalty", "Overall"):
        seen = [row for row in dated if kind in ("Overall", row.customer_type)]
        for end in {row.month for row in seen}:
            def back(row):
                return (end.year - row.month.year) * 12 + end.month - row.month.month
            inside = [row for row in seen if 0 <= back(row) < months]
            values = {
                "sales": sum(row.sales for row in inside),
                "units": sum(row.units for row in inside),
                "transactions": len({row.trans_key for row in inside}),
                "collectors": len({row.collector_key for row in inside} - {None}),
            }
            label = end.strftime("%m-%d-%Y")
            expected += [(kind, label, float(value), MEASURE_LABELS[name]) for name, value in values.items()]
    same(trends.labelled(trends.trailing(fact, months)), expected)


def test_measures_keep_a_finer_scale(spark, star):
    fact = star[0].withColumn("sales", F.lit("0.125"))
    fine = prepare.clean(fact, scale=3)
    assert rows(reports.totals_wide(fine), "customer_type", "sales")[-1] == ("Overall", 9 * 0.125)
    last = overall_sales(trends.trailing(fine), "total")
    assert ("02-01-2016", 0.25) in last and ("02-01-2015", 0.625) in last
    assert prepare.quality(prepare.enrich(fact, *star[1:]), 18, 2).first().inexact_sales == 9


def test_quality(star):
    counts = prepare.quality(prepare.enrich(*star)).first().asDict()
    assert counts == {
        "rows": 9, "without_month": 2, "without_province": 1, "without_category": 1, "without_collector": 1,
        "without_sales": 1, "without_units": 1, "inexact_sales": 0, "inexact_units": 0,
    }


def test_overall_agrees_with_the_types(wide):
    totals = {row.customer_type: row for row in reports.totals_wide(wide).collect()}
    parts = totals["Loyalty"], totals["NonLoyalty"]
    assert totals["Overall"].sales == sum(row.sales for row in parts)
    assert totals["Overall"].transactions < sum(row.transactions for row in parts)


def test_row_order_and_unlimited_k_change_nothing(wide):
    shuffled = wide.orderBy(F.desc("trans_key"), "sales").repartition(5)
    same(reports.top_stores(shuffled), TOP_STORES)
    everything = rows(reports.top5_stores_by_province(wide, k=10**6), "province", "store_num")
    assert everything == rows(sum_by(wide, ["province", "store_num"], total="sales"), "province", "store_num")


def test_an_absent_customer_type(fact):
    loyal = fact.filter("customer_type = 'Loyalty'")
    same(reports.loyalty_vs_nonloyalty(loyal), [(80.5, None, None)])
    same(reports.totals_wide(loyal), [TOTALS[0], ("Overall", *TOTALS[0][1:])])


def test_no_rows(fact):
    nothing = fact.filter("false")
    same(reports.totals_wide(nothing), [("Overall", None, None, 0, 0)])
    same(trends.trends_wide(nothing), [])
    same(trends.labelled(trends.trailing(nothing)), [])


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_results_do_not_depend_on_ansi_mode(spark, tmp_path, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        wide = prepare.prepare_wide(*read_inputs(spark, micro.write(tmp_path)))
        same(reports.top_to_average_overall(wide), TOP_TO_AVERAGE)
        same(reports.totals_wide(wide), TOTALS)
        same(trends.trends_wide(wide), TRENDS)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
