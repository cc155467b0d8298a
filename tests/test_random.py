"""Random small deliveries against plain loops over their rows."""

import random
from collections import defaultdict
from decimal import Decimal

import pytest

from micro import rows
from tillroll.operators import with_overall
from tillroll.plans import prepare, reports, rollups, trends
from tillroll.schema import FACT, LOCATION, PRODUCT


def delivery(seed):
    pick = random.Random(seed)
    fact = [
        (
            pick.choice(["1", "2", "3", "4", "9", None]),
            pick.choice(["100", "101", "102", "999", None]),
            pick.choice(["-2", "-1", "0", "1", "2", "3", "x", None]),
            pick.choice(["1/5/2015", "2015-01-09", "2/1/2015", "2015-12-31", "12/1/2014", "2016-3-1", "20150101", None]),
            pick.choice(["1.00", "2.00", "2.50", "-1.00", "x", None]),
            pick.choice(["1", "2", None]),
            pick.choice([f"T{i}" for i in range(12)] + [None]),
        )
        for _ in range(120)
    ]
    location = [("1", "ON", "501"), ("2", "ON", "502"), ("3", "QC", "601"), ("4", None, "701")]
    product = [("100", "Milk", "Dairy"), ("101", "Bread", "Bakery"), ("102", "Cheese", "Dairy")]
    return fact, location, product


def typed(fact, location, product):
    """The rows as dictionaries, cleaned and enriched one by one."""
    stores = {key: (province, number) for key, province, number in location}
    products = {key: (category, department) for key, category, department in product}

    def amount(text):
        return Decimal(text) if text not in (None, "x") else Decimal(0)

    def month(text):
        if not text or len(text) == 8 and text.isdigit():
            return None
        parts = text.split("/") if "/" in text else text.split("-")
        year, number = (parts[2], parts[0]) if "/" in text else (parts[0], parts[1])
        return f"{int(number):02d}-01-{year}"

    for store, sku, collector, date, sales, units, trans in fact:
        province, number = stores.get(store, (None, None))
        category, department = products.get(sku, (None, None))
        kind = "NonLoyalty" if collector and collector.startswith("-") else "Loyalty"
        yield {
            "customer_type": kind, "province": province, "store_num": number, "category": category,
            "department": department, "month": month(date), "sales": amount(sales), "units": amount(units),
            "trans": trans, "collector": collector,
        }


def sums(table, *keys):
    totals = defaultdict(Decimal)
    for row in table:
        totals[tuple(row[key] for key in keys)] += row["sales"]
    return totals


def best(totals, k, partition):
    """Rows with fewer than k larger totals among the rows that share the partition's leading keys."""
    return [
        (*key, float(total))
        for key, total in totals.items()
        if sum(1 for other, t in totals.items() if other[:partition] == key[:partition] and t > total) < k
    ]


@pytest.fixture(scope="module", params=range(3))
def case(request, spark):
    data = delivery(request.param)
    frames = [spark.createDataFrame(d, s).repartition(3) for d, s in zip(data, (FACT, LOCATION, PRODUCT))]
    table = list(typed(*data))
    both = table + [{**row, "customer_type": "Overall"} for row in table]
    return frames, table, both


def same(df, expected):
    assert rows(df) == sorted(expected, key=repr)


def test_store_reports(case):
    (fact, location, product), table, both = case
    for source in (
        prepare.prepare_wide(fact, location, product),
        rollups.store_sales(prepare.clean(fact), location),
        prepare.prepare_wide(fact, location, product, broadcast_limit=0),
    ):
        same(reports.top_provinces(source, k=2), best(sums(both, "customer_type", "province"), 2, 1))
        same(reports.top_stores(source), best(sums(both, "customer_type", "store_num"), 3, 1))
        same(reports.top_stores_provinces(source), best(sums(table, "customer_type", "province", "store_num"), 1, 2))
        same(
            with_overall(source, ["store_num"], total="sales"),
            [(*key, total) for key, total in sums(both, "customer_type", "store_num").items()],
        )


def test_category_reports(case):
    (fact, location, product), table, _ = case
    for source in (
        prepare.prepare_wide(fact, location, product),
        rollups.category_sales(prepare.clean(fact), product),
    ):
        same(reports.top10_categories(source, k=2), best(sums(table, "category"), 2, 0))


def measures(table, *keys):
    groups = defaultdict(list)
    for row in table:
        groups[tuple(row[key] for key in keys)].append(row)
    return [
        (
            *key,
            float(sum(row["sales"] for row in group)),
            float(sum(row["units"] for row in group)),
            len({row["trans"] for row in group} - {None}),
            len({row["collector"] for row in group} - {None}),
        )
        for key, group in groups.items()
    ]


def test_totals_and_trends(case):
    (fact, _, _), _, both = case
    same(reports.totals_wide(prepare.clean(fact)), measures(both, "customer_type"))
    dated = [row for row in both if row["month"]]
    same(trends.trends_wide(prepare.clean(fact)), measures(dated, "customer_type", "month"))


def test_trailing(case):
    (fact, _, _), _, both = case

    def index(month):
        return int(month[6:]) * 12 + int(month[:2])

    dated = [row for row in both if row["month"]]
    expected = []
    for kind, end in {(row["customer_type"], row["month"]) for row in dated}:
        inside = [
            row for row in dated if row["customer_type"] == kind and 0 <= index(end) - index(row["month"]) < 12
        ]
        values = measures(inside, "customer_type")[0][1:]
        labels = ("total sales", "total units", "total distinct transactions", "total distinct collectors")
        expected += [(kind, end, float(value), label) for value, label in zip(values, labels)]
    same(trends.labelled(trends.trailing(prepare.clean(fact))), expected)
