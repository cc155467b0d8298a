"""Totals, trends and trailing values from one table of the values of each month."""

import micro
import pytest
from micro import rows

from tillroll import job, operators as op, sinks
from tillroll.plans import prepare, reports, trends
from tillroll.sources import read_inputs

FACT = "trans_key string, collector_key string, trans_dt string, sales string, units string"
ROWS = [
    ("t1", "5", "1/5/2015", "1.5", "1"),
    ("t1", "-5", "2015-01-09", "2", "1"),  # a transaction of both types
    ("t1", "5", "2/1/2015", "4", None),
    ("t2", "5", "2016-03-01", "8", "2"),
    ("t2", "5", "2016-03-01", "8", "2"),  # a repeated row
    (None, None, "3/1/2016", "16", "3"),
    ("t3", "-7", "sometime", "32", "4"),  # no month
    ("t3", None, None, "n/a", "5"),
    ("t4", "", "2015-01-31", None, "6"),
]


@pytest.fixture(params=[ROWS, ROWS[6:7], []], ids=["rows", "no month", "empty"])
def fact(spark, request):
    return prepare.checked(spark.createDataFrame(request.param, FACT))


def test_reports_of_seen_values_equal_reports_of_the_fact(fact):
    seen = trends.seen_by_month(fact).persist()
    try:
        assert rows(reports.totals_of_seen(seen)) == rows(reports.totals(fact))
        assert rows(trends.monthly_of_seen(seen)) == rows(trends.monthly(fact))
        assert rows(trends.trailing_of_seen(seen)) == rows(trends.trailing(fact))
    finally:
        seen.unpersist()


def test_sums_apart_are_the_same(fact):
    columns, sums = ["trans_key", "collector_key"], ["sales", "units"]
    whole = op.per_value(fact, ["month"], columns, sums)
    apart = op.per_value(fact, ["month"], columns, sums, apart=True)
    assert apart.dtypes == whole.dtypes
    assert rows(apart) == rows(whole)
    assert rows(op.fewer_keys(apart, [], sums)) == rows(op.per_value(fact, [], columns, sums))


def test_values_are_found_once_for_all_reports(spark, tmp_path):
    plans = {}

    def write(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        sinks.write_files(df, name, str(tmp_path / "out"))

    job.publish_all(*read_inputs(spark, micro.write(tmp_path)), write)
    for name in ("totals", "trends_trailing12", "trends"):
        assert "InMemoryRelation" in plans[name], name
        assert "parquet" not in plans[name].split("InMemoryRelation")[0].lower(), name


def test_all_rows_of_a_value_meet_without_another_shuffle(spark, fact):
    seen = trends.seen_by_month(fact).persist()
    try:
        seen.count()
        found = op.fewer_keys(seen, [])
        above = found._jdf.queryExecution().executedPlan().toString().split("InMemoryTableScan")[0]
        assert "Exchange" not in above
    finally:
        seen.unpersist()
