from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tillroll import functions as fn


@pytest.fixture(params=["true", "false"], autouse=True)
def ansi(request, spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


def values(spark, texts, expression, type="string"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, x {type}")
    return [row.y for row in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_customer_type(spark):
    keys = ["-1", "-1.0", "1", "7.5", "0", None, "abc", "-0", " -3 "]
    by_sign = ["NonLoyalty", "NonLoyalty", "Loyalty", "Loyalty"]
    assert values(spark, keys, fn.customer_type) == by_sign + ["Loyalty"] * 4 + ["NonLoyalty"]
    other = values(spark, keys, lambda c: fn.customer_type(c, null_as="NonLoyalty"))
    assert other == by_sign + ["NonLoyalty"] * 5
    with pytest.raises(ValueError):
        fn.customer_type(F.lit("1"), null_as="Other")


def test_measure(spark):
    texts = ["10.50", None, "", "abc", "-3", "1e2", "0.125"]
    assert values(spark, texts, fn.measure) == [Decimal(x) for x in ("10.50", "0", "0", "0", "-3", "100", "0.125")]
    assert values(spark, texts, lambda c: fn.measure(c, 18, 3))[-1] == Decimal("0.125")
    assert values(spark, texts, lambda c: fn.loses_digits(c, 18, 2)) == [False, False, True, True, False, False, True]
    assert values(spark, texts, fn.loses_digits)[-1] is False
    exact = ["1.500000", "1.50000000000", "2e3", "1.234567e3", "-0.000001", " 7.25 ", "1.", ".5"]
    assert values(spark, exact, fn.loses_digits) == [False] * len(exact)
    changed = ["10.00000000001", "0.0000001", "1e-7", "1.23456789e1", "NaN", "x", "1,5", "-3.1234567"]
    assert values(spark, changed, fn.loses_digits) == [True] * len(changed)
    assert values(spark, ["99999999999999999", "NaN"], fn.measure) == [Decimal("99999999999999999"), 0]
    with pytest.raises(Exception, match="too large"):
        values(spark, ["99999999999999999"], lambda c: fn.measure(c, 18, 2))


def test_month_start(spark):
    known = {
        "1/5/2015": "01-01-2015", "12/31/2015": "12-01-2015", "02/1/2016": "02-01-2016",
        "2015-1-20": "01-01-2015", "2015-11-09": "11-01-2015", "2/30/2015": "02-01-2015",
    }
    assert values(spark, list(known), lambda c: fn.date_label(fn.month_start(c))) == list(known.values())
    unknown = [None, "", "20150301", "1/2-2015", "13/1/2015", "0/1/2015", "2015-13-1", "1/5/15", "x", "a/b/c",
               "2015/1/5", "5-1-2015", "1/5/2015 10:00", "111/1/2015"]
    assert values(spark, unknown, fn.month_start) == [None] * len(unknown)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text("0123456789/-", max_size=10), min_size=1, max_size=200))
def test_month_start_takes_any_text(spark, texts):
    months = values(spark, texts, fn.month_start)
    accepted = values(spark, texts, fn.has_known_date)
    assert [month is not None for month in months] == accepted


def test_neighbouring_months_differ_by_one(spark):
    dates = ["2014-12-01", "2015-01-01", "2015-02-01"]
    indexes = values(spark, dates, lambda c: fn.month_index(c.cast("date")))
    assert [b - a for a, b in zip(indexes, indexes[1:])] == [1, 1]


def test_percent_label(spark):
    df = spark.createDataFrame(
        [(0, 5.5, 2.0), (1, 1.0, 0.0), (2, None, 2.0), (3, 1.0, 8.0), (4, 2.5e8, 10.0)], "i int, a double, b double"
    )
    labels = df.orderBy("i").select(fn.percent_label(F.col("a"), F.col("b")).alias("l")).collect()
    assert [row.l for row in labels] == ["275.0%", None, None, "13.0%", "2.5E9%"]


def test_whole_rounds_half_away_from_zero(spark):
    numbers = [Decimal("2.50"), Decimal("-2.50"), Decimal("2.49"), None]
    assert values(spark, numbers, fn.whole, "decimal(18,2)") == [3.0, -3.0, 2.0, None]


def test_count_not_null(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b")], "x double, y string")
    counts = df.agg(fn.count_not_null("x"), fn.count_not_null("x", nan_as_null=True).alias("z"), fn.count_not_null("y"))
    assert tuple(counts.first()) == (2, 1, 2)
    assert tuple(df.filter("false").agg(fn.count_not_null("x")).first()) == (0,)


def test_padded_month_cuts_longer_text(spark):
    assert values(spark, ["1", "12", "123", None], fn.padded_month) == ["01", "12", "12", None]
