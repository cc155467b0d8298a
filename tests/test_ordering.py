"""Places and ranks over a whole table: ties, nulls, hot values, and no task that holds it all."""

import random

import pytest
from pyspark.sql import functions as F

from micro import rows
from tillroll import operators as op


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def valued(spark):
    """Values with ties and nulls; a third of all rows hold one value."""
    draw = random.Random(2)
    made = [(i, 50 if i % 3 == 0 else draw.choice([None, *range(100)]), draw.choice("xyz")) for i in range(3000)]
    return made, spark.createDataFrame(made, "id long, v int, s string").repartition(8)


def test_positions_follow_the_order_without_gaps(spark, valued):
    made, df = valued
    placed = op.positioned(df, [F.desc_nulls_last("v"), F.asc("s")])
    assert placed.columns == ["id", "v", "s", "position"]
    order = sorted(made, key=lambda r: (r[1] is None, -(r[1] or 0), r[2], r[0]))
    assert [tuple(r) for r in placed.orderBy("position").collect()] == [(*r, k) for k, r in enumerate(order, 1)]


def test_equal_rows_get_places_of_their_own(spark):
    same = spark.range(0, 4000, 1, 8).select(F.lit("a").alias("k"), F.lit(None).cast("int").alias("v"))
    placed = op.positioned(same, [F.asc("k")])
    assert [r[0] for r in placed.select("position").orderBy("position").collect()] == list(range(1, 4001))
    assert op.positioned(same.limit(0), [F.asc("k")]).isEmpty()


def test_equal_rows_are_spread_over_ranges(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        same = spark.range(0, 4000, 1, 8).select(F.lit("a").alias("k"))
        files = [r[0] for r in op.positioned(same, [F.asc("k")]).groupBy(F.input_file_name()).count().select("count").collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(files) == 8 and max(files) < 1000


def test_maps_take_no_part_in_the_order(spark):
    df = spark.createDataFrame([(2, {"a": 1}), (1, {"b": 2})], "k int, m map<string,int>")
    assert rows(op.positioned(df, [F.asc("k")]), "k", "position") == [(1, 1), (2, 2)]


@pytest.mark.parametrize("limit", [None, 0])
def test_ranks_equal_counting(spark, valued, limit):
    made, df = valued
    if limit is None:
        ranked = op.ranked(df, "v")
    else:
        ranked = op.rank_whole(df, "v", broadcast_limit=limit, hot_share=0.05)
    known = [v for _, v, _ in made if v is not None]
    want = {v: 1 + sum(w > v for w in known) for v in known} | {None: len(known) + 1}
    assert rows(ranked, "id", "v", "rank") == sorted(((i, v, want[v]) for i, v, _ in made), key=repr)
    # No task ranks all rows; the one partition beside a shuffled lookup adds up its count of rows.
    assert "Window" not in plan(ranked)
    assert plan(ranked).count("SinglePartition") == (0 if limit is None else plan(ranked).count("partial_sum(rows"))


def test_ranks_of_nulls_alone_and_of_no_rows(spark, valued):
    _, df = valued
    nulls = df.withColumn("v", F.lit(None).cast("int"))
    assert {r["rank"] for r in op.ranked(nulls, "v").collect()} == {1}
    assert op.ranked(df.limit(0), "v").isEmpty()
