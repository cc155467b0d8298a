import pytest
from pyspark.sql import functions as F

from checks import star
from micro import rows
from tillroll import operators as op, storage
from tillroll.operators.lookup import BUILD_BYTES, HOT_SHARE, Profile, _hot_keys
from tillroll.plans import prepare, trends

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """Delivered rows of which a third have one store and another third none."""
    turn = F.col("trans_key").cast("long") % 3
    key = F.when(turn == 0, F.lit("1")).when(turn == 1, F.col("store_location_key"))
    return star.fact(spark, SF_DIR).withColumn("store_location_key", key)


def test_profile_measures_in_one_row_per_dimension(spark):
    stores = spark.createDataFrame([("1", "ON"), ("1", "QC"), ("2", None), (None, "x"), (None, "y")], "k string, p string")
    other = spark.createDataFrame([], "j string")
    measured = op.profile({"k": stores, "j": other})
    assert measured["k"].repeated_keys == 1 and measured["j"] == Profile(0, 0)
    assert measured["k"].bytes > 5 * 16


def test_lookup_refuses_repeated_keys(spark):
    dimension = spark.createDataFrame([("1", "ON"), ("1", "QC")], "k string, p string")
    fact = spark.createDataFrame([("1",)], "k string")
    with pytest.raises(op.DuplicateKeys):
        op.lookup(fact, dimension, "k", op.profile({"k": dimension})["k"])


@pytest.mark.parametrize("share", [HOT_SHARE, 0.2, 1.0])
def test_large_lookup_equals_broadcast_on_skewed_keys(spark, skewed, share):
    key = "store_location_key"
    location = star.location(spark, SF_DIR)
    measured = op.profile({key: location})[key]
    small = op.lookup(skewed, location, key, measured)
    large = op.lookup(skewed, location, key, measured, 0, hot_share=share)
    columns = ["trans_key", "product_key", key, "sales", "province", "store_num"]
    assert rows(large, *columns) == rows(small, *columns)
    assert "BroadcastHashJoin" in plan(small) and "ShuffledHashJoin" in plan(large)


def test_very_large_dimensions_are_sorted(spark, skewed):
    key = "store_location_key"
    huge = Profile(BUILD_BYTES * 8 + 1, 0)
    joined = op.lookup(skewed, star.location(spark, SF_DIR), key, huge)
    assert "SortMergeJoin [store_location_key" in plan(joined)
    assert joined.count() == 6000


def test_large_lookup_spreads_hot_keys_and_missing_keys(spark, skewed):
    key = "store_location_key"
    location = star.location(spark, SF_DIR)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = op.lookup(skewed, location, key, op.profile({key: location})[key], 0, hot_share=0.1)
        sizes = joined.groupBy(F.spark_partition_id()).count().select("count")
        sizes = [row[0] for row in sizes.collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    # Eight partitions: a hot key kept together would make one of a third of all rows.
    assert max(sizes) < 0.2 * sum(sizes)


def test_hot_keys_are_few_whatever_the_data(spark):
    keys = spark.range(5000).select((F.col("id") % 1000).cast("string").alias("k"))
    assert _hot_keys(keys, "k", 0.001).count() == 0
    one_hot = keys.unionByName(keys.limit(50).select(F.lit("7").alias("k")))
    assert rows(_hot_keys(one_hot, "k", 0.001), "_hot") == [("7",)]
    assert 1 / HOT_SHARE <= 100_001


def test_two_large_lookups_pass_once_over_the_fact_besides_counting(spark):
    enriched = prepare.enrich(*star.load(spark, SF_DIR), broadcast_limit=0)
    assert enriched.columns[-4:] == ["province", "store_num", "category", "department"]
    enriched.collect()
    final = plan(enriched).split("Initial Plan")[0]
    whole_scans = [line for line in final.splitlines() if "FileScan" in line and "l_extendedprice" in line]
    assert len(whole_scans) == 1 and "Union" not in final


def test_wide_rows_of_hot_keys_are_dealt_and_not_broadcast(spark, skewed):
    key = "store_location_key"
    wide = star.location(spark, SF_DIR).withColumn("store_num", F.repeat("store_num", 200_000))
    measured = op.profile({key: wide})[key]
    assert measured.largest_row > 200_000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = op.lookup(skewed, wide, key, measured, 0, hot_share=0.1)
        text = plan(joined)
        sizes = joined.groupBy(F.spark_partition_id()).agg(F.count("store_num").alias("n")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    # Both sides meet in a shuffle; the broadcasts hold hashes and numbers of deals alone.
    assert "ShuffledHashJoin" in text or "SortMergeJoin" in text
    for line in text.splitlines():
        if "BroadcastHashJoin" in line and key in line:
            assert "_hash" in line
    found = [row["n"] for row in sizes]
    assert max(found) < 0.25 * sum(found)
    small = op.lookup(skewed, star.location(spark, SF_DIR), key, op.profile({key: star.location(spark, SF_DIR)})[key])
    longer = joined.select("trans_key", key, F.length("store_num").alias("n"))
    assert rows(longer) == rows(small.select("trans_key", key, (F.length("store_num") * 200_000).alias("n")))


def test_hot_share_bounds_what_is_broadcast(spark, skewed):
    key = "store_location_key"
    location = star.location(spark, SF_DIR)
    for share in (0, -1, 1e-9):
        with pytest.raises(ValueError, match="hot_share"):
            op.lookup(skewed, location, key, op.profile({key: location})[key], 0, hot_share=share)


def test_lookup_needs_equal_key_types(spark):
    fact = spark.createDataFrame([("1",)], "k string")
    dimension = spark.createDataFrame([(1, "ON")], "k int, p string")
    with pytest.raises(TypeError, match="another type"):
        op.lookup(fact, dimension, "k", op.profile({"k": dimension})["k"], broadcast_limit=0)


def test_top_n_keeps_ties_and_ranks_nulls_last(spark):
    df = spark.createDataFrame([("a", 5), ("b", 3), ("c", 3), ("d", 1), ("e", None)], "k string, v int")
    assert rows(op.top_n(df, "v", 2)) == [("a", 5), ("b", 3), ("c", 3)]
    assert rows(op.top_n(df, "v", 3)) == [("a", 5), ("b", 3), ("c", 3)]
    assert len(rows(op.top_n(df, "v", 5))) == 5
    assert rows(op.ranked(df, "v"), "k", "rank")[-2:] == [("d", 4), ("e", 5)]


def test_top_n_beyond_the_early_cut_ranks_only_what_reaches_the_border(spark):
    df = spark.range(9000).select((F.col("id") / 3).cast("long").alias("v"), "id")
    best = op.top_n(df, "v", 2000)
    assert best.count() == 2001
    assert best.agg(F.min("v")).first()[0] == 2333
    text = plan(best)
    assert "TakeOrderedAndProject" in text and "Subquery" in text
    nulls = df.withColumn("v", F.when(F.col("id") < 1500, F.col("v")))
    assert op.top_n(nulls, "v", 1500).count() == 1500
    assert op.top_n(nulls, "v", 1501).count() == 9000


@pytest.mark.parametrize("partition", [[], ["k"]])
def test_top_n_cuts_rows_before_the_shuffle(spark, partition):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    text = plan(op.top_n(df, "v", 2, partition))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_with_overall_aggregates_the_input_once(spark):
    df = spark.createDataFrame([("Loyalty", "a", 1), ("NonLoyalty", "a", 2), ("Loyalty", None, 4)],
                               "customer_type string, k string, v int")
    result = op.with_overall(df, ["k"], total="v")
    assert rows(result) == [("Loyalty", "a", 1), ("Loyalty", None, 4), ("NonLoyalty", "a", 2),
                            ("Overall", "a", 3), ("Overall", None, 4)]
    assert rows(op.with_overall(df, [], total="v")) == [("Loyalty", 5), ("NonLoyalty", 2), ("Overall", 7)]


def test_sums_without_rows(spark):
    nothing = spark.createDataFrame([], "k string, v int")
    assert rows(op.sum_by(nothing, [], total="v")) == [(None,)]
    assert rows(op.sum_by(nothing, ["k"], total="v")) == []


def test_distinct_counts_by_type(spark):
    df = spark.createDataFrame(
        [("Loyalty", "a", "x", 1), ("NonLoyalty", "a", None, 2), ("Loyalty", "b", "x", 4), ("Loyalty", None, "Loyalty", 8)],
        "customer_type string, t string, c string, v int",
    )
    result = op.distinct_by_type(df, [], {"ts": "t", "cs": "c"}, ["v"])
    assert rows(result) == [("Loyalty", 13, 2, 2), ("NonLoyalty", 2, 1, 0), ("Overall", 15, 2, 2)]
    assert rows(op.distinct_by_type(df, [], {"ts": "t"})) == [("Loyalty", 2), ("NonLoyalty", 1), ("Overall", 2)]
    assert rows(op.count_distinct(df, "c", ["customer_type"])) == [("Loyalty", 2), ("NonLoyalty", 0)]


def test_distinct_counts_shuffle_values_not_groups(spark):
    fact = prepare.clean(star.fact(spark, SF_DIR))
    shuffles = [line for line in plan(trends.monthly(fact)).splitlines() if "Exchange hashpartitioning(month" in line]
    # The first (lowest) spreads the values of a month, the second meets one row per month and task.
    assert len(shuffles) == 2 and "_value" in shuffles[1] and "_value" not in shuffles[0]


def test_a_hot_value_shrinks_before_the_shuffle(spark):
    rows_ = spark.range(0, 9000, 1, 3).select(
        F.lit("Loyalty").alias("customer_type"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("t"),
    )
    counted = op.distinct_by_type(rows_, [], {"ts": "t"})
    assert rows(counted) == [("Loyalty", 6001), ("Overall", 6001)]


def test_cached_releases_the_same_table(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    with storage.cached(df) as kept:
        assert kept.count() == 10
        assert kept.storageLevel.useMemory
    assert not df.storageLevel.useMemory


def test_shared_folder_comes_from_the_session(spark):
    assert storage.new_folder(spark, "x").startswith(storage.shared_folder(spark) + "/x-")
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert not named or storage.shared_folder(spark) == named.rstrip("/")
    assert storage.new_folder(spark, "x") != storage.new_folder(spark, "x")


def test_written_table_keeps_schema_and_prunes_columns(spark):
    fact = prepare.clean(star.fact(spark, SF_DIR))
    kept = storage.written(fact, storage.new_folder(spark, "fact"))
    assert kept.dtypes == fact.dtypes
    assert rows(kept) == rows(fact)
    assert "ReadSchema: struct<sales:decimal(28,6)>" in plan(kept.select("sales"))


def test_large_lookups_shuffle_only_the_columns_asked_for(spark):
    fact = spark.createDataFrame(
        [("1", "100", "7", "t1"), ("2", None, "8", "t2"), (None, "100", "9", "t3")],
        "store_location_key string, product_key string, collector_key string, trans_key string",
    )
    location = spark.createDataFrame([("1", "ON", "501")], "store_location_key string, province string, store_num string")
    product = spark.createDataFrame([("100", "c", "d")], "product_key string, category string, department string")
    wide = prepare.enrich(fact, location, product, broadcast_limit=0).select("trans_key", "province", "category")
    assert rows(wide) == [("t1", "ON", "c"), ("t2", None, None), ("t3", None, "c")]
    text = wide._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    exchanged = [part for part in text.split("\n\n") if ") Exchange" in part and "trans_key" in part]
    assert exchanged
    assert not any("collector_key" in part for part in exchanged)
