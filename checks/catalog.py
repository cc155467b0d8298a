"""Every operator and report as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import star
from tillroll import functions as fn, operators as op, sources, storage
from tillroll.job import publish_all
from tillroll.plans import prepare, reports, rollups, trends
from tillroll.schema import FACT, HEADER_ALIASES, LOCATION
from tillroll.sinks import write_files

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.clean(star.fact(spark, sf_dir))


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.prepare_wide(*star.load(spark, sf_dir))


def _stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.store_sales(_clean(spark, sf_dir), star.location(spark, sf_dir))


def _categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.category_sales(_clean(spark, sf_dir), star.product(spark, sf_dir))


def _months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.monthly_long(trends.monthly(_clean(spark, sf_dir)))


def _double(df: DataFrame, *names: str) -> DataFrame:
    """Exact decimals as doubles, the edge type of every result."""
    return df.withColumns({name: fn.exact(F.col(name)) for name in names})


# --- files ------------------------------------------------------------------------------------


def _lines(df: DataFrame) -> DataFrame:
    """Rows as comma separated text without a header; nulls are empty."""
    fields = [F.coalesce(F.col(name), F.lit("")) for name in df.columns]
    return df.select(F.concat_ws(",", *fields).alias("value"))


def _deliver(spark: SparkSession, sf_dir: str) -> str:
    """Write the three tables as text files below one folder."""
    root = storage.new_folder(spark, "delivery")
    fact, location, product = star.load(spark, sf_dir)
    for name, df in (("trans_fact", fact), ("location", location), ("product", product)):
        _lines(df).write.text(f"{root}/{name}")
    return root


@query
def csv_scan(spark, sf_dir):
    path = storage.new_folder(spark, "csv")
    star.fact(spark, sf_dir).write.option("header", True).csv(path)
    return sources.read_csv(spark, path).select(*FACT.names)


@query
def text_split_scan(spark, sf_dir):
    path = storage.new_folder(spark, "text")
    _lines(star.fact(spark, sf_dir)).write.text(path)
    fields = sources.split_lines(spark, path)
    return fields.select(
        *(F.nullif(F.get("fields", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(FACT.names))
    )


@query
def source_has_rows(spark, sf_dir):
    fact = star.fact(spark, sf_dir)
    full, none = storage.new_folder(spark, "full"), storage.new_folder(spark, "none")
    _lines(fact).write.text(full)
    _lines(fact.filter(F.col("trans_key").isNull())).write.text(none)
    answers = [
        (name, sources.has_rows(spark, path))
        for name, path in (("full", full), ("none", none), ("missing", f"{none}/missing"))
    ]
    return spark.createDataFrame(answers, "source string, has_rows boolean")


@query
def file_discovery(spark, sf_dir):
    files = sources.discover(spark, _deliver(spark, sf_dir))
    return files.groupBy(F.substring_index("name", "/", 1).alias("folder")).agg(
        F.sum("bytes").alias("bytes")
    )


@query
def file_routing(spark, sf_dir):
    root = _deliver(spark, sf_dir)
    routed = sources.route(sources.discover(spark, root)).select("path", "role")
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .text(root)
        .groupBy(F.col("_metadata.file_path").alias("path"))
        .agg(F.count(F.lit(1)).alias("lines"))
    )
    # Both listings spell a local path their own way: one slash or three after the scheme.
    plain = F.regexp_replace("path", "^file:/+", "/")
    return (
        routed.withColumn("path", plain)
        .join(lines.withColumn("path", plain), "path")
        .groupBy("role")
        .agg(F.sum("lines").alias("lines"))
    )


@query
def conform_union(spark, sf_dir):
    root = storage.new_folder(spark, "variants")
    fact = star.fact(spark, sf_dir)
    # Half of the rows go to files with another column order and another name for the key.
    in_variant = F.xxhash64("trans_key") % 2 == 0
    other = ["collector_key", "trans_dt", "store_location_key", "product_key", "sales", "units"]
    variant = fact.filter(in_variant).select(*other, F.col("trans_key").alias("trans_id"))
    fact.filter(~in_variant).write.option("header", True).csv(f"{root}/trans_fact_1")
    variant.write.option("header", True).csv(f"{root}/trans_fact_2")
    paths = [row.path for row in sources.discover(spark, root).select("path").toLocalIterator()]
    return sources.conform(spark, paths)


@query
def empty_relation(spark, sf_dir):
    return sources.empty(spark, FACT).unionByName(star.fact(spark, sf_dir))


@query
def cached_reuse(spark, sf_dir):
    storage.shared_folder(spark)
    with storage.cached(_clean(spark, sf_dir)) as fact:
        rows = fact.count()
        totals = op.sum_by(fact, ["customer_type"], total="sales")
        kept = totals.withColumn("rows", F.lit(rows)).checkpoint()
    return _double(kept, "total")


@query
def publish_reports(spark, sf_dir):
    folder = storage.new_folder(spark, "published")
    names = publish_all(*star.load(spark, sf_dir), partial(write_files, folder=folder))
    counts = [
        spark.read.parquet(f"{folder}/{name}").agg(
            F.lit(name).alias("report"), F.count(F.lit(1)).alias("rows")
        )
        for name in names
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


# --- projections, filters, casts --------------------------------------------------------------


@query
def project_columns(spark, sf_dir):
    fact = star.fact(spark, sf_dir)
    return fact.select("trans_key", "product_key", F.concat("trans_key", F.lit("/"), "product_key").alias("line"))


@query
def rename_columns(spark, sf_dir):
    fact = star.fact(spark, sf_dir).withColumnRenamed("trans_key", "trans_id")
    return fact.withColumnsRenamed(HEADER_ALIASES)


@query
def customer_type(spark, sf_dir):
    return _clean(spark, sf_dir).select("trans_key", "collector_key", "customer_type")


@query
def filter_eq(spark, sf_dir):
    fact = _clean(spark, sf_dir).filter(F.col("customer_type") == "NonLoyalty")
    return fact.select("customer_type", "trans_key", "collector_key")


@query
def filter_contains(spark, sf_dir):
    fact = star.fact(spark, sf_dir)
    return fact.filter(F.col("trans_dt").contains("/")).select("trans_key", "trans_dt")


@query
def null_fill(spark, sf_dir):
    filled = [fn.measure(F.col(name)).alias(name) for name in ("units", "sales")]
    return _double(star.fact(spark, sf_dir).select("trans_key", *filled), "units", "sales")


@query
def typed_cast(spark, sf_dir):
    fact = _clean(spark, sf_dir).select(
        "trans_key", "sales", "units", F.col("trans_dt").try_cast("double").alias("digits_only")
    )
    return _double(fact, "sales", "units")


@query
def count_not_null(spark, sf_dir):
    rows = prepare.enrich(*star.load(spark, sf_dir)).withColumn(
        "sales_number", F.col("sales").try_cast("double")
    )
    names = [*FACT.names, "province", "store_num", "category", "department"]
    return rows.agg(*map(fn.count_not_null, names), fn.count_not_null("sales_number", nan_as_null=True))


@query
def quality(spark, sf_dir):
    return prepare.quality(prepare.enrich(*star.load(spark, sf_dir)))


# --- joins ------------------------------------------------------------------------------------


@query
def join_left_location(spark, sf_dir):
    key = "store_location_key"
    location = star.location(spark, sf_dir)
    joined = op.lookup(star.fact(spark, sf_dir), location, key, op.profile({key: location})[key])
    return joined.select(key, "trans_key", "province", "store_num")


@query
def join_left_product(spark, sf_dir):
    key = "product_key"
    product = star.product(spark, sf_dir)
    joined = op.lookup(star.fact(spark, sf_dir), product, key, op.profile({key: product})[key])
    return joined.select(key, "trans_key", "category", "department")


@query
def join_large_dimension(spark, sf_dir):
    """The lookup as it runs if no dimension may be broadcast: most stores are hot, most products not."""
    rows = prepare.enrich(*star.load(spark, sf_dir), broadcast_limit=0, hot_share=0.001)
    return rows.select("trans_key", "province", "store_num", "category", "department")


@query
def enrich_fact(spark, sf_dir):
    return prepare.enrich(*star.load(spark, sf_dir))


@query
def prepare_wide(spark, sf_dir):
    return _double(_wide(spark, sf_dir), "sales", "units")


@query
def join_inner_aggregates(spark, sf_dir):
    stores = op.sum_by(_stores(spark, sf_dir), ["province", "store_num"], total="sales")
    largest = stores.groupBy("province").agg(F.max("total").alias("largest"))
    return _double(stores.join(largest, "province"), "total", "largest")


# --- aggregations -----------------------------------------------------------------------------


@query
def sum_by_one(spark, sf_dir):
    return _double(op.sum_by(_stores(spark, sf_dir), ["province"], total="sales"), "total")


@query
def sum_by_two(spark, sf_dir):
    return _double(op.sum_by(_categories(spark, sf_dir), ["department", "category"], total="sales"), "total")


@query
def sum_by_three(spark, sf_dir):
    keys = ["customer_type", "province", "store_num"]
    return _double(op.sum_by(_stores(spark, sf_dir), keys, total="sales"), "total")


@query
def sum_global(spark, sf_dir):
    return _double(op.sum_by(_clean(spark, sf_dir), [], sales="sales", units="units"), "sales", "units")


@query
def sum_filtered(spark, sf_dir):
    fact = _clean(spark, sf_dir).filter(F.col("customer_type") == "Loyalty")
    return _double(op.sum_by(fact, ["customer_type"], total="units"), "total")


@query
def avg_of_sums(spark, sf_dir):
    stores = op.sum_by(_stores(spark, sf_dir), ["province", "store_num"], total="sales")
    mean = fn.exact(F.sum("total")) / F.count("total")
    return stores.groupBy("province").agg(mean.alias("average"))


@query
def count_distinct_global(spark, sf_dir):
    return op.count_distinct(star.fact(spark, sf_dir), "collector_key")


@query
def count_distinct_grouped(spark, sf_dir):
    return op.count_distinct(_clean(spark, sf_dir), "trans_key", ["customer_type", "trans_dt"])


@query
def count_nonnull_grouped(spark, sf_dir):
    counts = _clean(spark, sf_dir).groupBy("customer_type")
    return counts.agg(F.count("collector_key").alias("collectors"), F.count("trans_key").alias("lines"))


@query
def pivot_customer_type(spark, sf_dir):
    return _double(op.pivot_types(_stores(spark, sf_dir), "sales", ["province"]), "Loyalty", "NonLoyalty")


@query
def collect_first(spark, sf_dir):
    # All values of a group are equal, so the first needs no collected list.
    fact = _clean(spark, sf_dir).groupBy("customer_type", "trans_dt", "trans_key")
    return fact.agg(F.min("trans_key").alias("first_key"))


@query
def with_overall(spark, sf_dir):
    return _double(op.with_overall(_stores(spark, sf_dir), ["province"], total="sales"), "total")


# --- ranks, sorts, top-k ----------------------------------------------------------------------


def _ranked(totals: DataFrame, partition: list[str]) -> DataFrame:
    every = op.ranked(totals, "total", partition)
    return _double(every, "total").withColumn("rank", F.col("rank").cast("long"))


@query
def rank_partitioned(spark, sf_dir):
    totals = op.sum_by(_stores(spark, sf_dir), ["customer_type", "store_num"], total="sales")
    return _ranked(totals, ["customer_type"])


@query
def rank_two_keys(spark, sf_dir):
    keys = ["customer_type", "province"]
    return _ranked(op.sum_by(_stores(spark, sf_dir), [*keys, "store_num"], total="sales"), keys)


@query
def rank_global(spark, sf_dir):
    return _ranked(op.sum_by(_stores(spark, sf_dir), ["store_num"], total="sales"), [])


@query
def sort_desc(spark, sf_dir):
    totals = op.sum_by(_stores(spark, sf_dir), ["customer_type", "province"], total="sales")
    return _double(op.positioned(totals, [F.desc("customer_type"), F.desc("total")]), "total")


@query
def sort_asc(spark, sf_dir):
    placed = op.positioned(trends.monthly(_clean(spark, sf_dir)), [F.asc("customer_type"), F.asc("month")])
    return placed.select(
        "customer_type", fn.date_label(F.col("month")).alias("trans_dt"), F.col("sales").alias("total"), "position"
    )


@query
def topk_per_group(spark, sf_dir):
    totals = op.sum_by(_categories(spark, sf_dir), ["department", "category"], total="sales")
    return _double(op.top_n(totals, "total", 2, ["department"], ["category"]), "total")


@query
def topk_global(spark, sf_dir):
    totals = op.sum_by(_categories(spark, sf_dir), ["department", "category"], total="sales")
    return _double(op.top_n(totals, "total", 7), "total")


# --- set operations ---------------------------------------------------------------------------


@query
def union_all(spark, sf_dir):
    location = star.location(spark, sf_dir)
    swapped = location.select(*reversed(LOCATION.names))
    return location.unionByName(swapped)


@query
def distinct_rows(spark, sf_dir):
    return _clean(spark, sf_dir).select("customer_type", "collector_key").distinct()


# --- scalar functions -------------------------------------------------------------------------


@query
def split_date(spark, sf_dir):
    pieces = F.split("trans_dt", "/")
    return star.fact(spark, sf_dir).select(
        "trans_key",
        F.get(pieces, F.lit(0)).alias("month"),
        F.get(pieces, F.lit(2)).alias("year"),
    )


@query
def lpad_month(spark, sf_dir):
    dated = star.fact(spark, sf_dir).filter(F.col("trans_dt").contains("/"))
    month = F.substring_index("trans_dt", "/", 1)
    return dated.select("trans_key", fn.padded_month(month).alias("month"))


@query
def month_key(spark, sf_dir):
    pieces = F.split("trans_dt", "/")
    month, year = F.get(pieces, F.lit(0)), F.get(pieces, F.lit(2))
    label = F.concat(fn.padded_month(month), F.lit("-01-"), year)
    return star.fact(spark, sf_dir).select("trans_key", label.alias("month_key"))


@query
def month_normalize(spark, sf_dir):
    label = fn.date_label(fn.month_start(F.col("trans_dt")))
    return star.fact(spark, sf_dir).select("trans_key", "trans_dt", label.alias("month"))


@query
def round_total(spark, sf_dir):
    totals = op.sum_by(_stores(spark, sf_dir), ["store_num"], total="sales")
    return totals.select("store_num", fn.whole(F.col("total")).alias("total"))


def _pivoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.pivot_types(_stores(spark, sf_dir), "sales", ["province", "store_num"])


@query
def percent_ratio(spark, sf_dir):
    ratio = fn.percent(F.col("Loyalty"), F.col("NonLoyalty"))
    return _pivoted(spark, sf_dir).select("store_num", ratio.alias("percent"))


@query
def percent_label(spark, sf_dir):
    label = fn.percent_label(F.col("Loyalty"), F.col("NonLoyalty"))
    return _pivoted(spark, sf_dir).select("store_num", label.alias("performance"))


# --- reports ----------------------------------------------------------------------------------


@query
def top_provinces(spark, sf_dir):
    return reports.top_provinces(_stores(spark, sf_dir))


@query
def top_stores(spark, sf_dir):
    return reports.top_stores(_stores(spark, sf_dir))


@query
def top_to_average_overall(spark, sf_dir):
    return reports.top_to_average_overall(_stores(spark, sf_dir))


@query
def loyalty_vs_nonloyalty(spark, sf_dir):
    return reports.loyalty_vs_nonloyalty(_clean(spark, sf_dir))


@query
def top10_categories(spark, sf_dir):
    return reports.top10_categories(_categories(spark, sf_dir))


@query
def top5_stores_by_province(spark, sf_dir):
    return reports.top5_stores_by_province(_stores(spark, sf_dir))


@query
def top10_cat_by_dept(spark, sf_dir):
    return reports.top10_cat_by_dept(_categories(spark, sf_dir))


@query
def top_stores_provinces(spark, sf_dir):
    return reports.top_stores_provinces(_stores(spark, sf_dir))


@query
def totals_wide(spark, sf_dir):
    return reports.totals_wide(_clean(spark, sf_dir))


@query
def totals_long(spark, sf_dir):
    return reports.totals(_clean(spark, sf_dir))


@query
def trends_wide(spark, sf_dir):
    return trends.trends_wide(_clean(spark, sf_dir))


@query
def trends_long(spark, sf_dir):
    return trends.trends(_clean(spark, sf_dir))


@query
def trends_yoy(spark, sf_dir):
    return trends.labelled(trends.year_over_year(_months(spark, sf_dir)))


@query
def trends_mom(spark, sf_dir):
    return trends.labelled(trends.month_over_month(_months(spark, sf_dir)))


@query
def trends_last12(spark, sf_dir):
    return trends.labelled(trends.last_months(_months(spark, sf_dir)))


@query
def trends_trailing12(spark, sf_dir):
    return trends.labelled(trends.trailing(_clean(spark, sf_dir)))
