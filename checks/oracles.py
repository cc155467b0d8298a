"""The same queries as SQL over the test tables."""

from __future__ import annotations

# The delivered files, their typed form and the wide table.
BASE = """
fact AS (
  SELECT CASE WHEN l_orderkey = 0 THEN CAST(l_linenumber AS VARCHAR)
              WHEN l_orderkey % 17 = 0 THEN 'unknown-' || CAST(l_suppkey AS VARCHAR)
              ELSE CAST(l_suppkey AS VARCHAR) END AS store_location_key,
         CASE WHEN l_orderkey % 13 = 0 THEN 'unknown-' || CAST(l_partkey AS VARCHAR)
              ELSE CAST(l_partkey AS VARCHAR) END AS product_key,
         CASE WHEN l_orderkey % 103 = 0 THEN '0'
              WHEN l_orderkey % 97 = 0 THEN NULL
              WHEN c_acctbal < 0 OR (l_orderkey + l_linenumber) % 11 = 0
              THEN CAST(-(c_custkey + 1) AS VARCHAR)
              ELSE CAST(c_custkey + 1 AS VARCHAR) END AS collector_key,
         CASE WHEN l_orderkey % 101 = 0 THEN strftime(o_orderdate, '%Y%m%d')
              WHEN l_orderkey % 2 = 0 THEN strftime(o_orderdate, '%-m/%-d/%Y')
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS trans_dt,
         CASE WHEN l_orderkey = 0 THEN '99000000.00'
              WHEN l_suppkey BETWEEN 1 AND 7 THEN '0.00'
              WHEN (l_orderkey + l_linenumber) % 100 IN (0, 50) THEN NULL
              WHEN (l_orderkey + l_linenumber) % 100 = 33 THEN 'n/a'
              WHEN (l_orderkey + l_linenumber) % 100 = 41 THEN 'NaN'
              WHEN (l_orderkey + l_linenumber) % 100 = 58
              THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) || '12345678'
              WHEN (l_orderkey + l_linenumber) % 100 = 77
              THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) || '000000001'
              WHEN l_orderkey % 221 = 0 THEN '20000000000.25'
              ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS sales,
         CASE WHEN (l_orderkey + l_linenumber) % 70 = 0 THEN NULL
              WHEN (l_orderkey + l_linenumber) % 70 = 29 THEN 'one'
              WHEN (l_orderkey + l_linenumber) % 70 = 43
              THEN CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) || '00005'
              ELSE CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) END AS units,
         CAST(l_orderkey AS VARCHAR) AS trans_key
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey),
location AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS store_location_key, r_name AS province,
         CAST(s_suppkey AS VARCHAR) AS store_num
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
product AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_key, p_brand AS category, p_type AS department
  FROM part),
enriched AS (
  SELECT f.*, province, store_num, category, department
  FROM fact f
  LEFT JOIN location l ON f.store_location_key = l.store_location_key
  LEFT JOIN product p ON f.product_key = p.product_key),
wide AS (
  SELECT * REPLACE (coalesce(TRY_CAST(sales AS DECIMAL(28,6)), 0) AS sales,
                    coalesce(TRY_CAST(units AS DECIMAL(28,6)), 0) AS units),
         CASE WHEN TRY_CAST(collector_key AS DOUBLE) < 0 THEN 'NonLoyalty' ELSE 'Loyalty' END
           AS customer_type,
         CASE WHEN regexp_full_match(trans_dt, '[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}')
              THEN make_date(CAST(split_part(trans_dt, '/', 3) AS INT), CAST(split_part(trans_dt, '/', 1) AS INT), 1)
              WHEN regexp_full_match(trans_dt, '[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}')
              THEN make_date(CAST(split_part(trans_dt, '-', 1) AS INT), CAST(split_part(trans_dt, '-', 2) AS INT), 1)
         END AS month
  FROM enriched),
both_types AS (
  SELECT * FROM wide UNION ALL SELECT * REPLACE ('Overall' AS customer_type) FROM wide),
store_totals AS (
  SELECT province, store_num, sum(sales) AS total FROM wide GROUP BY ALL),
category_totals AS (
  SELECT department, category, sum(sales) AS total FROM wide GROUP BY ALL),
monthly AS (
  SELECT customer_type, month, CAST(sum(sales) AS DOUBLE) AS sales, CAST(sum(units) AS DOUBLE) AS units,
         count(DISTINCT trans_key) AS transactions, count(DISTINCT collector_key) AS collectors
  FROM both_types WHERE month IS NOT NULL GROUP BY ALL),
monthly_long AS (
  SELECT customer_type, month, sales AS total, 'total sales' AS measure FROM monthly
  UNION ALL SELECT customer_type, month, units, 'total units' FROM monthly
  UNION ALL SELECT customer_type, month, transactions, 'total distinct transactions' FROM monthly
  UNION ALL SELECT customer_type, month, collectors, 'total distinct collectors' FROM monthly)
"""

LABEL = "strftime(month, '%m-%d-%Y') AS trans_dt"


def inexact(name: str) -> str:
    """True for a text that typing changes: no number, or digits after the sixth decimal."""
    return f"""{name} IS NOT NULL AND (TRY_CAST({name} AS DECIMAL(28,6)) IS NULL
          OR regexp_matches({name}, '\\.[0-9]{{6}}[0-9]*[1-9]'))"""


def rounded_once(sql: str) -> str:
    """Every cast to a double goes by way of text: from a wide decimal it may be off by one place."""
    start = "CAST("
    out, at = "", 0
    while (found := sql.find(start, at)) >= 0:
        depth, end = 1, found + len(start)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        inner = sql[found + len(start) : end - 1]
        if inner.endswith(" AS DOUBLE") and not sql[:found].endswith("TRY_"):
            out += sql[at:found] + f"CAST(CAST({rounded_once(inner.removesuffix(' AS DOUBLE'))} AS VARCHAR) AS DOUBLE)"
            at = end
        else:
            out += sql[at : found + len(start)]
            at = found + len(start)
    return out + sql[at:]


def top_by_type(key: str) -> str:
    return f"""
SELECT customer_type, {key}, CAST(total AS DOUBLE) AS total FROM (
  SELECT *, rank() OVER (PARTITION BY customer_type ORDER BY total DESC NULLS LAST) AS r FROM (
    SELECT customer_type, {key}, sum(sales) AS total FROM both_types GROUP BY ALL))
WHERE r <= 3"""


def compared(months: int, name: str) -> str:
    return f"""
SELECT a.customer_type, strftime(a.month, '%m-%d-%Y') AS trans_dt, a.total, a.measure,
       b.total AS {name}, a.total - b.total AS delta,
       (a.total - b.total) * 100 / nullif(b.total, 0) AS percent
FROM monthly_long a LEFT JOIN monthly_long b
  ON a.customer_type = b.customer_type AND a.measure = b.measure
 AND b.month = a.month - INTERVAL {months} MONTH"""


BODIES = {
    # files
    "csv_scan": "SELECT * FROM fact",
    "text_split_scan": "SELECT * FROM fact",
    "source_has_rows": """
SELECT 'full' AS source, count(*) > 0 AS has_rows FROM fact
UNION ALL SELECT 'none', count(*) > 0 FROM fact WHERE trans_key IS NULL
UNION ALL SELECT 'missing', false""",
    "file_discovery": """
SELECT folder, CAST(sum(strlen(line) + 1) AS BIGINT) AS bytes FROM (
  SELECT 'trans_fact' AS folder, concat(store_location_key, ',', product_key, ',',
         coalesce(collector_key, ''), ',', trans_dt, ',', coalesce(sales, ''), ',',
         coalesce(units, ''), ',', trans_key) AS line FROM fact
  UNION ALL SELECT 'location', concat(store_location_key, ',', province, ',', store_num) FROM location
  UNION ALL SELECT 'product', concat(product_key, ',', category, ',', department) FROM product)
GROUP BY folder""",
    "file_routing": """
SELECT 'fact' AS role, count(*) AS lines FROM fact
UNION ALL SELECT 'location', count(*) FROM location
UNION ALL SELECT 'product', count(*) FROM product""",
    "conform_union": "SELECT * FROM fact",
    "empty_relation": "SELECT * FROM fact",
    "cached_reuse": """
SELECT customer_type, CAST(sum(sales) AS DOUBLE) AS total, (SELECT count(*) FROM wide) AS rows
FROM wide GROUP BY customer_type""",
    # projections, filters, casts
    "project_columns": "SELECT trans_key, product_key, trans_key || '/' || product_key AS line FROM fact",
    "rename_columns": "SELECT * FROM fact",
    "customer_type": "SELECT trans_key, collector_key, customer_type FROM wide",
    "filter_eq": """
SELECT customer_type, trans_key, collector_key FROM wide WHERE customer_type = 'NonLoyalty'""",
    "filter_contains": "SELECT trans_key, trans_dt FROM fact WHERE contains(trans_dt, '/')",
    "null_fill": """
SELECT trans_key, CAST(coalesce(TRY_CAST(units AS DECIMAL(28,6)), 0) AS DOUBLE) AS units,
       CAST(coalesce(TRY_CAST(sales AS DECIMAL(28,6)), 0) AS DOUBLE) AS sales FROM fact""",
    "typed_cast": """
SELECT trans_key, CAST(sales AS DOUBLE) AS sales, CAST(units AS DOUBLE) AS units,
       TRY_CAST(trans_dt AS DOUBLE) AS digits_only FROM wide""",
    "count_not_null": """
SELECT count(store_location_key) AS store_location_key, count(product_key) AS product_key,
       count(collector_key) AS collector_key, count(trans_dt) AS trans_dt, count(sales) AS sales,
       count(units) AS units, count(trans_key) AS trans_key, count(province) AS province,
       count(store_num) AS store_num, count(category) AS category, count(department) AS department,
       count(TRY_CAST(sales AS DOUBLE)) FILTER (NOT isnan(TRY_CAST(sales AS DOUBLE))) AS sales_number
FROM enriched""",
    "quality": f"""
SELECT count(*) AS rows, count(*) - count(month) AS without_month,
       count(*) - count(province) AS without_province, count(*) - count(category) AS without_category,
       count(*) - count(collector_key) AS without_collector,
       (SELECT count(*) FROM fact WHERE sales IS NULL) AS without_sales,
       (SELECT count(*) FROM fact WHERE units IS NULL) AS without_units,
       (SELECT count(*) FROM fact WHERE {inexact('sales')}) AS inexact_sales,
       (SELECT count(*) FROM fact WHERE {inexact('units')}) AS inexact_units
FROM wide""",
    # joins
    "join_left_location": "SELECT store_location_key, trans_key, province, store_num FROM enriched",
    "join_left_product": "SELECT product_key, trans_key, category, department FROM enriched",
    "join_large_dimension": "SELECT trans_key, province, store_num, category, department FROM enriched",
    "enrich_fact": "SELECT * FROM enriched",
    "prepare_wide": """
SELECT customer_type, collector_key, trans_key, trans_dt, CAST(sales AS DOUBLE) AS sales,
       CAST(units AS DOUBLE) AS units, province, store_num, category, department FROM wide""",
    "join_inner_aggregates": """
SELECT s.province, store_num, CAST(total AS DOUBLE) AS total, CAST(largest AS DOUBLE) AS largest
FROM store_totals s JOIN (SELECT province, max(total) AS largest FROM store_totals GROUP BY province) m
  ON s.province = m.province""",
    # aggregations
    "sum_by_one": "SELECT province, CAST(sum(sales) AS DOUBLE) AS total FROM wide GROUP BY province",
    "sum_by_two": """
SELECT department, category, CAST(sum(sales) AS DOUBLE) AS total FROM wide GROUP BY department, category""",
    "sum_by_three": """
SELECT customer_type, province, store_num, CAST(sum(sales) AS DOUBLE) AS total
FROM wide GROUP BY customer_type, province, store_num""",
    "sum_global": "SELECT CAST(sum(sales) AS DOUBLE) AS sales, CAST(sum(units) AS DOUBLE) AS units FROM wide",
    "sum_filtered": """
SELECT customer_type, CAST(sum(units) AS DOUBLE) AS total FROM wide
WHERE customer_type = 'Loyalty' GROUP BY customer_type""",
    "avg_of_sums": """
SELECT province, CAST(sum(total) AS DOUBLE) / count(*) AS average FROM store_totals GROUP BY province""",
    "count_distinct_global": "SELECT count(DISTINCT collector_key) AS total FROM fact",
    "count_distinct_grouped": """
SELECT customer_type, trans_dt, count(DISTINCT trans_key) AS total FROM wide GROUP BY customer_type, trans_dt""",
    "count_nonnull_grouped": """
SELECT customer_type, count(collector_key) AS collectors, count(trans_key) AS lines
FROM wide GROUP BY customer_type""",
    "pivot_customer_type": """
SELECT province, CAST(sum(sales) FILTER (customer_type = 'Loyalty') AS DOUBLE) AS Loyalty,
       CAST(sum(sales) FILTER (customer_type = 'NonLoyalty') AS DOUBLE) AS NonLoyalty
FROM wide GROUP BY province""",
    "collect_first": """
SELECT customer_type, trans_dt, trans_key, list(trans_key)[1] AS first_key
FROM wide GROUP BY customer_type, trans_dt, trans_key""",
    "with_overall": """
SELECT CASE WHEN grouping(customer_type) = 1 THEN 'Overall' ELSE customer_type END AS customer_type,
       province, CAST(sum(sales) AS DOUBLE) AS total
FROM wide GROUP BY GROUPING SETS ((wide.customer_type, province), (province))""",
    # ranks, sorts, top-k
    "rank_partitioned": """
SELECT customer_type, store_num, CAST(total AS DOUBLE) AS total, rank FROM (
  SELECT *, rank() OVER (PARTITION BY customer_type ORDER BY total DESC NULLS LAST) AS rank FROM (
    SELECT customer_type, store_num, sum(sales) AS total FROM wide GROUP BY ALL))""",
    "rank_two_keys": """
SELECT customer_type, province, store_num, CAST(total AS DOUBLE) AS total, rank FROM (
  SELECT *, rank() OVER (PARTITION BY customer_type, province ORDER BY total DESC NULLS LAST) AS rank FROM (
    SELECT customer_type, province, store_num, sum(sales) AS total FROM wide GROUP BY ALL))""",
    "rank_global": """
SELECT store_num, CAST(total AS DOUBLE) AS total, rank FROM (
  SELECT *, rank() OVER (ORDER BY total DESC NULLS LAST) AS rank FROM (
    SELECT store_num, sum(sales) AS total FROM wide GROUP BY ALL))""",
    "sort_desc": """
SELECT customer_type, province, CAST(total AS DOUBLE) AS total,
       row_number() OVER (ORDER BY customer_type DESC, total DESC, province NULLS FIRST) AS position
FROM (SELECT customer_type, province, sum(sales) AS total FROM wide GROUP BY customer_type, province)""",
    "sort_asc": f"""
SELECT customer_type, {LABEL}, sales AS total, row_number() OVER (ORDER BY customer_type, month) AS position
FROM monthly""",
    "topk_per_group": """
SELECT department, category, CAST(total AS DOUBLE) AS total FROM (
  SELECT *, rank() OVER (PARTITION BY department ORDER BY total DESC NULLS LAST) AS r
  FROM category_totals WHERE category IS NOT NULL)
WHERE r <= 2""",
    "topk_global": """
SELECT department, category, CAST(total AS DOUBLE) AS total FROM (
  SELECT *, rank() OVER (ORDER BY total DESC NULLS LAST) AS r FROM category_totals)
WHERE r <= 7""",
    # set operations
    "union_all": "SELECT * FROM location UNION ALL SELECT * FROM location",
    "distinct_rows": "SELECT DISTINCT customer_type, collector_key FROM wide",
    # scalar functions
    "split_date": """
SELECT trans_key, split_part(trans_dt, '/', 1) AS month,
       CASE WHEN contains(trans_dt, '/') THEN split_part(trans_dt, '/', 3) END AS year FROM fact""",
    "lpad_month": """
SELECT trans_key, lpad(split_part(trans_dt, '/', 1), 2, '0') AS month FROM fact WHERE contains(trans_dt, '/')""",
    "month_key": """
SELECT trans_key, CASE WHEN contains(trans_dt, '/')
  THEN lpad(split_part(trans_dt, '/', 1), 2, '0') || '-01-' || split_part(trans_dt, '/', 3) END AS month_key
FROM fact""",
    "month_normalize": "SELECT trans_key, trans_dt, strftime(month, '%m-%d-%Y') AS month FROM wide",
    "round_total": "SELECT store_num, CAST(round(sum(sales)) AS DOUBLE) AS total FROM wide GROUP BY store_num",
    "percent_ratio": """
SELECT store_num, CAST(sum(sales) FILTER (customer_type = 'Loyalty') AS DOUBLE) * 100
       / nullif(CAST(sum(sales) FILTER (customer_type = 'NonLoyalty') AS DOUBLE), 0) AS percent
FROM wide GROUP BY province, store_num""",
    "percent_label": """
SELECT store_num, CAST(round(CAST(sum(sales) FILTER (customer_type = 'Loyalty') AS DOUBLE) * 100
       / nullif(CAST(sum(sales) FILTER (customer_type = 'NonLoyalty') AS DOUBLE), 0)) AS VARCHAR) || '%'
       AS performance
FROM wide GROUP BY province, store_num""",
    # reports
    "top_provinces": top_by_type("province"),
    "top_stores": top_by_type("store_num"),
    "top_to_average_overall": """
SELECT province, store_num, CAST(total AS DOUBLE) AS total, average,
       CAST(round(CAST(total AS DOUBLE) * 100 / average) AS VARCHAR) || '%' AS performance_to_average
FROM (
  SELECT *, rank() OVER (PARTITION BY province ORDER BY total DESC NULLS LAST) AS r,
         CAST(sum(total) OVER (PARTITION BY province) AS DOUBLE)
           / count(*) OVER (PARTITION BY province) AS average
  FROM store_totals WHERE province IS NOT NULL)
WHERE r = 1""",
    "loyalty_vs_nonloyalty": """
SELECT *, CAST(round(Loyalty * 100 / nullif(NonLoyalty, 0)) AS VARCHAR) || '%' AS performance FROM (
  SELECT CAST(sum(sales) FILTER (customer_type = 'Loyalty') AS DOUBLE) AS Loyalty,
         CAST(sum(sales) FILTER (customer_type = 'NonLoyalty') AS DOUBLE) AS NonLoyalty FROM wide)""",
    "top10_categories": """
SELECT category, CAST(total AS DOUBLE) AS total FROM (
  SELECT *, rank() OVER (ORDER BY total DESC NULLS LAST) AS r FROM (
    SELECT category, sum(sales) AS total FROM wide GROUP BY category))
WHERE r <= 10""",
    "top5_stores_by_province": """
SELECT province, store_num, CAST(round(total) AS DOUBLE) AS total FROM (
  SELECT *, rank() OVER (PARTITION BY province ORDER BY total DESC NULLS LAST) AS r FROM store_totals)
WHERE r <= 5""",
    "top10_cat_by_dept": """
SELECT department, category, CAST(round(total) AS DOUBLE) AS total FROM (
  SELECT *, rank() OVER (PARTITION BY department ORDER BY total DESC NULLS LAST) AS r FROM category_totals)
WHERE r <= 10""",
    "top_stores_provinces": """
SELECT customer_type, province, store_num, CAST(total AS DOUBLE) AS total FROM (
  SELECT *, rank() OVER (PARTITION BY customer_type, province ORDER BY total DESC NULLS LAST) AS r FROM (
    SELECT customer_type, province, store_num, sum(sales) AS total FROM wide GROUP BY ALL))
WHERE r = 1""",
    "totals_wide": """
SELECT customer_type, CAST(sum(sales) AS DOUBLE) AS sales, CAST(sum(units) AS DOUBLE) AS units,
       count(DISTINCT trans_key) AS transactions, count(DISTINCT collector_key) AS collectors
FROM both_types GROUP BY customer_type""",
    "totals_long": """
SELECT customer_type, CAST(sum(sales) AS DOUBLE) AS total, 'total sales' AS measure
FROM both_types GROUP BY customer_type
UNION ALL SELECT customer_type, CAST(sum(units) AS DOUBLE), 'total units' FROM both_types GROUP BY customer_type
UNION ALL SELECT customer_type, CAST(count(DISTINCT trans_key) AS DOUBLE), 'total distinct transactions'
FROM both_types GROUP BY customer_type
UNION ALL SELECT customer_type, CAST(count(DISTINCT collector_key) AS DOUBLE), 'total distinct collectors'
FROM both_types GROUP BY customer_type""",
    "trends_wide": f"SELECT customer_type, {LABEL}, sales, units, transactions, collectors FROM monthly",
    "trends_long": f"SELECT customer_type, {LABEL}, total, measure FROM monthly_long",
    "trends_yoy": compared(12, "year_before"),
    "trends_mom": compared(1, "month_before"),
    "trends_last12": f"""
SELECT customer_type, {LABEL}, total, measure FROM monthly_long
WHERE month > (SELECT max(month) FROM monthly) - INTERVAL 12 MONTH""",
    "trends_trailing12": """
WITH ends AS (SELECT DISTINCT customer_type, month AS ending FROM monthly),
windowed AS (
  SELECT e.customer_type, e.ending, CAST(sum(sales) AS DOUBLE) AS sales,
         CAST(sum(units) AS DOUBLE) AS units, CAST(count(DISTINCT trans_key) AS DOUBLE) AS transactions,
         CAST(count(DISTINCT collector_key) AS DOUBLE) AS collectors
  FROM ends e JOIN both_types b ON b.customer_type = e.customer_type
   AND b.month <= e.ending AND b.month > e.ending - INTERVAL 12 MONTH
  GROUP BY ALL)
SELECT customer_type, strftime(ending, '%m-%d-%Y') AS trans_dt, total, measure FROM (
  SELECT customer_type, ending, sales AS total, 'total sales' AS measure FROM windowed
  UNION ALL SELECT customer_type, ending, units, 'total units' FROM windowed
  UNION ALL SELECT customer_type, ending, transactions, 'total distinct transactions' FROM windowed
  UNION ALL SELECT customer_type, ending, collectors, 'total distinct collectors' FROM windowed)""",
}

# Published tables and the query that fills each.
PUBLISHED = {
    "top_provinces": "top_provinces",
    "top_stores": "top_stores",
    "top_to_average_overall": "top_to_average_overall",
    "loyalty_vs_nonloyalty": "loyalty_vs_nonloyalty",
    "top10_categories": "top10_categories",
    "top5_stores_by_province": "top5_stores_by_province",
    "top10_cat_by_dept": "top10_cat_by_dept",
    "totals": "totals_long",
    "trends": "trends_long",
    "top_stores_provinces": "top_stores_provinces",
    "trends_yoy": "trends_yoy",
    "trends_mom": "trends_mom",
    "trends_last12": "trends_last12",
    "trends_trailing12": "trends_trailing12",
    "quality": "quality",
}
BODIES["publish_reports"] = "\nUNION ALL ".join(
    f"SELECT '{name}' AS report, count(*) AS rows FROM ({BODIES[body]})"
    for name, body in PUBLISHED.items()
)

ORACLES = {name: rounded_once(f"WITH {BASE}\nSELECT * FROM ({body})") for name, body in BODIES.items()}
