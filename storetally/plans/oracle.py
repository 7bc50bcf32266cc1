"""SQL equivalents of the registered queries."""

from __future__ import annotations

import re

# One sale per line, in cents-exact decimals.
SALES = """
    SELECT l_orderkey AS transaction_id, l_partkey AS sku, l_suppkey AS store_id,
           CAST(l_quantity AS BIGINT) AS quantity,
           CAST(l_extendedprice AS DECIMAL(12,2)) AS amount,
           o_custkey AS customer_id, o_orderdate AS ts, c_mktsegment AS customer_segment,
           p_type AS product_category, r_name AS region, n_name AS state
    FROM lineitem
    LEFT JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN part ON l_partkey = p_partkey
    LEFT JOIN (supplier JOIN nation ON s_nationkey = n_nationkey
               JOIN region ON n_regionkey = r_regionkey) ON l_suppkey = s_suppkey
"""
EVENTS = """
    SELECT user_id AS customer_id, ts, CAST(value AS DECIMAL(12,2)) AS amount FROM events
"""
REVENUE = "CAST(SUM(amount) AS DOUBLE)"
TOTALS = f"{REVENUE} AS total_revenue"
MEAN = f"{REVENUE} / COUNT(amount) AS avg_transaction_value"
CUSTOMERS = "COUNT(DISTINCT customer_id)"


def with_sales(select: str) -> str:
    return f"WITH sales AS ({SALES}) {select}"


def with_events(select: str) -> str:
    return f"WITH sales AS ({EVENTS}) {select}"


BASIC = f"""COUNT(*) AS total_transactions, {TOTALS}, {MEAN},
    {CUSTOMERS} AS unique_customers, COUNT(DISTINCT store_id) AS active_stores"""
RATIOS = f"""{REVENUE} / {CUSTOMERS} AS revenue_per_customer,
    CAST(COUNT(*) AS DOUBLE) / COUNT(DISTINCT store_id) AS transactions_per_store"""
SEGMENT = f"customer_segment, COUNT(*) AS transaction_count, {TOTALS}, {MEAN}, {CUSTOMERS} AS unique_customers"
# Sample deviation of whole numbers with the sums s1 and s2 of first and second powers, rounded only at the end.
DEVIATION = """SQRT((CAST(s2 - 2 * (s1 // n) * s1 + n * (s1 // n) * (s1 // n) AS DOUBLE)
    - CAST(s1 - n * (s1 // n) AS DOUBLE) * CAST(s1 - n * (s1 // n) AS DOUBLE) / n) / CAST(n - 1 AS DOUBLE))"""


def deviation(unit: str, whole: str) -> str:
    """Of amounts that are `whole` numbers in a unit."""
    parts = {"s1": f"CAST(SUM({whole}) AS HUGEINT)", "s2": f"CAST(SUM({whole} * {whole}) AS HUGEINT)", "n": "COUNT(amount)"}
    text = DEVIATION
    for name, value in parts.items():
        text = re.sub(rf"\b{name}\b", value, text)
    return f"{text} / {unit}::DOUBLE AS transaction_stddev"


SEGMENT_SHARE = f"""
    SELECT {SEGMENT}, {deviation('100', 'CAST(amount * 100 AS HUGEINT)')},
           ROUND({REVENUE} / CAST(SUM(SUM(amount)) OVER () AS DOUBLE), 6) AS revenue_share
    FROM sales GROUP BY customer_segment"""
REGION_STAR = f"""
    SELECT region, state, {TOTALS}, {MEAN}, COUNT(*) AS transaction_count,
           COUNT(DISTINCT store_id) AS store_count, {CUSTOMERS} AS customer_count
    FROM sales GROUP BY region, state"""


def windows(start: str, end: str, columns: str, growth: bool = False) -> str:
    """Tumbling windows; growth against the previous non-empty window."""
    lagged = """, CAST(cents - LAG(cents) OVER (ORDER BY window_start) AS DOUBLE) / 100 AS revenue_growth"""
    return f"""
    SELECT window_start, window_end, {columns}{lagged if growth else ''}
    FROM (SELECT {start} AS window_start, {end} AS window_end, {TOTALS}, {MEAN},
                 COUNT(*) AS transaction_count, {CUSTOMERS} AS unique_customers,
                 CAST(SUM(amount) * 100 AS BIGINT) AS cents
          FROM sales GROUP BY 1, 2)"""


# Amounts of any digits: whole cents, and the rest in multiples of 2^-78; text is what DuckDB rounds correctly.
UNEVEN = """
    SELECT *, CASE WHEN even THEN CAST(ROUND(amount * 100) AS HUGEINT) ELSE 0 END AS whole_cents,
           CASE WHEN even THEN 0 ELSE CAST(amount * 302231454903657293676544 AS HUGEINT) END AS rest,
           CASE WHEN even THEN CAST(ROUND(amount * 100) AS HUGEINT) * 10000000
                ELSE CAST(ROUND_EVEN(amount * 1000000000, 0) AS HUGEINT) END AS fine
    FROM (SELECT *, ROUND(amount * 100) / 100 = amount AS even
          FROM (SELECT user_id AS customer_id, ts, value / 7 AS amount, event_type AS customer_segment FROM events))
"""


def uneven(whole_cents: str, rest: str) -> str:
    """Both sums as one DOUBLE."""
    return f"CAST({whole_cents} AS DOUBLE) / 100 + CAST(CAST({rest} AS VARCHAR) AS DOUBLE) / 302231454903657293676544"


UNEVEN_REVENUE = uneven("SUM(whole_cents)", "SUM(rest)")
FLAT_WINDOW = "total_revenue, transaction_count, unique_customers"
STAR_WINDOW = f"{FLAT_WINDOW}, avg_transaction_value"
MONTH = "CAST(DATE_TRUNC('month', ts) AS TIMESTAMP)"
QUARTER = "CAST(DATE_TRUNC('quarter', ts) AS TIMESTAMP)"


def bucket(length: str) -> tuple[str, str]:
    start = f"TIME_BUCKET(INTERVAL '{length}', ts, TIMESTAMP '1970-01-01')"
    return start, f"{start} + INTERVAL '{length}'"


COHORTS = """
    , firsts AS (SELECT customer_id, MIN(ts) AS f FROM sales GROUP BY customer_id),
    dated AS (
        SELECT customer_id, amount, ts AS t, f,
               (YEAR(ts) - YEAR(f)) * 12 + MONTH(ts) - MONTH(f) AS md,
               (DAY(ts) - DAY(f)) * 86400
                 + (HOUR(ts) - HOUR(f)) * 3600 + (MINUTE(ts) - MINUTE(f)) * 60
                 + (CAST(FLOOR(SECOND(ts)) AS BIGINT) - CAST(FLOOR(SECOND(f)) AS BIGINT)) AS sd
        FROM sales JOIN firsts USING (customer_id))
    SELECT CAST(DATE_TRUNC('month', f) AS TIMESTAMP) AS cohort_month,
           CAST(CASE WHEN DAY(t) = DAY(f)
                       OR (CAST(t AS DATE) = LAST_DAY(t) AND CAST(f AS DATE) = LAST_DAY(f)) THEN md
                     WHEN sd < 0 THEN md - 1 ELSE md END AS BIGINT) AS month_number,
           COUNT(DISTINCT customer_id) AS active_customers,
           CAST(SUM(amount) AS DOUBLE) AS total_revenue
    FROM dated GROUP BY 1, 2"""

LINES = """
    SELECT l_orderkey AS transaction_id, CAST(l_linenumber AS BIGINT) AS line_number,
           l_partkey AS sku, l_suppkey AS store_id, CAST(l_quantity AS BIGINT) AS quantity,
           CAST(l_quantity AS DECIMAL(6,0)) AS qty,
           CAST(CAST(p_retailprice AS DECIMAL(12,2))
             * CAST(CASE r_name WHEN 'AMERICA' THEN 1.15 WHEN 'EUROPE' THEN 1.25
                                WHEN 'ASIA' THEN 0.95 ELSE 1 END AS DECIMAL(5,4)) AS DECIMAL(20,6)) AS list_price,
           CAST(1 - CAST(l_discount AS DECIMAL(9,8)) AS DECIMAL(9,8)) AS kept
    FROM lineitem
    LEFT JOIN part ON l_partkey = p_partkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN nation ON s_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey
"""
# Discounts of many digits; products of one type are unknown.
LONG_LINES = (
    LINES.replace("CAST(1 - CAST(l_discount AS DECIMAL(9,8)) AS DECIMAL(9,8)) AS kept",
                  "CAST(1 - CAST(CAST(l_discount / 7 AS VARCHAR) AS DECIMAL(19,18)) AS DECIMAL(19,18)) AS kept")
    .replace("AS DECIMAL(20,6)) AS list_price", "AS DECIMAL(16,6)) AS list_price")
    .replace("CAST(l_quantity AS DECIMAL(6,0)) AS qty", "CAST(l_quantity AS DECIMAL(3,0)) AS qty")
    .replace("l_partkey = p_partkey", "l_partkey = p_partkey AND p_type <> 'PROMO'")
)
# Prices of five decimals; types just wide enough, so that the product fits 38 digits.
DIGIT_LINES = LONG_LINES.replace(
    "CAST(p_retailprice AS DECIMAL(12,2))", "CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 0.001 AS DECIMAL(9,5))"
).replace("ELSE 1 END AS DECIMAL(5,4)", "ELSE 1 END AS DECIMAL(3,2)").replace(
    "AS DECIMAL(16,6)) AS list_price", "AS DECIMAL(12,7)) AS list_price"
)
HEADERS = f"""
    SELECT transaction_id, CAST(ROUND(exact, 2) AS DOUBLE) AS subtotal,
           CAST(ROUND(exact * CAST(0.08 AS DECIMAL(3,2)), 2) AS DOUBLE) AS tax_amount,
           CAST(ROUND(exact * CAST(1.08 AS DECIMAL(3,2)), 2) AS DOUBLE) AS total_amount
    FROM (SELECT transaction_id, CAST(SUM(list_price * kept * qty) AS DECIMAL(32,14)) AS exact
          FROM ({LINES}) GROUP BY transaction_id)"""
HEADERS_LONG = f"""
    SELECT transaction_id, CAST(ROUND(exact, 2) AS DOUBLE) AS subtotal,
           CAST(ROUND(CAST(exact AS DECIMAL(34,20)) * CAST(0.08 AS DECIMAL(3,2)), 2) AS DOUBLE) AS tax_amount,
           CAST(ROUND(CAST(exact AS DECIMAL(34,20)) * CAST(1.08 AS DECIMAL(3,2)), 2) AS DOUBLE) AS total_amount
    FROM (SELECT transaction_id, SUM(list_price * kept * qty) AS exact FROM ({LONG_LINES}) GROUP BY transaction_id)"""
LINE_KEYS = "transaction_id, line_number, sku, store_id, quantity"


def parts_of(key: str, ts: str, source: str) -> str:
    return f"""
    SELECT {key}, CAST({ts} AS DATE) AS "date", CAST(HOUR({ts}) AS BIGINT) AS "hour",
           CAST(ISODOW({ts}) - 1 AS BIGINT) AS day_of_week, CAST(MONTH({ts}) AS BIGINT) AS "month",
           CAST(QUARTER({ts}) AS BIGINT) AS "quarter", CAST(YEAR({ts}) AS BIGINT) AS "year"
    FROM {source}"""


PROFILE = """
    SELECT 'transactions' AS table_name, COUNT(*) AS row_count,
           MIN(CAST(o_orderdate AS DATE)) AS date_from, MAX(CAST(o_orderdate AS DATE)) AS date_to FROM orders
    UNION ALL SELECT 'stores', COUNT(*), NULL, NULL FROM supplier
    UNION ALL SELECT 'products', COUNT(*), NULL, NULL FROM part"""

ORACLE: dict[str, str] = {
    "basic_stats_flat": with_sales(f"SELECT {BASIC} FROM sales"),
    "basic_stats_star": with_sales(
        f"SELECT {BASIC}, CAST(MIN(ts) AS DATE) AS date_from, CAST(MAX(ts) AS DATE) AS date_to, {RATIOS} FROM sales"
    ),
    "basic_stats_ratios": with_sales(f"SELECT {BASIC}, {RATIOS} FROM sales"),
    "mini_stats": with_sales(f"SELECT COUNT(*) AS total_transactions, {TOTALS}, {MEAN} FROM sales"),
    "sales_by_segment": with_sales(f"SELECT {SEGMENT} FROM sales GROUP BY customer_segment"),
    "sales_by_segment_share": with_sales(SEGMENT_SHARE),
    "sales_by_segment_net": f"""
        WITH sales AS (
            SELECT CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS amount,
                   o_custkey AS customer_id, c_mktsegment AS customer_segment
            FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey)
        SELECT customer_segment, COUNT(*) AS transaction_count, ROUND(CAST(SUM(amount) AS DOUBLE), 4) AS total_revenue,
               ROUND(CAST(SUM(amount) AS DOUBLE) / COUNT(amount), 4) AS avg_transaction_value,
               {CUSTOMERS} AS unique_customers
        FROM sales GROUP BY customer_segment""",
    "product_performance": with_sales(f"""
        SELECT product_category, CAST(SUM(quantity) AS BIGINT) AS total_units_sold, {TOTALS},
               CAST(SUM((CAST(amount * 100 AS BIGINT) * 2 + quantity) // (quantity * 2)) AS DOUBLE) / 100
                 / COUNT(*) AS avg_unit_price,
               COUNT(DISTINCT store_id) AS stores_selling
        FROM sales GROUP BY product_category"""),
    "regional_flat": with_sales(f"""
        SELECT region, state, {TOTALS}, {MEAN}, COUNT(DISTINCT store_id) AS store_count,
               {CUSTOMERS} AS customer_count
        FROM sales GROUP BY region, state"""),
    "regional_star": with_sales(REGION_STAR),
    "regional_star_unknown": with_sales(f"""
        , known AS (SELECT * REPLACE (CASE WHEN region <> 'ASIA' THEN region END AS region,
                                      CASE WHEN region <> 'ASIA' THEN state END AS state) FROM sales)
        {REGION_STAR.replace('FROM sales', 'FROM known')}"""),
    "regional_by_store": with_sales(
        f"SELECT store_id, {TOTALS}, {MEAN}, COUNT(*) AS transaction_count FROM sales GROUP BY store_id"
    ),
    "monthly_sales": with_sales(windows(MONTH, f"{MONTH} + INTERVAL 1 MONTH", FLAT_WINDOW)),
    "quarterly_sales": with_sales(windows(QUARTER, f"{QUARTER} + INTERVAL 3 MONTH", FLAT_WINDOW)),
    "monthly_sales_growth": with_sales(windows(MONTH, f"{MONTH} + INTERVAL 1 MONTH", STAR_WINDOW, growth=True)),
    "events_daily": with_events(windows(*bucket("1 day"), STAR_WINDOW)),
    "events_6h": with_events(windows(*bucket("6 hours"), STAR_WINDOW)),
    "events_7d": with_events(windows(*bucket("7 days"), STAR_WINDOW)),
    "events_3d_by_date": with_events(windows(*bucket("3 days"), FLAT_WINDOW)),
    "events_daily_growth": with_events(windows(*bucket("1 day"), STAR_WINDOW, growth=True)),
    "events_6h_growth": with_events(windows(*bucket("6 hours"), STAR_WINDOW, growth=True)),
    "customer_cohorts": f"WITH sales AS ({SALES}) {COHORTS}",
    "event_cohorts": f"WITH sales AS ({EVENTS}) {COHORTS}",
    "uneven_segments": f"""
        WITH sales AS ({UNEVEN})
        SELECT customer_segment, COUNT(*) AS transaction_count, {UNEVEN_REVENUE} AS total_revenue,
               ({UNEVEN_REVENUE}) / COUNT(amount) AS avg_transaction_value, {CUSTOMERS} AS unique_customers,
               {deviation('1000000000', 'fine')},
               ({UNEVEN_REVENUE}) / ({uneven('SUM(SUM(whole_cents)) OVER ()', 'SUM(SUM(rest)) OVER ()')}) AS revenue_share
        FROM sales GROUP BY customer_segment""",
    "uneven_6h_growth": f"""
        WITH sales AS ({UNEVEN}), windows AS (
            SELECT {bucket("6 hours")[0]} AS window_start, {bucket("6 hours")[1]} AS window_end, COUNT(*) AS transaction_count,
                   {CUSTOMERS} AS unique_customers, {UNEVEN_REVENUE} AS total_revenue,
                   ({UNEVEN_REVENUE}) / COUNT(amount) AS avg_transaction_value,
                   SUM(whole_cents) AS whole_cents, SUM(rest) AS rest
            FROM sales GROUP BY 1, 2),
        apart AS (
            SELECT *, whole_cents - LAG(whole_cents) OVER (ORDER BY window_start) AS cents_apart,
                   rest - LAG(rest) OVER (ORDER BY window_start) AS rest_apart
            FROM windows)
        SELECT window_start, window_end, transaction_count, unique_customers, total_revenue, avg_transaction_value,
               {uneven('cents_apart', 'rest_apart')} AS revenue_growth
        FROM apart""",
    "uneven_cohorts": f"WITH sales AS ({UNEVEN}) "
    + COHORTS.replace("customer_id, amount,", "customer_id, whole_cents, rest,").replace(REVENUE, UNEVEN_REVENUE),
    "line_pricing": f"""
        SELECT {LINE_KEYS}, CAST(ROUND(list_price * kept, 2) AS DOUBLE) AS unit_price,
               CAST(ROUND(list_price * kept * qty, 2) AS DOUBLE) AS line_total
        FROM ({LINES})""",
    "line_discount": f"""
        SELECT {LINE_KEYS},
               CAST(ROUND(list_price - list_price * kept, 2) * qty AS DOUBLE) AS discount_amount
        FROM ({LINES})""",
    "line_pricing_long": f"""
        SELECT {LINE_KEYS}, CAST(ROUND(list_price * kept, 2) AS DOUBLE) AS unit_price,
               CAST(ROUND(list_price * kept * qty, 2) AS DOUBLE) AS line_total,
               CAST(ROUND(list_price * CAST(1 - kept AS DECIMAL(19,18)), 2) * qty AS DOUBLE) AS discount_amount
        FROM ({LONG_LINES})""",
    "line_pricing_digits": f"""
        SELECT {LINE_KEYS}, CAST(ROUND(list_price * kept, 2) AS DOUBLE) AS unit_price,
               CAST(ROUND(list_price * kept * qty, 2) AS DOUBLE) AS line_total,
               CAST(ROUND(list_price * CAST(1 - kept AS DECIMAL(19,18)), 2) * qty AS DOUBLE) AS discount_amount
        FROM ({DIGIT_LINES})""",
    "header_rollup": HEADERS,
    "header_rollup_long": HEADERS_LONG,
    "header_segments": f"""
        WITH sales AS (
            SELECT CAST(total_amount AS DECIMAL(12,2)) AS amount, o_custkey AS customer_id,
                   c_mktsegment AS customer_segment
            FROM ({HEADERS}) LEFT JOIN orders ON transaction_id = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey)
        SELECT {SEGMENT} FROM sales GROUP BY customer_segment""",
    "item_sequence": """
        SELECT l_orderkey AS transaction_id, CAST(l_linenumber AS BIGINT) AS line_number, l_partkey AS sku,
               l_suppkey AS store_id, l_extendedprice AS line_total, l_quantity AS quantity,
               l_shipdate AS shipped,
               ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
                                  l_extendedprice, l_quantity, l_shipdate) AS item_sequence
        FROM lineitem""",
    "calendar_parts": parts_of("o_orderkey", "o_orderdate", "orders"),
    "calendar_parts_events": parts_of("event_id", "ts", "events"),
    "region_premium": """
        SELECT s_suppkey AS store_id, r_name AS region, n_name AS state,
               CASE r_name WHEN 'AMERICA' THEN 1.15::DOUBLE WHEN 'EUROPE' THEN 1.25::DOUBLE
                           WHEN 'ASIA' THEN 0.95::DOUBLE END AS price_premium,
               CASE r_name WHEN 'AMERICA' THEN 0.6::DOUBLE WHEN 'EUROPE' THEN 0.7::DOUBLE END
                 AS seasonal_multiplier
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "seasonal_factor": """
        SELECT o_orderkey, CAST(MONTH(o_orderdate) AS BIGINT) AS "month",
               CAST(CASE MONTH(o_orderdate)
                    WHEN 1 THEN 0.7 WHEN 2 THEN 0.8 WHEN 3 THEN 1.1 WHEN 4 THEN 1.4 WHEN 5 THEN 1.6
                    WHEN 6 THEN 1.8 WHEN 7 THEN 1.7 WHEN 8 THEN 1.5 WHEN 9 THEN 1.2 WHEN 10 THEN 1.0
                    WHEN 11 THEN 0.8 WHEN 12 THEN 0.9 END AS DOUBLE) AS seasonal_factor,
               CAST(CASE MONTH(o_orderdate) WHEN 1 THEN 0.7 WHEN 6 THEN 1.8 ELSE 1.0 END AS DOUBLE)
                 AS partial_factor
        FROM orders""",
    "product_attributes": """
        SELECT p_partkey,
               TRIM(CONCAT_WS(' ', p_brand, p_type,
                    CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN SPLIT_PART(p_name, ' ', 1) ELSE '' END,
                    SPLIT_PART(p_name, ' ', 2), CAST(p_size AS VARCHAR))) AS product_name,
               p_type IN ('PROMO', 'SMALL') AS is_hazmat
        FROM part""",
    "business_keys": """
        SELECT c_custkey, UPPER(SUBSTR(c_mktsegment, 1, 3)) || '_' || FORMAT('{:08d}', c_custkey) AS customer_id
        FROM customer""",
    "sku_keys": "SELECT p_partkey, 'P' || CAST(p_partkey AS VARCHAR) AS sku FROM part",
    "dataset_profile": PROFILE,
    "dataset_info": f"""
        SELECT *, total_transactions * 0.1::DOUBLE / 1000000 AS estimated_size_gb,
               total_transactions // 1000000 AS chunks_generated
        FROM (SELECT MAX(row_count) FILTER (table_name = 'transactions') AS total_transactions,
                     MAX(row_count) FILTER (table_name = 'stores') AS total_stores,
                     MAX(row_count) FILTER (table_name = 'products') AS total_products,
                     CAST(MIN(date_from) AS VARCHAR) || ' to ' || CAST(MAX(date_to) AS VARCHAR) AS date_range
              FROM ({PROFILE}))""",
    "flat_sales": with_sales("""
        SELECT transaction_id, customer_id, store_id, customer_segment, product_category, region, state, quantity,
               CAST((CAST(amount * 100 AS BIGINT) * 2 + quantity) // (quantity * 2) AS DOUBLE) / 100 AS unit_price,
               CAST(amount AS DOUBLE) AS transaction_total, ts AS transaction_date
        FROM sales"""),
    "run_metrics": with_sales(f"""
        , stats AS (SELECT {BASIC} FROM sales)
        SELECT 'TransactionsLoaded' AS metric, CAST(total_transactions AS DOUBLE) AS value, 'Count' AS unit FROM stats
        UNION ALL SELECT 'TotalRevenue', total_revenue, 'Count' FROM stats
        UNION ALL SELECT 'UniqueCustomers', CAST(unique_customers AS DOUBLE), 'Count' FROM stats"""),
    "chunked_fact": with_sales(
        f"SELECT store_id, {TOTALS}, {MEAN}, COUNT(*) AS transaction_count FROM sales GROUP BY store_id"
    ),
    "filtered_fact": with_sales(f"SELECT {SEGMENT} FROM sales GROUP BY customer_segment"),
    "recursive_fact": with_sales(f"SELECT {SEGMENT} FROM sales GROUP BY customer_segment"),
    "partitioned_fact": with_sales(f"""
        SELECT CAST(YEAR(ts) AS BIGINT) AS "year", CAST(MONTH(ts) AS BIGINT) AS "month", COUNT(*) AS transaction_count,
               {CUSTOMERS} AS unique_customers
        FROM sales GROUP BY 1, 2"""),
    "saved_segments": with_sales(SEGMENT_SHARE),
    "saved_segments_json": with_sales(f"SELECT {SEGMENT} FROM sales GROUP BY customer_segment"),
    "saved_time_series": f"""
        SELECT *, CAST(window_start AS DATE) AS window_date
        FROM ({with_sales(windows(MONTH, f"{MONTH} + INTERVAL 1 MONTH", STAR_WINDOW, growth=True))})""",
    "pipeline_statistics": with_sales(f"""
        SELECT COUNT(*) AS transaction_count, (SELECT COUNT(*) FROM supplier) AS stores_count,
               (SELECT COUNT(*) FROM part) AS products_count, {TOTALS}, {MEAN},
               {CUSTOMERS} AS unique_customers, COUNT(DISTINCT store_id) AS active_stores,
               CAST(MIN(ts) AS DATE) AS date_from, CAST(MAX(ts) AS DATE) AS date_to
        FROM sales"""),
    "pruned_fact": with_sales(f"""
        SELECT {SEGMENT} FROM sales WHERE YEAR(ts) = 1996 AND MONTH(ts) BETWEEN 4 AND 6 GROUP BY customer_segment"""),
}
ORACLE |= {
    "saved_cohorts_json": ORACLE["customer_cohorts"],
    "appended_segments": f"{ORACLE['sales_by_segment']} UNION ALL ({ORACLE['sales_by_segment']})",
    "saved_profile": ORACLE["dataset_info"],
    "pipeline_cached": ORACLE["pipeline_statistics"],
    "pipeline_basic_stats": ORACLE["basic_stats_star"],
    "pipeline_segments": ORACLE["sales_by_segment_share"],
    "pipeline_regions": ORACLE["regional_star"],
    "pipeline_time_series": ORACLE["saved_time_series"],
    "pipeline_one_scan_stats": ORACLE["basic_stats_star"],
    "pipeline_one_scan_segments": ORACLE["sales_by_segment_share"],
    "pipeline_one_scan_regions": ORACLE["regional_star"],
    "pipeline_one_scan_series": ORACLE["saved_time_series"],
    "run_metrics_observed": ORACLE["run_metrics"],
    "mixed_chunks": ORACLE["monthly_sales_growth"],
    "bucketed_flat_sales": ORACLE["flat_sales"],
    "bucketed_cohorts": ORACLE["customer_cohorts"],
    "clustered_quarter": ORACLE["pruned_fact"],
    "clustered_customer": with_sales("""
        SELECT customer_id, transaction_id, sku, store_id, quantity, CAST(amount AS DOUBLE) AS total_amount,
               CAST(ts AS DATE) AS date
        FROM sales WHERE customer_id = (SELECT MIN(customer_id) FROM sales)"""),
    "published_segments": ORACLE["sales_by_segment"],
    "published_twice": f"{ORACLE['sales_by_segment']} UNION ALL ({ORACLE['sales_by_segment']})",
    "rewritten_month": ORACLE["partitioned_fact"].replace(
        "FROM sales GROUP BY",
        "FROM sales WHERE YEAR(ts) <> 1996 OR MONTH(ts) <> 4 OR customer_segment = 'BUILDING' GROUP BY",
    ),
}
