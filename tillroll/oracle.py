"""DuckDB SQL that rebuilds the retail and log tables from the driver's views.

Used as the correctness oracle: each query key in ``__spark_entry__`` has a
SQL twin written against the pre-registered views (region, nation, customer,
supplier, part, orders, lineitem, events, pages). The CTEs below state
``tillroll.sources.binding`` and the Silver rules again in SQL. Decisions that
both sides share cannot be caught here; ``tests/test_invariants.py`` holds
what must be true whatever was decided.
"""

from __future__ import annotations

TIERS = """CASE WHEN {b} < 45 THEN 'Bronze' WHEN {b} < 75 THEN 'Silver'
              WHEN {b} < 93 THEN 'Gold' ELSE 'Platinum' END"""

BALANCE_TIERS = """CASE WHEN c_acctbal < 4500 THEN 'Bronze' WHEN c_acctbal < 7500 THEN 'Silver'
              WHEN c_acctbal < 8700 THEN 'Gold' ELSE 'Platinum' END"""

GEO = """geo AS (
  SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)"""

RAW_TXN = """raw_txn AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id,
         CASE WHEN l_partkey % 250 = 7 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
         CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(l_suppkey AS VARCHAR) AS store_id,
         CAST(l_shipdate AS DATE) AS transaction_date,
         CASE WHEN l_partkey % 250 = 3 THEN -1 ELSE CAST(trunc(l_quantity) AS INTEGER) END AS quantity,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
         CASE WHEN l_orderkey % 20 < 11 THEN 'Card' WHEN l_orderkey % 20 < 15 THEN 'Cash'
              WHEN l_orderkey % 20 < 17 THEN 'Loyalty Points' ELSE 'Mobile Wallet' END AS payment_method
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)"""

TXN_ORDER = "transaction_date, customer_id, product_id, store_id, quantity, amount, payment_method"

TXN = f"""txn AS (
  SELECT * FROM raw_txn
  WHERE quantity > 0 AND customer_id IS NOT NULL AND customer_id <> ''
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY {TXN_ORDER}) = 1)"""

PRODUCTS = """products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS category,
         CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price,
         CAST('0.' || CAST(45 + p_partkey % 31 AS VARCHAR) AS DECIMAL(4,3)) AS cost_price_pct
  FROM part)"""

STORES = """stores AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS store_id, r_name AS region,
         CASE WHEN s_suppkey % 20 < 1 THEN 'Flagship' WHEN s_suppkey % 20 < 9 THEN 'Mall'
              WHEN s_suppkey % 20 < 16 THEN 'Standalone' ELSE 'Express' END AS store_format
  FROM supplier LEFT JOIN geo ON s_nationkey = n_nationkey)"""

CUSTOMER_COLS = """CAST(c_custkey AS VARCHAR) AS customer_id, r_name AS region,
         {tier} AS loyalty_tier,
         CAST(DATE '2023-01-01' - CAST(c_custkey % 730 AS INTEGER) AS DATE) AS signup_date,
         c_acctbal >= 2500 AS email_opt_in"""

CUSTOMERS = ("""customers AS (
  SELECT """ + CUSTOMER_COLS.format(tier=TIERS.format(b="c_custkey % 100")) + """
  FROM customer LEFT JOIN geo ON c_nationkey = n_nationkey)""")

DIM_CUSTOMER = """dim_customer AS (
  SELECT *, DATE '2024-01-01' AS effective_from, CAST(NULL AS DATE) AS effective_to,
         TRUE AS is_current FROM customers)"""

ENRICHED = """enriched AS (
  SELECT t.*, p.category, p.cost_price_pct, s.region, s.store_format, c.loyalty_tier,
         ROUND(t.amount * (1 - p.cost_price_pct), 2) AS gross_margin,
         strftime(t.transaction_date, '%Y-%m') AS month
  FROM txn t
  LEFT JOIN products p ON t.product_id = p.product_id
  LEFT JOIN stores s ON t.store_id = s.store_id
  LEFT JOIN dim_customer c ON t.customer_id = c.customer_id AND c.is_current)"""

LOYALTY_RAW = """{name} AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS customer_id,
         CAST(ts AS DATE) AS event_date,
         CASE WHEN event_type IN ('purchase', 'view') THEN 'earn' WHEN event_type = 'click' THEN 'redeem'
              WHEN event_type = 'signup' THEN 'expire' ELSE event_type END AS event_type,
         CASE WHEN event_type IN ('purchase', 'view') THEN CAST(round(value) AS BIGINT)
              ELSE -CAST(round(value) AS BIGINT) END AS points,
         {feed} AS feed
  FROM events WHERE {where})"""

LOYALTY = (LOYALTY_RAW.format(name="loy_batch", feed=0, where="ts < TIMESTAMP '2024-01-20 00:00:00'")
           + ",\n" + LOYALTY_RAW.format(name="loy_rt", feed=1,
                                        where="ts >= TIMESTAMP '2024-01-15 00:00:00'")
           + ",\n" + LOYALTY_RAW.format(name="loy_all", feed=0, where="TRUE") + """,
loyalty_union AS (
  SELECT event_id, customer_id, event_date, event_type, points FROM (
    SELECT * FROM loy_batch UNION ALL SELECT * FROM loy_rt)
  WHERE event_type IN ('earn', 'redeem', 'expire')
  QUALIFY row_number() OVER (PARTITION BY event_id
      ORDER BY feed, customer_id, event_date, event_type, points) = 1),
loyalty AS (
  SELECT * FROM loyalty_union l
  WHERE EXISTS (SELECT 1 FROM dim_customer c WHERE c.is_current AND c.customer_id = l.customer_id))""")

GOLD = """fact_sales AS (
  SELECT month, region, category, CAST(SUM(amount) AS DOUBLE) AS revenue,
         CAST(SUM(quantity) AS BIGINT) AS units, CAST(SUM(gross_margin) AS DOUBLE) AS gross_margin,
         COUNT(transaction_id) AS transactions
  FROM enriched GROUP BY month, region, category),
fact_store AS (
  SELECT store_id, store_format, region, CAST(SUM(amount) AS DOUBLE) AS revenue,
         CAST(SUM(gross_margin) AS DOUBLE) AS gross_margin, COUNT(transaction_id) AS transactions
  FROM enriched GROUP BY store_id, store_format, region),
fact_tier AS (
  SELECT loyalty_tier, COUNT(DISTINCT customer_id) AS customers, CAST(SUM(amount) AS DOUBLE) AS revenue,
         CAST((2 * CAST(SUM(amount) * 100 AS HUGEINT) + COUNT(amount)) // (2 * COUNT(amount)) AS DOUBLE)
           / 100 AS avg_basket
  FROM enriched GROUP BY loyalty_tier),
dim_date AS (
  SELECT CAST(d AS DATE) AS date, CAST(year(d) AS BIGINT) AS year, 'Q' || CAST(quarter(d) AS VARCHAR) AS quarter,
         monthname(d) AS month_name, strftime(d, '%Y-%m') AS month
  FROM (SELECT unnest(generate_series(CAST(min(transaction_date) AS TIMESTAMP),
                                      CAST(max(transaction_date) AS TIMESTAMP), INTERVAL 1 DAY)) AS d
        FROM txn)),
month_dim AS (SELECT DISTINCT month, year, quarter, month_name FROM dim_date)"""

SCD = """day1 AS (
  SELECT """ + CUSTOMER_COLS.format(tier=TIERS.format(b="c_custkey % 100")) + """,
         DATE '2024-01-01' AS effective_from, CAST(NULL AS DATE) AS effective_to, TRUE AS is_current
  FROM customer LEFT JOIN geo ON c_nationkey = n_nationkey WHERE c_acctbal >= 0),
day2 AS (
  SELECT """ + CUSTOMER_COLS.format(tier=BALANCE_TIERS) + """
  FROM customer LEFT JOIN geo ON c_nationkey = n_nationkey WHERE c_acctbal < 9000),
scd_new AS (
  SELECT s.* FROM day2 s
  WHERE NOT EXISTS (SELECT 1 FROM day1 d WHERE d.is_current AND d.customer_id = s.customer_id
                    AND NOT coalesce(d.loyalty_tier <> s.loyalty_tier, FALSE))),
scd_merged AS (
  SELECT * FROM day1 WHERE NOT is_current
  UNION ALL
  SELECT d.customer_id, d.region, d.loyalty_tier, d.signup_date, d.email_opt_in, d.effective_from,
         CASE WHEN coalesce(d.loyalty_tier <> s.loyalty_tier, FALSE) THEN DATE '2024-02-01'
              ELSE d.effective_to END,
         CASE WHEN coalesce(d.loyalty_tier <> s.loyalty_tier, FALSE) THEN FALSE ELSE d.is_current END
  FROM day1 d LEFT JOIN day2 s ON d.customer_id = s.customer_id WHERE d.is_current
  UNION ALL
  SELECT *, DATE '2024-02-01', CAST(NULL AS DATE), TRUE FROM scd_new)"""

LOGS = """runs AS (
  SELECT ts AS TimeGenerated,
         CASE WHEN user_id % 3 = 2 THEN 'pl_customer_sync' ELSE 'pl_medallion_refresh' END AS PipelineName,
         CASE WHEN event_type = 'error' THEN 'Failed' ELSE 'Succeeded' END AS Status,
         ts AS Start, ts + to_microseconds(CAST(round(value * 60000000) AS BIGINT)) AS "End"
  FROM events),
activities AS (
  SELECT ts AS TimeGenerated,
         CASE WHEN user_id % 3 = 2 THEN 'pl_customer_sync' ELSE 'pl_medallion_refresh' END AS PipelineName,
         CASE CAST(json_extract_string(props, '$.k') AS INTEGER) % 4
              WHEN 0 THEN 'copy_source_extracts_to_landing' WHEN 1 THEN 'validate_landing_row_counts'
              WHEN 2 THEN 'trigger_databricks_medallion_job' ELSE 'run_dq_suite_gate' END AS ActivityName,
         CASE WHEN event_type = 'error' THEN 'Failed' ELSE 'Succeeded' END AS Status
  FROM events),
jobs AS (
  SELECT ts AS TimeGenerated,
         CASE WHEN event_type IN ('purchase', 'view', 'error') THEN 'medallion_daily_refresh'
              ELSE 'customer_sync' END AS JobName,
         value AS DurationMinutes
  FROM events),
blobs AS (
  SELECT TIMESTAMP '2024-01-01 00:00:00' + CAST(page_id AS INTEGER) * INTERVAL 1 HOUR AS TimeGenerated,
         url AS Uri, CAST(length(html) AS BIGINT) AS ResponseBodySize
  FROM pages),
metrics AS (
  SELECT ts AS TimeGenerated,
         CASE WHEN event_type = 'signup' THEN 'MICROSOFT.STORAGE' ELSE 'MICROSOFT.DATABRICKS' END AS ResourceProvider,
         CASE WHEN event_type IN ('purchase', 'view', 'click') THEN 'DBUUsage' ELSE 'CPUUsage' END AS MetricName,
         value AS Total
  FROM events),
inventory AS (
  SELECT CASE WHEN o_orderstatus = 'F' THEN 'bronze' WHEN o_orderstatus = 'O' THEN 'silver' ELSE 'gold' END
           || '/orders/' || CAST(o_orderkey AS VARCHAR) || '.parquet' AS path,
         o_orderdate AS modified, o_totalprice / 1000.0 AS size_gb, o_orderstatus = 'P' AS is_version
  FROM orders)"""

RETAIL = ",\n".join([GEO, RAW_TXN, TXN, PRODUCTS, STORES, CUSTOMERS, DIM_CUSTOMER, ENRICHED,
                     LOYALTY, GOLD, SCD])


def with_base(select: str) -> str:
    return "WITH " + RETAIL + "\n" + select


def with_logs(select: str) -> str:
    return "WITH " + LOGS + "\n" + select


def q(s: str) -> str:
    """Quote a Python string as a SQL literal."""
    return "'" + s.replace("'", "''") + "'"


def ratio_check(name: str, table: str, num: str, den: str, threshold: float, tail: str,
                source: str) -> str:
    """One check-result row in SQL (same rules as operators.dq)."""
    return f"""SELECT {q(name)} AS check_name, {q(table)} AS "table",
       CASE WHEN score >= {threshold!r} THEN 'PASS' ELSE 'FAIL' END AS status,
       round(score, 4) AS metric_value, CAST({threshold!r} AS DOUBLE) AS threshold,
       format('{{:,}}/{{:,}}', n, d) || {q(tail)} AS detail
FROM (SELECT n, d, coalesce(CAST(n AS DOUBLE) / NULLIF(CAST(d AS DOUBLE), 0), 0.0) AS score
      FROM (SELECT {num} AS n, {den} AS d FROM {source}))"""


def freshness_check(table: str, col: str, max_age: int, as_of: str, source: str) -> str:
    return f"""SELECT 'freshness' AS check_name, {q(table)} AS "table",
       CASE WHEN age IS NOT NULL AND age <= {max_age} THEN 'PASS' ELSE 'FAIL' END AS status,
       CAST(age AS DOUBLE) AS metric_value, CAST({max_age} AS DOUBLE) AS threshold,
       CASE WHEN total = 0 THEN 'Table is empty' WHEN age IS NULL THEN 'No dated records'
            ELSE 'Latest record is ' || CAST(age AS VARCHAR) || ' days old (max allowed: {max_age})' END AS detail
FROM (SELECT count(*) AS total, date_diff('day', max(CAST({col} AS DATE)), DATE '{as_of}') AS age FROM {source})"""
