"""The comparable queries, one per operator of the inventory.

Every query reads the whole driver tables through the binding; none runs on
fixed or made-up input. The SQL twin of each is given in its register call.
Output columns are aliased identically on both sides; decimals are reported
as double; clock stamps are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll import oracle as O
from tillroll.operators import dq, gold, oplog, scd2, silver, uniqueness
from tillroll.plans import model, retail, semantic
from tillroll.plans.registry import ORACLES, register
from tillroll.session import work_path
from tillroll.sources import binding, files
from tillroll.streaming import file_ingest, realtime, silver_append

W = O.with_base
L = O.with_logs

SUITE_AS_OF = "2004-01-01"
SCD2_AS_OF = "2024-02-01"
DAY1 = retail.DAY1
LOG_AS_OF = "2024-01-31 00:00:00"
STORAGE_AS_OF = "2001-09-01"
LANDING_MINIMUMS = {"customers": 1, "products": 1, "stores": 1, "transactions": 1,
                    "loyalty_events": 1}


def out(df: DataFrame) -> DataFrame:
    """Report decimals as double; everything else unchanged."""
    cols = [F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


TXN_COLS = ("transaction_id, customer_id, product_id, store_id, transaction_date, quantity, "
            "CAST(amount AS DOUBLE) AS amount, payment_method")


def _typed_txn(spark, sf):
    return silver.type_table(binding.raw_transactions(spark, sf), "transactions")


# ---------------------------------------------------------------------------
# Silver: casts, filters, dedupe
# ---------------------------------------------------------------------------


@register("coerce_cast", W(f"SELECT {TXN_COLS} FROM raw_txn"))
def q_coerce_cast(spark: SparkSession, sf: str) -> DataFrame:
    return out(_typed_txn(spark, sf))


@register("positive_quantity", W(f"SELECT {TXN_COLS} FROM raw_txn WHERE quantity > 0"))
def q_positive_quantity(spark, sf):
    return out(silver.positive_quantity(_typed_txn(spark, sf)))


@register("present_key", W(f"""SELECT {TXN_COLS} FROM raw_txn
WHERE customer_id IS NOT NULL AND customer_id <> ''"""))
def q_present_key(spark, sf):
    return out(silver.present_key(_typed_txn(spark, sf)))


@register("event_type_in", W("""SELECT event_id, customer_id, event_date, event_type, points
FROM loy_all WHERE event_type IN ('earn', 'redeem', 'expire')"""))
def q_event_type_in(spark, sf):
    return retail.typed_events(spark, sf)


@register("dedupe_transactions", W(f"""SELECT {TXN_COLS} FROM raw_txn
QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY {O.TXN_ORDER}) = 1"""))
def q_dedupe(spark, sf):
    return out(silver.dedupe(_typed_txn(spark, sf), ["transaction_id"],
                             [F.col(c).asc_nulls_last() for c in silver.TXN_ORDER]))


@register("cleanse_transactions", W(f"SELECT {TXN_COLS} FROM txn"))
def q_cleanse(spark, sf):
    return out(silver.cleanse_transactions(binding.raw_transactions(spark, sf), stamp=False))


@register("reject_accounting", W("""SELECT total, clean, total - clean AS rejected, bad_quantity,
       missing_customer, passing - clean AS duplicates,
       coalesce(CAST(clean AS DOUBLE) / NULLIF(CAST(total AS DOUBLE), 0), 0.0) AS pass_rate
FROM (SELECT count(*) AS total,
             count_if(NOT coalesce(quantity > 0, FALSE)) AS bad_quantity,
             count_if(quantity > 0 AND NOT (customer_id IS NOT NULL AND customer_id <> '')) AS missing_customer,
             count_if(quantity > 0 AND customer_id IS NOT NULL AND customer_id <> '') AS passing,
             (SELECT count(*) FROM txn) AS clean
      FROM raw_txn)"""))
def q_reject_accounting(spark, sf):
    return silver.reject_accounting(binding.raw_transactions(spark, sf))


# Two deliveries of the whole fact, cut at a ship date.
DELIVERY_CUT = "1995-06-01"
_RUNS_SQL = f"""passing AS (
  SELECT *, CAST(transaction_date AS DATE) >= DATE '{DELIVERY_CUT}' AS late
  FROM raw_txn WHERE quantity > 0 AND customer_id IS NOT NULL AND customer_id <> ''),
runs AS (
  SELECT * FROM passing
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY late, {O.TXN_ORDER}) = 1)"""


def _runs_sql(select: str) -> str:
    return "WITH " + O.RETAIL + ",\n" + _RUNS_SQL + "\n" + select


def _two_runs(spark: SparkSession, sf: str) -> str:
    """A lake whose Silver took two deliveries; the second carries an earlier clock than the first."""
    lake = work_path(spark, "two_runs", fresh=True)
    raw = binding.raw_transactions(spark, sf)
    late = F.col("transaction_date") >= DELIVERY_CUT
    for delivery, stamp in ((raw.filter(~late), "2024-02-01"), (raw.filter(late), "2024-01-01")):
        (delivery.withColumn("_ingested_ts", F.lit(stamp).cast("timestamp")).withColumn("_source_file", F.lit(stamp))
         .write.mode("append").parquet(f"{lake}/bronze/transactions"))
        silver_append.append_transactions(spark, lake, pass_rate=0.5)
    return lake


@register("append_second_run", _runs_sql(f"SELECT {TXN_COLS} FROM runs"))
def q_append_second_run(spark, sf):
    """J1 / J6 over appended history: what the first run published stays, the second adds new ids only."""
    lake = _two_runs(spark, sf)
    return out(silver.drop_stamps(files.read_epochs(spark, lake, "silver", "transactions")))


@register("append_accounting", _runs_sql("""SELECT total, clean, total - clean AS rejected, bad_quantity, missing_customer,
       passing - clean AS duplicates, CAST(clean AS DOUBLE) / CAST(total AS DOUBLE) AS pass_rate
FROM (SELECT count(*) AS total, count_if(NOT coalesce(quantity > 0, FALSE)) AS bad_quantity,
             count_if(quantity > 0 AND NOT (customer_id IS NOT NULL AND customer_id <> '')) AS missing_customer,
             (SELECT count(*) FROM passing) AS passing, (SELECT count(*) FROM runs) AS clean
      FROM raw_txn)"""))
def q_append_accounting(spark, sf):
    """P12 as counted on the passes of two runs (``observe``), over both."""
    acc = silver_append.total_accounting(spark, _two_runs(spark, sf))
    names = ["total", "clean", "rejected", "bad_quantity", "missing_customer", "duplicates", "pass_rate"]
    return spark.createDataFrame([tuple(acc[n] for n in names)],
                                 ", ".join(f"{n} {'double' if n == 'pass_rate' else 'bigint'}" for n in names))


@register("gross_margin", W("""SELECT transaction_id, CAST(amount AS DOUBLE) AS amount,
       CAST(cost_price_pct AS DOUBLE) AS cost_price_pct, CAST(gross_margin AS DOUBLE) AS gross_margin
FROM enriched"""))
def q_gross_margin(spark, sf):
    return out(retail.enriched(spark, sf, ["cost_price_pct", "gross_margin"])
               .select("transaction_id", "amount", "cost_price_pct", "gross_margin"))


@register("month_key", W("SELECT transaction_id, transaction_date, month FROM enriched"))
def q_month_key(spark, sf):
    return retail.enriched(spark, sf, ["month"]).select("transaction_id", "transaction_date", "month")


# ---------------------------------------------------------------------------
# Joins and feeds
# ---------------------------------------------------------------------------


@register("enrich_left_joins", W(f"""SELECT {TXN_COLS}, category, CAST(cost_price_pct AS DOUBLE) AS cost_price_pct,
       region, store_format, loyalty_tier, CAST(gross_margin AS DOUBLE) AS gross_margin, month
FROM enriched"""))
def q_enrich(spark, sf):
    return out(retail.enriched(spark, sf))


@register("loyalty_semi_join", W("SELECT event_id, customer_id, event_date, event_type, points FROM loyalty"))
def q_loyalty_semi(spark, sf):
    return retail.silver_tables(spark, sf).loyalty


@register("loyalty_feed_union", W("SELECT * FROM loyalty_union"))
def q_feed_union(spark, sf):
    batch = silver.event_type_in(silver.type_table(binding.raw_loyalty_events(spark, sf), "loyalty_events"))
    return silver.union_feeds(batch, retail.typed_realtime(spark, sf))


@register("new_or_changed_anti_join", W("SELECT * FROM scd_new"))
def q_new_or_changed(spark, sf):
    day1, day2 = retail.scd2_snapshots(spark, sf)
    return scd2.new_or_changed(day2, day1, ["customer_id"], ["loyalty_tier"])


# ---------------------------------------------------------------------------
# SCD2 (C1-C4)
# ---------------------------------------------------------------------------


@register("scd2_initial", W("SELECT * FROM dim_customer"))
def q_scd2_initial(spark, sf):
    """C1 over every customer."""
    return retail.silver_tables(spark, sf).dim_customer


@register("scd2_merge", W("SELECT * FROM scd_merged"))
def q_scd2_merge(spark, sf):
    day1, day2 = retail.scd2_snapshots(spark, sf)
    return scd2.scd2_merge(day1, day2, ["customer_id"], ["loyalty_tier"], SCD2_AS_OF)


@register("scd2_current", W("SELECT * FROM scd_merged WHERE is_current"))
def q_scd2_current(spark, sf):
    return scd2.current_rows(q_scd2_merge(spark, sf))


_BACKFILL_SQL = "WITH " + O.RETAIL + """,
snapshots AS (
  SELECT customer_id, region, loyalty_tier, signup_date, email_opt_in, DATE '2024-01-01' AS as_of FROM day1
  UNION ALL SELECT *, DATE '2024-02-01' FROM day2
  UNION ALL SELECT *, DATE '2024-03-01' FROM customers),
starts AS (
  SELECT *, row_number() OVER w = 1 OR lag(loyalty_tier) OVER w <> loyalty_tier AS opens
  FROM snapshots WINDOW w AS (PARTITION BY customer_id ORDER BY as_of))
SELECT customer_id, region, loyalty_tier, signup_date, email_opt_in, as_of AS effective_from,
       lead(as_of) OVER w AS effective_to, lead(as_of) OVER w IS NULL AS is_current
FROM starts WHERE opens WINDOW w AS (PARTITION BY customer_id ORDER BY as_of)"""


@register("scd2_backfill", _BACKFILL_SQL)
def q_scd2_backfill(spark, sf):
    """Three snapshots to type 2 rows in one pass."""
    days = [(binding.customers_day1, DAY1), (binding.customers_day2, SCD2_AS_OF), (binding.raw_customers, "2024-03-01")]
    parts = [silver.conform(bind(spark, sf), "customers").withColumn("as_of", F.lit(day).cast("date"))
             for bind, day in days]
    return scd2.scd2_backfill(parts[0].unionByName(parts[1]).unionByName(parts[2]), ["customer_id"], ["loyalty_tier"])


# ---------------------------------------------------------------------------
# Gold aggregates and top-k
# ---------------------------------------------------------------------------


@register("sales_by_region_category_month", W("SELECT * FROM fact_sales"))
def q_sales(spark: SparkSession, sf: str) -> DataFrame:
    return retail.fact_sales(spark, sf)


@register("loyalty_tier_value", W("SELECT * FROM fact_tier"))
def q_tier_value(spark, sf):
    return retail.fact_tier(spark, sf)


@register("store_performance", W("SELECT * FROM fact_store"))
def q_store_performance(spark, sf):
    return retail.fact_store(spark, sf)


@register("points_liability", W("""SELECT event_type, CAST(SUM(points) AS BIGINT) AS points
FROM loyalty GROUP BY event_type"""))
def q_points(spark, sf):
    return gold.points_liability(retail.silver_tables(spark, sf).loyalty)


@register("points_liability_net", W("""SELECT event_type, CAST(SUM(points) AS BIGINT) AS points,
       GROUPING(event_type) = 1 AS is_total
FROM loyalty GROUP BY ROLLUP (event_type)"""))
def q_points_net(spark, sf):
    return gold.points_liability_net(retail.silver_tables(spark, sf).loyalty)


@register("top_stores", W("""SELECT store_id, region, revenue FROM fact_store
ORDER BY revenue DESC, store_id LIMIT 5"""))
def q_top_stores(spark, sf):
    return gold.top_stores(retail.fact_store(spark, sf), 5)


@register("store_leaderboard", W("""SELECT row_number() OVER (ORDER BY revenue DESC, store_id) AS place,
       store_id, store_format, region, revenue, gross_margin, transactions FROM fact_store"""))
def q_store_leaderboard(spark, sf):
    """O1: every store with its place by revenue."""
    return gold.ranked_stores(retail.fact_store(spark, sf))


# ---------------------------------------------------------------------------
# Data quality
# ---------------------------------------------------------------------------

_LANDING_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", count(*) AS rows, CAST(1 AS BIGINT) AS minimum, "
    f"CASE WHEN count(*) >= 1 THEN 'PASS' ELSE 'FAIL' END AS status FROM {src}"
    for t, src in [("customers", "customers"), ("products", "products"), ("stores", "stores"),
                   ("transactions", "raw_txn"), ("loyalty_events", "loy_all")])


@register("landing_row_counts", W(_LANDING_SQL))
def q_landing(spark, sf):
    tables = retail.bronze(spark, sf) | {"loyalty_events": binding.all_loyalty_events(spark, sf)}
    return dq.landing_row_counts(tables, LANDING_MINIMUMS)


def _no_ts(df: DataFrame) -> DataFrame:
    return df.drop("run_ts")


_TXN_REQUIRED = ["customer_id", "product_id", "amount"]

_SQL_COMPLETENESS = O.ratio_check(
    "completeness", "transactions",
    "count_if(customer_id IS NOT NULL AND product_id IS NOT NULL AND amount IS NOT NULL)",
    "count(*)", 0.98, f" rows complete across {_TXN_REQUIRED}", "txn")
_SQL_TXN_UNIQUE = O.ratio_check("uniqueness", "transactions", "count(DISTINCT transaction_id)",
                                "count(*)", 0.999, " unique values for transaction_id", "txn")
_SQL_TXN_RI = O.ratio_check(
    "referential_integrity", "transactions", "count_if(k.customer_id IS NOT NULL)", "count(*)", 0.99,
    " rows have a valid customer_id reference",
    "txn t LEFT JOIN (SELECT DISTINCT customer_id FROM dim_customer WHERE is_current) k "
    "ON t.customer_id = k.customer_id")
_SQL_TXN_FRESH = O.freshness_check("transactions", "transaction_date", 3650, SUITE_AS_OF, "txn")
_SQL_CUST_UNIQUE = O.ratio_check("uniqueness", "dim_customer", "count(DISTINCT customer_id)",
                                 "count(*)", 0.999, " unique values for customer_id",
                                 "(SELECT * FROM dim_customer WHERE is_current)")
_SQL_LOY_RI = O.ratio_check(
    "referential_integrity", "loyalty_events", "count_if(k.customer_id IS NOT NULL)", "count(*)", 0.99,
    " rows have a valid customer_id reference",
    "loyalty l LEFT JOIN (SELECT DISTINCT customer_id FROM dim_customer WHERE is_current) k "
    "ON l.customer_id = k.customer_id")


@register("dq_completeness", W(_SQL_COMPLETENESS))
def q_dq_completeness(spark, sf):
    s = retail.silver_tables(spark, sf)
    return _no_ts(dq.check_completeness(s.transactions, "transactions", _TXN_REQUIRED, 0.98))


@register("dq_uniqueness", W(O.ratio_check(
    "uniqueness", "bronze_transactions", "count(DISTINCT transaction_id)", "count(*)", 0.999,
    " unique values for transaction_id", "raw_txn")))
def q_dq_uniqueness(spark, sf):
    """Uniqueness before the dedupe: the raw feed repeats transaction ids."""
    return _no_ts(dq.check_uniqueness(binding.raw_transactions(spark, sf), "bronze_transactions",
                                      "transaction_id", 0.999))


_UNIQUE_LEVELS = [0.5, 0.95, 0.999]


@register("dq_uniqueness_by_version", W("\nUNION ALL\n".join(
    f"""SELECT 'uniqueness' AS check_name, '{name}' AS "table", CAST({level} AS DOUBLE) AS threshold,
       CASE WHEN count(DISTINCT {key}) >= {level} * count(*) THEN 'PASS' ELSE 'FAIL' END AS status
FROM {source}""" for name, key, source in (("bronze_transactions", "transaction_id", "raw_txn"),
                                           ("transactions", "transaction_id", "txn")) for level in _UNIQUE_LEVELS)))
def q_dq_uniqueness_by_version(spark, sf):
    """Q2/A9 from sketches stored a year of sales each: the raw feed repeats ids, the cleansed one does not."""
    year = F.coalesce(F.substring(F.col("transaction_date").cast("string"), 1, 4), F.lit("none")).alias("v")
    results = []
    for name, df in (("bronze_transactions", binding.raw_transactions(spark, sf)),
                     ("transactions", retail.silver_tables(spark, sf).transactions)):
        path = work_path(spark, "key_sketches", name, fresh=True)
        uniqueness.key_sketches(df, "transaction_id", [year]).write.partitionBy("v").parquet(path)
        stored = uniqueness.read_sketches(spark, path)
        results += [uniqueness.check_uniqueness(stored, df, name, "transaction_id", level) for level in _UNIQUE_LEVELS]
    return dq.run_suite(results)[0].select("check_name", "table", "threshold", "status")


@register("dq_referential_integrity", W(O.ratio_check(
    "referential_integrity", "loyalty_events_unfiltered", "count_if(k.customer_id IS NOT NULL)",
    "count(*)", 0.99, " rows have a valid customer_id reference",
    "loyalty_union l LEFT JOIN (SELECT DISTINCT customer_id FROM dim_customer WHERE is_current) k "
    "ON l.customer_id = k.customer_id")))
def q_dq_ri(spark, sf):
    """Integrity of the unioned loyalty feed before the integrity filter."""
    s = retail.silver_tables(spark, sf)
    union = q_feed_union(spark, sf)
    bound = retail.dim_bounds(spark, sf)["customers"]
    return _no_ts(dq.evaluate(union, "loyalty_events_unfiltered", [dq.referential_integrity(
        "customer_id", s.current_customers.select("customer_id"), 0.99, key_rows=bound)]))


@register("dq_freshness", W(_SQL_TXN_FRESH))
def q_dq_freshness(spark, sf):
    s = retail.silver_tables(spark, sf)
    return _no_ts(dq.check_freshness(s.transactions, "transactions", "transaction_date", 3650,
                                     as_of=SUITE_AS_OF))


@register("dq_suite", W("\nUNION ALL\n".join([_SQL_COMPLETENESS, _SQL_TXN_UNIQUE, _SQL_TXN_RI,
                                              _SQL_TXN_FRESH, _SQL_CUST_UNIQUE, _SQL_LOY_RI])))
def q_dq_suite(spark, sf):
    s = retail.silver_tables(spark, sf)
    return _no_ts(dq.silver_suite(s.transactions, s.dim_customer, s.loyalty, SUITE_AS_OF,
                                  customer_rows=retail.dim_bounds(spark, sf)["customers"]))


@register("dq_failed", W("SELECT * FROM (" + "\nUNION ALL\n".join([
    _SQL_COMPLETENESS, _SQL_TXN_UNIQUE, _SQL_TXN_RI, _SQL_TXN_FRESH, _SQL_CUST_UNIQUE, _SQL_LOY_RI,
    O.ratio_check("uniqueness", "bronze_transactions", "count(DISTINCT transaction_id)", "count(*)", 0.999,
                  " unique values for transaction_id", "raw_txn")]) + ") WHERE status = 'FAIL'"))
def q_dq_failed(spark, sf):
    """Q6/Q8: the failed split of the suite with the raw feed's uniqueness, which the gate would raise on."""
    raw = dq.check_uniqueness(binding.raw_transactions(spark, sf), "bronze_transactions", "transaction_id", 0.999)
    return dq.run_suite([q_dq_suite(spark, sf), _no_ts(raw)])[1]


_SQL_RUNS = """(SELECT *, 'silver' AS run_id FROM (""" + "\nUNION ALL\n".join([
    _SQL_COMPLETENESS, _SQL_TXN_UNIQUE, _SQL_TXN_RI, _SQL_TXN_FRESH, _SQL_CUST_UNIQUE, _SQL_LOY_RI]) + """)
UNION ALL SELECT *, 'bronze' AS run_id FROM (""" + O.ratio_check(
    "uniqueness", "bronze_transactions", "count(DISTINCT transaction_id)", "count(*)", 0.999,
    " unique values for transaction_id", "raw_txn") + "))"


def _stored_runs(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """Two runs appended to one results table: the Silver suite, and the raw feed's uniqueness."""
    path = work_path(spark, name, fresh=True)
    dq.store_results(_no_ts(dq.check_uniqueness(binding.raw_transactions(spark, sf), "bronze_transactions",
                                                "transaction_id", 0.999)), path, SUITE_AS_OF, "bronze")
    dq.store_results(q_dq_suite(spark, sf), path, SUITE_AS_OF, "silver")
    return spark.read.parquet(path)


@register("dq_results_stored", W(f"SELECT *, '{SUITE_AS_OF}' AS run_as_of FROM {_SQL_RUNS}"))
def q_dq_results_stored(spark, sf):
    return _stored_runs(spark, sf, "dq-results")


@register("dq_gate_history", W(f"""SELECT run_id, '{SUITE_AS_OF}' AS run_as_of, count(*) AS checks,
       count(*) FILTER (status = 'FAIL') AS failed, count(*) FILTER (status = 'FAIL') > 0 AS blocked
FROM {_SQL_RUNS} GROUP BY run_id"""))
def q_dq_gate_history(spark, sf):
    return dq.gate_history(_stored_runs(spark, sf, "dq-gate"))


@register("dq_pass_rate", W("""SELECT 'pass_rate' AS check_name, 'transactions' AS "table",
       CASE WHEN score >= 0.95 THEN 'PASS' ELSE 'FAIL' END AS status, round(score, 4) AS metric_value,
       CAST(0.95 AS DOUBLE) AS threshold,
       format('{:,} clean / {:,} total ({:,} rejected)', clean, total, total - clean) AS detail
FROM (SELECT clean, total, coalesce(CAST(clean AS DOUBLE) / NULLIF(CAST(total AS DOUBLE), 0), 0.0) AS score
      FROM (SELECT (SELECT count(*) FROM txn) AS clean, count(*) AS total FROM raw_txn))"""))
def q_dq_pass_rate(spark, sf):
    acc = silver.reject_accounting(binding.raw_transactions(spark, sf))
    return _no_ts(dq.check_pass_rate(acc, "transactions", 0.95))


# ---------------------------------------------------------------------------
# Semantic model (H1-H9)
# ---------------------------------------------------------------------------


MONEY_SUM = "CAST(SUM(CAST({c} AS DECIMAL(38,2))) AS DOUBLE)"
REV = MONEY_SUM.format(c="revenue")
GM = MONEY_SUM.format(c="gross_margin")


@register("total_revenue", W(f"SELECT region, {REV} AS total_revenue FROM fact_sales GROUP BY region"))
def q_total_revenue(spark, sf):
    return semantic.total_revenue(retail.fact_sales(spark, sf), ["region"])


@register("gross_margin_pct", W(f"""SELECT category, {GM} / NULLIF({REV}, 0) AS gross_margin_pct
FROM fact_sales GROUP BY category"""))
def q_gm_pct(spark, sf):
    return semantic.gross_margin_pct(retail.fact_sales(spark, sf), ["category"])


@register("revenue_per_transaction", W(f"""SELECT month,
       {REV} / NULLIF(CAST(CAST(SUM(transactions) AS BIGINT) AS DOUBLE), 0) AS revenue_per_transaction
FROM fact_sales GROUP BY month"""))
def q_rev_per_tx(spark, sf):
    return semantic.revenue_per_transaction(retail.fact_sales(spark, sf), ["month"])


@register("yoy_revenue_growth", W("""SELECT month, region, revenue, prior_year_revenue,
       (revenue - prior_year_revenue) / NULLIF(prior_year_revenue, 0) AS yoy_revenue_growth
FROM (
  SELECT coalesce(c.month, p.month) AS month, coalesce(c.region, p.region) AS region,
         CAST(coalesce(c.cur, 0) AS DOUBLE) AS revenue, CAST(p.prior AS DOUBLE) AS prior_year_revenue
  FROM (SELECT month, region, SUM(CAST(revenue AS DECIMAL(38,2))) AS cur FROM fact_sales GROUP BY month, region) c
  FULL OUTER JOIN (
    SELECT strftime(CAST(month || '-01' AS DATE) + INTERVAL 12 MONTH, '%Y-%m') AS month, region,
           SUM(CAST(revenue AS DECIMAL(38,2))) AS prior
    FROM fact_sales GROUP BY month, region) p
  ON c.month = p.month AND c.region IS NOT DISTINCT FROM p.region)
WHERE month IN (SELECT month FROM month_dim)"""))
def q_yoy(spark, sf):
    fact = retail.sales_at(spark, sf, ["month", "region"])
    return semantic.yoy_revenue_growth(fact, semantic.dim_date_of_months(fact), ["region"])


@register("avg_revenue_per_store", W(f"""SELECT store_format,
       {REV} / NULLIF(CAST(count(revenue) AS DOUBLE), 0) AS avg_revenue_per_store
FROM fact_store GROUP BY store_format"""))
def q_avg_rev_store(spark, sf):
    return semantic.avg_revenue_per_store(retail.fact_store(spark, sf), ["store_format"])


@register("revenue_per_customer", W(f"""SELECT loyalty_tier,
       {REV} / NULLIF(CAST(CAST(SUM(customers) AS BIGINT) AS DOUBLE), 0) AS revenue_per_customer
FROM fact_tier GROUP BY loyalty_tier"""))
def q_rev_per_cust(spark, sf):
    return semantic.revenue_per_customer(retail.fact_tier(spark, sf), ["loyalty_tier"])


@register("dim_date", W("SELECT * FROM dim_date"))
def q_dim_date(spark, sf):
    return semantic.dim_date(retail.silver_tables(spark, sf).transactions)


@register("calendar_rollup", W(f"""SELECT year, quarter, month, {REV} AS revenue,
       CAST(GROUPING(year, quarter, month) AS BIGINT) AS level
FROM fact_sales LEFT JOIN month_dim USING (month) GROUP BY ROLLUP (year, quarter, month)"""))
def q_calendar_rollup(spark, sf):
    fact = retail.sales_at(spark, sf, ["month"])
    return semantic.calendar_rollup(fact, semantic.dim_date_of_months(fact))


def _model(spark, sf) -> model.Model:
    """The sales fact and its dates; other facts are added by the queries that need them."""
    sales = retail.fact_sales(spark, sf)
    return model.Model({"fact_sales": sales, "dim_date": semantic.dim_date(
        retail.silver_tables(spark, sf).transactions)})


def _plain(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: c.split(".")[-1] for c in df.columns})


@register("measures_by_quarter_under_years", W(f"""SELECT quarter, region, {REV} AS total_revenue,
       {GM} / NULLIF({REV}, 0) AS gross_margin_pct,
       {REV} / NULLIF(CAST(CAST(SUM(transactions) AS BIGINT) AS DOUBLE), 0) AS revenue_per_transaction
FROM fact_sales JOIN month_dim USING (month) WHERE year IN (1995, 1996) GROUP BY quarter, region"""))
def q_measures_by_quarter(spark, sf):
    """Three measures by a column of the date table and one of the fact, under a filter on the date table."""
    return _plain(_model(spark, sf).evaluate(
        ["total_revenue", "gross_margin_pct", "revenue_per_transaction"],
        ["dim_date.quarter", "fact_sales.region"], {"dim_date.year": lambda y: y.isin(1995, 1996)}))


@register("yoy_by_quarter_under_year", W("""SELECT quarter, revenue, prior_year_revenue,
       (revenue - prior_year_revenue) / NULLIF(prior_year_revenue, 0) AS yoy_revenue_growth
FROM (
  SELECT quarter, coalesce(CAST(SUM(CAST(revenue AS DECIMAL(38,2))) FILTER (NOT moved) AS DOUBLE), 0.0) AS revenue,
         CAST(SUM(CAST(revenue AS DECIMAL(38,2))) FILTER (moved) AS DOUBLE) AS prior_year_revenue
  FROM (SELECT month, revenue, FALSE AS moved FROM fact_sales
        UNION ALL
        SELECT strftime(CAST(month || '-01' AS DATE) + INTERVAL 12 MONTH, '%Y-%m'), revenue, TRUE FROM fact_sales)
  JOIN month_dim USING (month) WHERE year = 1996 GROUP BY quarter)"""))
def q_yoy_by_quarter(spark, sf):
    """J9 + J10: the prior year moves with the filter: under 1996 it is 1995."""
    return _plain(_model(spark, sf).evaluate(["yoy_revenue_growth"], ["dim_date.quarter"],
                                             {"dim_date.year": lambda y: y == 1996}))


@register("measures_across_facts", W(f"""SELECT s.total_revenue, a.avg_revenue_per_store, t.revenue_per_customer
FROM (SELECT {REV} AS total_revenue FROM fact_sales
      WHERE month IN (SELECT month FROM dim_date WHERE date >= DATE '1996-03-15' AND date < DATE '1996-06-02')) s,
     (SELECT {REV} / NULLIF(CAST(count(revenue) AS DOUBLE), 0) AS avg_revenue_per_store FROM fact_store) a,
     (SELECT {REV} / NULLIF(CAST(CAST(SUM(customers) AS BIGINT) AS DOUBLE), 0) AS revenue_per_customer
      FROM fact_tier) t"""))
def q_measures_across_facts(spark, sf):
    """A filter on days passes on their months to fact_sales and does not reach facts without a date."""
    m = _model(spark, sf)
    m.tables |= {"fact_store_performance": retail.fact_store(spark, sf),
                 "fact_loyalty_tier_value": retail.fact_tier(spark, sf)}
    return m.evaluate(["total_revenue", "avg_revenue_per_store", "revenue_per_customer"], where={
        "dim_date.date": lambda d: (d >= F.lit("1996-03-15").cast("date")) & (d < F.lit("1996-06-02").cast("date"))})


@register("executive_summary", W(f"""
SELECT 'Total Revenue' AS measure, {REV} AS value FROM fact_sales
UNION ALL SELECT 'Gross Margin %', {GM} / NULLIF({REV}, 0) FROM fact_sales
UNION ALL SELECT 'Revenue per Transaction',
       {REV} / NULLIF(CAST(CAST(SUM(transactions) AS BIGINT) AS DOUBLE), 0) FROM fact_sales
UNION ALL SELECT 'Revenue per Loyalty Customer',
       {REV} / NULLIF(CAST(CAST(SUM(customers) AS BIGINT) AS DOUBLE), 0) FROM fact_tier"""))
def q_exec_summary(spark, sf):
    return semantic.executive_summary(retail.sales_total(spark, sf), retail.fact_tier(spark, sf))


@register("store_operations", W(f"""SELECT region, store_format, count(*) AS stores, {REV} AS revenue,
       {REV} / NULLIF(CAST(count(revenue) AS DOUBLE), 0) AS avg_revenue_per_store,
       {GM} / NULLIF({REV}, 0) AS gross_margin_pct
FROM fact_store GROUP BY region, store_format"""))
def q_store_ops(spark, sf):
    return semantic.store_operations(retail.fact_store(spark, sf))


# ---------------------------------------------------------------------------
# Operations logs, alerts, storage
# ---------------------------------------------------------------------------

SINCE = ("TimeGenerated > TIMESTAMP '" + LOG_AS_OF + "' - INTERVAL {d} DAY"
         " AND TimeGenerated <= TIMESTAMP '" + LOG_AS_OF + "'")


@register("run_history", L(f"""SELECT TimeGenerated, Status, Start, "End",
       (epoch_us("End") - epoch_us(Start)) // 1000 AS DurationMs
FROM runs WHERE {SINCE.format(d=7)} AND PipelineName = 'pl_medallion_refresh'"""))
def q_run_history(spark, sf):
    return oplog.run_history(binding.pipeline_runs(spark, sf), LOG_AS_OF)


@register("failures_by_activity", L(f"""SELECT ActivityName, count(*) AS FailureCount FROM activities
WHERE {SINCE.format(d=30)} AND PipelineName = 'pl_medallion_refresh' AND Status = 'Failed'
GROUP BY ActivityName"""))
def q_failures(spark, sf):
    return oplog.failures_by_activity(binding.activity_runs(spark, sf), LOG_AS_OF)


@register("duration_trend", L(f"""SELECT CAST(CAST(TimeGenerated AS DATE) AS TIMESTAMP) AS TimeGenerated,
       CAST(SUM(CAST(DurationMinutes AS DECIMAL(38,12))) AS DOUBLE) / count(DurationMinutes) AS AvgDurationMin,
       max(DurationMinutes) AS MaxDurationMin
FROM jobs WHERE {SINCE.format(d=30)} AND JobName = 'medallion_daily_refresh'
GROUP BY 1"""))
def q_duration(spark, sf):
    return oplog.duration_trend(binding.job_runs(spark, sf), LOG_AS_OF)


@register("volume_by_path_segment", L(f"""SELECT coalesce(split(Uri, '/')[4], '') AS Uri,
       count(*) AS TransactionCount, CAST(sum(ResponseBodySize) AS BIGINT) AS TotalBytes
FROM blobs WHERE {SINCE.format(d=30)} GROUP BY 1"""))
def q_volume(spark, sf):
    return oplog.volume_by_path_segment(binding.blob_logs(spark, sf), LOG_AS_OF)


@register("daily_usage", L(f"""SELECT CAST(CAST(TimeGenerated AS DATE) AS TIMESTAMP) AS TimeGenerated,
       CAST(SUM(CAST(Total AS DECIMAL(38,12))) AS DOUBLE) AS DailyDBUs
FROM metrics WHERE {SINCE.format(d=30)} AND ResourceProvider = 'MICROSOFT.DATABRICKS'
  AND MetricName = 'DBUUsage' GROUP BY 1"""))
def q_daily_usage(spark, sf):
    return oplog.daily_usage(binding.azure_metrics(spark, sf), LOG_AS_OF)


def _register_day_log(key: str, log, ask) -> None:
    """A log query over the same log laid out by day; its SQL twin is that of the plain query."""
    @register(f"{key}_day_log", ORACLES[key])
    def over_day_log(spark, sf):
        rows = log(spark, sf)
        path = work_path(spark, "day_logs", key, fresh=True)
        files.write_day_log(rows, path)
        return ask(files.read_day_log(spark, path, rows.schema), LOG_AS_OF)


for _key, _log, _ask in [("run_history", binding.pipeline_runs, oplog.run_history),
                         ("failures_by_activity", binding.activity_runs, oplog.failures_by_activity),
                         ("duration_trend", binding.job_runs, oplog.duration_trend),
                         ("volume_by_path_segment", binding.blob_logs, oplog.volume_by_path_segment),
                         ("daily_usage", binding.azure_metrics, oplog.daily_usage)]:
    _register_day_log(_key, _log, _ask)


def _alert_sql(src: str, pred: str, minutes: int, alert: str, severity: int) -> str:
    return L(f"""SELECT time_bucket(INTERVAL {minutes} MINUTE, TimeGenerated) AS window_start,
       time_bucket(INTERVAL {minutes} MINUTE, TimeGenerated) + INTERVAL {minutes} MINUTE AS window_end,
       '{alert}' AS alert, {severity} AS severity, count(*) AS hits
FROM {src} WHERE {pred} GROUP BY 1, 2""")


@register("alert_failed_runs", _alert_sql(
    "runs", "Status = 'Failed' AND PipelineName = 'pl_medallion_refresh'", 15, "pipeline_failure", 1))
def q_alert_failed(spark, sf):
    return oplog.alert_failed_runs(binding.pipeline_runs(spark, sf))


@register("alert_gate_failed", _alert_sql(
    "activities", "ActivityName = 'run_dq_suite_gate' AND Status = 'Failed'", 15, "dq_gate_failure", 2))
def q_alert_gate(spark, sf):
    return oplog.alert_gate_failed(binding.activity_runs(spark, sf))


@register("alert_runtime", _alert_sql(
    "jobs", "JobName = 'medallion_daily_refresh' AND DurationMinutes > 90", 30, "runtime_exceeded", 3))
def q_alert_runtime(spark, sf):
    return oplog.alert_runtime(binding.job_runs(spark, sf))


_TIER_SQL = f"""tiers AS (
  SELECT path, size_gb, age_days,
         CASE WHEN is_version AND (path LIKE 'bronze/%' OR path LIKE 'silver/%' OR path LIKE 'gold/%')
                   AND age_days > 90 THEN 'delete'
              WHEN is_version THEN 'hot'
              WHEN path LIKE 'bronze/%' AND age_days > 730 THEN 'delete'
              WHEN path LIKE 'bronze/%' AND age_days > 90 THEN 'archive'
              WHEN path LIKE 'bronze/%' AND age_days > 30 THEN 'cool'
              ELSE 'hot' END AS tier
  FROM (SELECT *, CAST(date_diff('day', CAST(modified AS DATE), DATE '{STORAGE_AS_OF}') AS INTEGER) AS age_days
        FROM inventory))"""


@register("storage_tiers", "WITH " + O.LOGS + ",\n" + _TIER_SQL + "\nSELECT * FROM tiers")
def q_storage_tiers(spark, sf):
    return oplog.storage_tiers(binding.object_inventory(spark, sf), STORAGE_AS_OF)


@register("storage_cost", "WITH " + O.LOGS + ",\n" + _TIER_SQL + """
SELECT tier, count(*) AS objects, CAST(SUM(CAST(size_gb AS DECIMAL(20,6))) AS DOUBLE) AS size_gb,
       CAST(SUM(CAST(size_gb AS DECIMAL(20,6)) * CASE tier WHEN 'hot' THEN 0.38 WHEN 'cool' THEN 0.21
            WHEN 'archive' THEN 0.04 ELSE 0.00 END) AS DOUBLE) AS cost_tiered,
       CAST(SUM(CAST(size_gb AS DECIMAL(20,6)) * 0.38) AS DOUBLE) AS cost_all_hot
FROM tiers GROUP BY tier""")
def q_storage_cost(spark, sf):
    return oplog.storage_cost(q_storage_tiers(spark, sf))


# ---------------------------------------------------------------------------
# Streaming (T1-T4): each drains its source with availableNow into a parquet
# sink under the shared checkpoint folder, then reads the sink back.
# ---------------------------------------------------------------------------


STREAM_DELAY = "10 minutes"


def _events_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = binding.read(spark, sf, "events").schema
    return file_ingest.stream_table(spark, binding.path(sf, "events"), schema)


def _drain(spark: SparkSession, df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    root = work_path(spark, "streams", name, fresh=True)
    realtime.run_to_sink(df, f"{root}/out", f"{root}/_checkpoint", mode)
    return spark.read.schema(df.schema).parquet(f"{root}/out")


@register("bronze_file_stream", W("""SELECT transaction_id, NULLIF(customer_id, '') AS customer_id,
       product_id, store_id, CAST(transaction_date AS VARCHAR) AS transaction_date,
       CASE WHEN quantity = -1 THEN '-1' ELSE CAST(CAST(quantity AS DOUBLE) AS VARCHAR) END AS quantity,
       CAST(CAST(amount AS DOUBLE) AS VARCHAR) AS amount, payment_method
FROM raw_txn"""))
def q_bronze_stream(spark, sf):
    """Land the transactions extract as CSV, drain it into Bronze.

    The CSV reader reads an empty field as NULL, which the present-key rule
    rejects like the empty string.
    """
    root = work_path(spark, "landing_run", fresh=True)
    landing = f"{root}/landing"
    # part of the files lie below the landing folder's top level, as a daily drop may
    files.export_csv(binding.raw_transactions(spark, sf), f"{landing}/transactions/daily")
    file_ingest.ingest_table(spark, landing, "transactions", f"{root}/bronze/transactions",
                             f"{root}/_checkpoints/transactions")
    return silver.well_formed(silver.drop_stamps(spark.read.parquet(f"{root}/bronze/transactions")))


_RT_SQL = W("""SELECT event_id, customer_id, CAST(event_date AS VARCHAR) AS event_date, event_type,
       CAST(points AS VARCHAR) AS points
FROM loy_all WHERE event_type IN ('earn', 'redeem', 'expire')""")


def _realtime_bronze(spark: SparkSession, events: DataFrame, name: str) -> DataFrame:
    """Drop loyalty events as JSON files and drain them through the realtime leg."""
    drop = work_path(spark, "json_events", name, fresh=True)
    events.write.json(drop)
    leg = realtime.realtime_leg(realtime.json_source(spark, drop))
    return silver.drop_stamps(_drain(spark, leg, name))


@register("realtime_leg", _RT_SQL)
def q_realtime_leg(spark, sf):
    """JSON events stream -> accepted types -> stamp -> append, over all events."""
    return _realtime_bronze(spark, binding.all_loyalty_events(spark, sf), "realtime_leg")


@register("stream_batch_union", W("SELECT * FROM loyalty_union"))
def q_stream_batch_union(spark, sf):
    """Realtime Bronze from the JSON stream, unioned with the batch feed, once per event."""
    rt = _realtime_bronze(spark, binding.raw_loyalty_realtime(spark, sf), "stream_batch_union")
    batch = silver.event_type_in(silver.type_table(binding.raw_loyalty_events(spark, sf), "loyalty_events"))
    return silver.union_feeds(batch, silver.type_table(rt, "loyalty_events"))


_DAMAGE = """CASE WHEN CAST(event_id AS BIGINT) % 11 = 3 THEN 'malformed' WHEN CAST(event_id AS BIGINT) % 11 = 5 THEN 'keyless'
            WHEN event_type IN ('earn', 'redeem', 'expire') THEN 'kept' ELSE 'event_type' END"""


def _damaged_lines(events: DataFrame) -> DataFrame:
    """Events as JSON lines, some broken off and some without their key."""
    number = F.col("event_id").cast("bigint") % 11
    whole = F.to_json(F.struct(*events.columns))
    keyless = F.to_json(F.struct(*[c for c in events.columns if c != "event_id"]))
    return events.select(F.when(number == 3, F.substring(whole, F.lit(1), F.length(whole) - 4))
                         .when(number == 5, keyless).otherwise(whole).alias("value"))


def _checked(spark: SparkSession, sf: str, name: str) -> tuple[str, str]:
    root = work_path(spark, "streams", name, fresh=True)
    _damaged_lines(binding.all_loyalty_events(spark, sf)).write.text(f"{root}/drop")
    realtime.run_checked(realtime.text_source(spark, f"{root}/drop"), f"{root}/bronze", f"{root}/quarantine",
                         f"{root}/_checkpoint")
    return f"{root}/bronze", f"{root}/quarantine"


@register("realtime_checked", W(f"""SELECT event_id, customer_id, CAST(event_date AS VARCHAR) AS event_date, event_type,
       CAST(points AS VARCHAR) AS points
FROM loy_all WHERE {_DAMAGE} = 'kept'"""))
def q_realtime_checked(spark, sf):
    """What the checked leg keeps of lines of which some are damaged."""
    bronze, _ = _checked(spark, sf, "realtime_checked")
    return silver.drop_stamps(spark.read.parquet(bronze))


@register("realtime_quarantine", W(f"""SELECT {_DAMAGE} AS outcome, count(*) AS events
FROM loy_all GROUP BY 1"""))
def q_realtime_quarantine(spark, sf):
    """Every event is counted as kept or under the reason of its refusal."""
    return realtime.checked_accounting(spark, *_checked(spark, sf, "realtime_quarantine"))


def _alerts(spark: SparkSession, log: DataFrame, predicate, window: str, alert: str, severity: int) -> DataFrame:
    """T4: drain an alert stream; every window that fires comes out."""
    root = work_path(spark, "streams", alert, fresh=True)
    fired = realtime.window_alerts(log, predicate, F.col("TimeGenerated").cast("timestamp"), window,
                                   STREAM_DELAY, alert, severity)
    realtime.drain_updates(fired, f"{root}/out", f"{root}/_checkpoint")
    return realtime.latest_updates(spark, f"{root}/out", fired.schema, ["window_start", "window_end"])


@register("alert_stream", _alert_sql(
    "runs", "Status = 'Failed' AND PipelineName = 'pl_medallion_refresh'", 15, "pipeline_failure", 1))
def q_alert_stream(spark, sf):
    """T4 for L6, against the batch alert."""
    return _alerts(spark, binding.runs_from_events(_events_stream(spark, sf)),
                   (F.col("Status") == "Failed") & (F.col("PipelineName") == oplog.PIPELINE),
                   "15 minutes", "pipeline_failure", 1)


@register("alert_gate_stream", _alert_sql(
    "activities", "ActivityName = 'run_dq_suite_gate' AND Status = 'Failed'", 15, "dq_gate_failure", 2))
def q_alert_gate_stream(spark, sf):
    """T4 for L7, against the batch alert."""
    return _alerts(spark, binding.activities_from_events(_events_stream(spark, sf)),
                   (F.col("ActivityName") == oplog.GATE_ACTIVITY) & (F.col("Status") == "Failed"),
                   "15 minutes", "dq_gate_failure", 2)


# ---------------------------------------------------------------------------
# Model defaults and cost summary (H10, L10 summary)
# ---------------------------------------------------------------------------


@register("fact_sales_default_summary", W("""SELECT region, CAST(SUM(CAST(revenue AS DECIMAL(38,2))) AS DOUBLE) AS revenue,
       CAST(SUM(units) AS BIGINT) AS units,
       CAST(SUM(CAST(gross_margin AS DECIMAL(38,2))) AS DOUBLE) AS gross_margin,
       CAST(SUM(transactions) AS BIGINT) AS transactions
FROM fact_sales GROUP BY region"""))
def q_default_summary(spark, sf):
    """Every sum-by-default column of fact_sales, under region."""
    return semantic.default_summary(retail.fact_sales(spark, sf), "fact_sales", ["region"])


@register("store_default_summary", W("""SELECT region, CAST(SUM(CAST(revenue AS DECIMAL(38,2))) AS DOUBLE) AS revenue,
       CAST(SUM(CAST(gross_margin AS DECIMAL(38,2))) AS DOUBLE) AS gross_margin
FROM fact_store GROUP BY region"""))
def q_store_default_summary(spark, sf):
    """Sum-by-default columns of fact_store_performance, under region."""
    return semantic.default_summary(retail.fact_store(spark, sf), "fact_store_performance", ["region"])


@register("tier_default_summary", W("""SELECT loyalty_tier, CAST(SUM(customers) AS BIGINT) AS customers,
       CAST(SUM(CAST(revenue AS DECIMAL(38,2))) AS DOUBLE) AS revenue
FROM fact_tier GROUP BY loyalty_tier"""))
def q_tier_default_summary(spark, sf):
    """Sum-by-default columns of fact_loyalty_tier_value, under the tier."""
    return semantic.default_summary(retail.fact_tier(spark, sf), "fact_loyalty_tier_value", ["loyalty_tier"])


@register("storage_saving", "WITH " + O.LOGS + ",\n" + _TIER_SQL + """,
cost AS (
  SELECT tier, CAST(SUM(CAST(size_gb AS DECIMAL(20,6)) * CASE tier WHEN 'hot' THEN 0.38 WHEN 'cool' THEN 0.21
              WHEN 'archive' THEN 0.04 ELSE 0.00 END) AS DOUBLE) AS cost_tiered,
         CAST(SUM(CAST(size_gb AS DECIMAL(20,6)) * 0.38) AS DOUBLE) AS cost_all_hot
  FROM tiers GROUP BY tier)
SELECT cost_tiered, cost_all_hot, (cost_all_hot - cost_tiered) / NULLIF(cost_all_hot, 0) AS saving_pct
FROM (SELECT CAST(SUM(CAST(cost_tiered AS DECIMAL(38,6))) AS DOUBLE) AS cost_tiered,
             CAST(SUM(CAST(cost_all_hot AS DECIMAL(38,6))) AS DOUBLE) AS cost_all_hot FROM cost)""")
def q_storage_saving(spark, sf):
    """Tiered against all-hot monthly cost and the saving share."""
    return oplog.storage_saving(q_storage_cost(spark, sf))


@register("alert_runtime_stream", _alert_sql(
    "jobs", "JobName = 'medallion_daily_refresh' AND DurationMinutes > 90", 30, "runtime_exceeded", 3))
def q_alert_runtime_stream(spark, sf):
    """T4 for L8: job runs over 90 minutes, 30-minute windows, as a stream."""
    return _alerts(spark, binding.jobs_from_events(_events_stream(spark, sf)),
                   (F.col("JobName") == oplog.JOB) & (F.col("DurationMinutes") > oplog.RUNTIME_LIMIT_MIN),
                   "30 minutes", "runtime_exceeded", 3)
