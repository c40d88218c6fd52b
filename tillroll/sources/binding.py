"""Bind the driver's test tables to the retail and log tables.

Each function reads whole tables and maps columns; nothing is filtered away
except where a table is defined as an extract of a time range or account
state (the SCD2 snapshots, the batch/realtime loyalty legs). The mapped
values are deterministic so that the DuckDB oracles can rebuild them.

Raw tables come out exactly as the CSV reader would give them: every column
is text. Silver does the typing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.joins import bounded_broadcast, source_rows, source_rows_many, spread

# Fixed values of the retail domain (must stay as written).
LOYALTY_TIERS = ["Bronze", "Silver", "Gold", "Platinum"]
PAYMENT_METHODS = ["Card", "Cash", "Loyalty Points", "Mobile Wallet"]
STORE_FORMATS = ["Flagship", "Mall", "Standalone", "Express"]
LOYALTY_EVENT_TYPES = ["earn", "redeem", "expire"]
PIPELINE_NAME = "pl_medallion_refresh"
OTHER_PIPELINE = "pl_customer_sync"
PIPELINE_ACTIVITIES = [
    "copy_source_extracts_to_landing",
    "validate_landing_row_counts",
    "trigger_databricks_medallion_job",
    "run_dq_suite_gate",
]
JOB_NAME = "medallion_daily_refresh"
OTHER_JOB = "customer_sync"

# Share cut points on a 0-99 (or 0-19) bucket, in the order of the lists above.
TIER_CUTS = (45, 75, 93)          # 45% / 30% / 18% / 7%
PAYMENT_CUTS = (11, 15, 17)       # of 20: 55% / 20% / 10% / 15%
FORMAT_CUTS = (1, 9, 16)          # of 20: 5% / 40% / 35% / 20%
# Dirt injected into transactions, keyed on the product so that rows sharing
# a transaction id differ in dirt (filter-before-dedupe is then observable).
DIRTY_QTY_BUCKET = 3
DIRTY_CUSTOMER_BUCKET = 7
DIRT_MODULUS = 250
# Loyalty feeds: the batch extract ends, the realtime leg starts (overlap).
BATCH_CUTOFF = "2024-01-20 00:00:00"
REALTIME_START = "2024-01-15 00:00:00"
# Customer snapshots for the SCD2 merge.
DAY2_BALANCE_CUTS = (4500.0, 7500.0, 8700.0)


# Tables with a fixed size at every scale (25 nations, 5 regions).
FIXED_SIZE = {"nation", "region"}


def path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of a driver table."""
    df = spark.read.parquet(path(sf_dir, name))
    return df if name in FIXED_SIZE else spread(df, spark)


def row_bound(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Proven upper bound on rows of anything derived 1:1 from a table."""
    return source_rows(spark, path(sf_dir, name))


def _bucketed(bucket: Column, cuts: tuple, labels: list[str]) -> Column:
    expr = F.when(bucket < cuts[0], labels[0])
    for cut, label in zip(cuts[1:], labels[1:]):
        expr = expr.when(bucket < cut, label)
    return expr.otherwise(labels[len(cuts)])


def _s(c: Column) -> Column:
    return c.cast("string")


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation -> region name; broadcast behind the tables' row counts."""
    rows = source_rows_many(spark, {n: path(sf_dir, n) for n in sorted(FIXED_SIZE)})
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    region = bounded_broadcast(region, rows["region"])
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")
    return bounded_broadcast(geo, rows["nation"])


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x orders -> POS line items (text columns)."""
    li = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_shipdate")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(orders, li.l_orderkey == orders.o_orderkey, "left")
    dirt = F.col("l_partkey") % DIRT_MODULUS
    return j.select(
        F.concat_ws("-", _s(F.col("l_orderkey")), _s(F.col("l_linenumber"))).alias("transaction_id"),
        F.when(dirt == DIRTY_CUSTOMER_BUCKET, F.lit("")).otherwise(_s(F.col("o_custkey"))).alias("customer_id"),
        _s(F.col("l_partkey")).alias("product_id"),
        _s(F.col("l_suppkey")).alias("store_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("transaction_date"),
        F.when(dirt == DIRTY_QTY_BUCKET, F.lit("-1")).otherwise(_s(F.col("l_quantity"))).alias("quantity"),
        _s(F.col("l_extendedprice")).alias("amount"),
        _bucketed(F.col("l_orderkey") % 20, PAYMENT_CUTS, PAYMENT_METHODS).alias("payment_method"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice")
    return part.select(
        _s(F.col("p_partkey")).alias("product_id"),
        F.col("p_type").alias("category"),
        _s(F.col("p_retailprice")).alias("unit_price"),
        F.concat(F.lit("0."), _s(F.lit(45) + F.col("p_partkey") % 31)).alias("cost_price_pct"),
    )


def raw_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = sup.join(_geo(spark, sf_dir), sup.s_nationkey == F.col("n_nationkey"), "left")
    return j.select(
        _s(F.col("s_suppkey")).alias("store_id"),
        F.col("r_name").alias("region"),
        _bucketed(F.col("s_suppkey") % 20, FORMAT_CUTS, STORE_FORMATS).alias("store_format"),
    )


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return cust.join(_geo(spark, sf_dir), cust.c_nationkey == F.col("n_nationkey"), "left")


def _customer_cols(tier: Column) -> list[Column]:
    return [
        _s(F.col("c_custkey")).alias("customer_id"),
        F.col("r_name").alias("region"),
        tier.alias("loyalty_tier"),
        F.date_format(F.date_sub(F.lit("2023-01-01").cast("date"),
                                 (F.col("c_custkey") % 730).cast("int")), "yyyy-MM-dd").alias("signup_date"),
        F.when(F.col("c_acctbal") >= 2500, F.lit("true")).otherwise(F.lit("false")).alias("email_opt_in"),
    ]


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers; tier from a key bucket at the generator's shares."""
    tier = _bucketed(F.col("c_custkey") % 100, TIER_CUTS, LOYALTY_TIERS)
    return _customers(spark, sf_dir).select(*_customer_cols(tier))


def customers_day1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First customer extract: accounts in good standing (balance >= 0)."""
    return (_customers(spark, sf_dir).filter(F.col("c_acctbal") >= 0)
            .select(*_customer_cols(_bucketed(F.col("c_custkey") % 100, TIER_CUTS, LOYALTY_TIERS))))


def customers_day2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second extract: balance under 9000, tiers re-evaluated on balance.

    Against day 1 this yields unchanged, re-tiered, new (negative balance)
    and vanished (balance >= 9000) customers over the whole table.
    """
    tier = _bucketed(F.col("c_acctbal"), DAY2_BALANCE_CUTS, LOYALTY_TIERS)
    return (_customers(spark, sf_dir).filter(F.col("c_acctbal") < 9000)
            .select(*_customer_cols(tier)))


def _loyalty(events: DataFrame, keep: tuple = ()) -> DataFrame:
    etype = (F.when(F.col("event_type").isin("purchase", "view"), F.lit("earn"))
             .when(F.col("event_type") == "click", F.lit("redeem"))
             .when(F.col("event_type") == "signup", F.lit("expire"))
             .otherwise(F.col("event_type")))
    magnitude = F.round(F.col("value")).cast("bigint")
    points = F.when(etype == "earn", magnitude).otherwise(-magnitude)
    return events.select(
        _s(F.col("event_id")).alias("event_id"),
        _s(F.col("user_id")).alias("customer_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("event_date"),
        etype.alias("event_type"),
        _s(points).alias("points"),
        *keep,
    )


def raw_loyalty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch loyalty extract: events before the batch cutoff."""
    ev = read(spark, sf_dir, "events")
    return _loyalty(ev.filter(F.col("ts") < F.lit(BATCH_CUTOFF).cast("timestamp_ntz")))


def loyalty_realtime_source(df: DataFrame, keep: tuple = ()) -> DataFrame:
    """Map an events frame (batch or streaming) to realtime loyalty records.

    ``keep`` names extra columns to carry along (e.g. a watermark column).
    """
    return _loyalty(df.filter(F.col("ts") >= F.lit(REALTIME_START).cast("timestamp_ntz")), keep)


def all_loyalty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loyalty records of every event, whichever feed delivers it."""
    return _loyalty(read(spark, sf_dir, "events"))


def raw_loyalty_realtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loyalty_realtime_source(read(spark, sf_dir, "events"))


RAW_BINDERS = {
    "customers": raw_customers,
    "products": raw_products,
    "stores": raw_stores,
    "transactions": raw_transactions,
    "loyalty_events": raw_loyalty_events,
}


# ---------------------------------------------------------------------------
# Operations log tables
# ---------------------------------------------------------------------------

def _ts() -> Column:
    # Kept as timestamp_ntz: log times are wall-clock UTC and must not shift
    # with the session time zone.
    return F.col("ts")


def _pipeline_name() -> Column:
    return F.when(F.col("user_id") % 3 == 2, F.lit(OTHER_PIPELINE)).otherwise(F.lit(PIPELINE_NAME))


def _status() -> Column:
    return F.when(F.col("event_type") == "error", F.lit("Failed")).otherwise(F.lit("Succeeded"))


def pipeline_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ADFPipelineRun: one run per event; error = failed; value = minutes."""
    return runs_from_events(read(spark, sf_dir, "events"))


def runs_from_events(ev: DataFrame) -> DataFrame:
    """Map an events frame (batch or streaming) to ADFPipelineRun rows."""
    start = _ts()
    micros = F.round(F.col("value") * 60_000_000).cast("decimal(18,0)")
    end = start + F.make_dt_interval(secs=micros / F.lit(1_000_000))
    return ev.select(
        start.alias("TimeGenerated"),
        _pipeline_name().alias("PipelineName"),
        _status().alias("Status"),
        start.alias("Start"),
        end.alias("End"),
    )


def activity_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ADFActivityRun: the activity comes from the event's props 'k'."""
    return activities_from_events(read(spark, sf_dir, "events"))


def activities_from_events(ev: DataFrame) -> DataFrame:
    """Map an events frame (batch or streaming) to ADFActivityRun rows."""
    k = F.get_json_object("props", "$.k").cast("int")
    acts = F.array(*[F.lit(a) for a in PIPELINE_ACTIVITIES])
    return ev.select(
        _ts().alias("TimeGenerated"),
        _pipeline_name().alias("PipelineName"),
        F.element_at(acts, (k % len(PIPELINE_ACTIVITIES)) + 1).alias("ActivityName"),
        _status().alias("Status"),
    )


def job_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DatabricksJobs: value is the run's duration in minutes."""
    return jobs_from_events(read(spark, sf_dir, "events"))


def jobs_from_events(ev: DataFrame) -> DataFrame:
    """Map an events frame (batch or streaming) to job-run log rows."""
    name = F.when(F.col("event_type").isin("purchase", "view", "error"), F.lit(JOB_NAME)) \
        .otherwise(F.lit(OTHER_JOB))
    return ev.select(_ts().alias("TimeGenerated"), name.alias("JobName"),
                     F.col("value").alias("DurationMinutes"))


def blob_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """StorageBlobLogs: one read per page; an hour apart by page id."""
    pages = read(spark, sf_dir, "pages")
    t = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        hours=F.col("page_id").cast("int"))
    return pages.select(t.alias("TimeGenerated"), F.col("url").alias("Uri"),
                        F.length("html").cast("bigint").alias("ResponseBodySize"))


def azure_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events")
    provider = F.when(F.col("event_type") == "signup", F.lit("MICROSOFT.STORAGE")) \
        .otherwise(F.lit("MICROSOFT.DATABRICKS"))
    metric = F.when(F.col("event_type").isin("purchase", "view", "click"), F.lit("DBUUsage")) \
        .otherwise(F.lit("CPUUsage"))
    return ev.select(_ts().alias("TimeGenerated"), provider.alias("ResourceProvider"),
                     metric.alias("MetricName"), F.col("value").alias("Total"))


def object_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lake object inventory: one object per order, layer by order status."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    layer = F.when(F.col("o_orderstatus") == "F", F.lit("bronze")) \
        .when(F.col("o_orderstatus") == "O", F.lit("silver")).otherwise(F.lit("gold"))
    return o.select(
        F.concat(layer, F.lit("/orders/"), _s(F.col("o_orderkey")), F.lit(".parquet")).alias("path"),
        F.col("o_orderdate").alias("modified"),
        (F.col("o_totalprice") / 1000.0).alias("size_gb"),
        (F.col("o_orderstatus") == "P").alias("is_version"),
    )
