"""Retail tables built from the driver's test tables, layer by layer.

These are lazy DataFrames: nothing runs until an action, and Catalyst
prunes every column a query does not use down to the parquet scan.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.exprs import as_money
from tillroll.operators import gold, scd2, silver
from tillroll.sources import binding

# The run date used wherever the reference takes current_date().
AS_OF = "2024-02-01"
DAY1 = "2024-01-01"


class Silver:
    """The Silver tables of one run, each built on first use.

    Building a DataFrame costs driver round-trips per expression, so a query
    that needs only transactions never builds the loyalty or SCD plans.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str = DAY1):
        self.spark, self.sf_dir, self.as_of = spark, sf_dir, as_of

    def _raw(self, name: str) -> DataFrame:
        return binding.RAW_BINDERS[name](self.spark, self.sf_dir)

    @cached_property
    def transactions(self) -> DataFrame:
        return silver.cleanse_transactions(self._raw("transactions"), stamp=False)

    @cached_property
    def products(self) -> DataFrame:
        return silver.conform(self._raw("products"), "products")

    @cached_property
    def stores(self) -> DataFrame:
        return silver.conform(self._raw("stores"), "stores")

    @cached_property
    def dim_customer(self) -> DataFrame:
        return scd2.scd2_initial(silver.conform(self._raw("customers"), "customers"), self.as_of)

    @cached_property
    def current_customers(self) -> DataFrame:
        return scd2.current_rows(self.dim_customer)

    @cached_property
    def loyalty(self) -> DataFrame:
        valid = self.current_customers.select("customer_id")
        return silver.silver_loyalty(self._raw("loyalty_events"),
                                     binding.raw_loyalty_realtime(self.spark, self.sf_dir), valid,
                                     dim_bounds(self.spark, self.sf_dir)["customers"])


def bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: fn(spark, sf_dir) for name, fn in binding.RAW_BINDERS.items()}


def silver_tables(spark: SparkSession, sf_dir: str, as_of: str = DAY1) -> Silver:
    return Silver(spark, sf_dir, as_of)


def dim_bounds(spark: SparkSession, sf_dir: str) -> dict[str, int]:
    """Proven row bounds of the dimensions: their source tables' row counts."""
    from tillroll.functions.joins import source_rows_many
    return source_rows_many(spark, {"products": binding.path(sf_dir, "part"),
                                    "stores": binding.path(sf_dir, "supplier"),
                                    "customers": binding.path(sf_dir, "customer")})


def enriched(spark: SparkSession, sf_dir: str, need: list[str] | None = None) -> DataFrame:
    """The enriched fact with the added columns in ``need`` (default: all)."""
    s = silver_tables(spark, sf_dir)
    bounds = dim_bounds(spark, sf_dir) if need is None or set(need) - {"month"} else None
    return gold.enrich(s.transactions, s.products, s.stores, s.current_customers, bounds, need)


def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.sales_by_region_category_month(enriched(spark, sf_dir, gold.SALES_NEEDS))


def fact_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.store_performance(enriched(spark, sf_dir, gold.STORE_NEEDS))


def fact_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.loyalty_tier_value(enriched(spark, sf_dir, gold.TIER_NEEDS))


def gold_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The Gold tables, each from the dimensions it reads."""
    return {"sales_by_region_category_month": fact_sales(spark, sf_dir),
            "loyalty_tier_value": fact_tier(spark, sf_dir),
            "store_performance": fact_store(spark, sf_dir),
            "loyalty_points_liability": gold.points_liability(silver_tables(spark, sf_dir).loyalty)}


def sales_at(spark: SparkSession, sf_dir: str, by: list[str]) -> DataFrame:
    """Sales at a coarser grain: only the dimensions that ``by`` needs are joined."""
    return enriched(spark, sf_dir, by).groupBy(*by).agg(as_money(F.sum("amount")).alias("revenue"))


def sales_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales without a grain: the one row that headline measures divide."""
    return enriched(spark, sf_dir, ["gross_margin"]).agg(
        as_money(F.sum("amount")).alias("revenue"), as_money(F.sum("gross_margin")).alias("gross_margin"),
        F.count("transaction_id").alias("transactions"))


def scd2_snapshots(spark: SparkSession, sf_dir: str):
    """Day-1 dimension and the day-2 staged snapshot (typed, one per key)."""
    day1 = silver.conform(binding.customers_day1(spark, sf_dir), "customers")
    day2 = silver.conform(binding.customers_day2(spark, sf_dir), "customers")
    return scd2.scd2_initial(day1, DAY1), day2


def typed_realtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    rt = binding.raw_loyalty_realtime(spark, sf_dir)
    return silver.event_type_in(silver.type_table(rt, "loyalty_events"))


def typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All loyalty events of both feeds' periods, typed, accepted types only."""
    return silver.event_type_in(silver.type_table(binding.all_loyalty_events(spark, sf_dir), "loyalty_events"))
