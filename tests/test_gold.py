"""Gold: margin rule, NULL groups kept, revenue reconciles across tables."""
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillroll.functions.exprs import gross_margin
from tillroll.operators import gold
from tillroll.plans import retail

SF = "/root/testdata/sf0.001"


def test_gross_margin_calculation(spark):
    df = spark.createDataFrame([(Decimal("1000.00"), Decimal("0.600"))],
                               "amount decimal(18,2), cost_price_pct decimal(4,3)")
    assert df.select(gross_margin("amount", "cost_price_pct").alias("m")).first().m == Decimal("400.00")


def test_margin_rounds_half_up(spark):
    df = spark.createDataFrame([(Decimal("0.25"), Decimal("0.500"))],
                               "amount decimal(18,2), cost_price_pct decimal(4,3)")
    assert df.select(gross_margin("amount", "cost_price_pct").alias("m")).first().m == Decimal("0.13")


def test_unmatched_dimensions_kept_as_null_group(spark):
    tx = spark.createDataFrame(
        [("T1", "C1", "P1", "S1", "2024-01-05", 1, Decimal("10.00")),
         ("T2", "C9", "P9", "S9", "2024-01-06", 2, Decimal("5.00"))],
        "transaction_id string, customer_id string, product_id string, store_id string, "
        "transaction_date string, quantity int, amount decimal(18,2)").withColumn(
        "transaction_date", F.to_date("transaction_date"))
    products = spark.createDataFrame([("P1", "Food", Decimal("0.500"))],
                                     "product_id string, category string, cost_price_pct decimal(4,3)")
    stores = spark.createDataFrame([("S1", "East", "Mall")], "store_id string, region string, store_format string")
    cust = spark.createDataFrame([("C1", "Gold")], "customer_id string, loyalty_tier string")
    e = gold.enrich(tx, products, stores, cust)
    a1 = {(r.region, r.category): r.revenue for r in gold.sales_by_region_category_month(e).collect()}
    assert a1 == {("East", "Food"): 10.0, (None, None): 5.0}
    tiers = {r.loyalty_tier: r.customers for r in gold.loyalty_tier_value(e).collect()}
    assert tiers == {"Gold": 1, None: 1}


def test_revenue_reconciles(spark):
    g = retail.gold_tables(spark, SF)
    totals = [g[n].agg(F.sum(F.col("revenue").cast("decimal(38,2)"))).first()[0]
              for n in ("sales_by_region_category_month", "loyalty_tier_value", "store_performance")]
    assert totals[0] == totals[1] == totals[2]
    fact = retail.silver_tables(spark, SF).transactions.agg(F.sum("amount")).first()[0]
    assert totals[0] == fact


def test_top_stores_ordered(spark):
    perf = gold.store_performance(retail.enriched(spark, SF))
    top = gold.top_stores(perf, 5).collect()
    assert len(top) == 5
    revs = [r.revenue for r in top]
    assert revs == sorted(revs, reverse=True)
    assert revs[0] == perf.agg(F.max("revenue")).first()[0]


def test_points_net_row(spark):
    loy = spark.createDataFrame([("earn", 10), ("earn", 5), ("redeem", -7)], "event_type string, points long")
    got = {(r.event_type, r.is_total): r.points for r in gold.points_liability_net(loy).collect()}
    assert got == {("earn", False): 15, ("redeem", False): -7, (None, True): 8}


def test_one_pass_equals_separate_aggregates(spark):
    e = retail.enriched(spark, SF)
    agg = gold.gold_one_pass(e)
    for name in ("sales_by_region_category_month", "store_performance", "loyalty_tier_value"):
        a = sorted((tuple(r) for r in gold.from_one_pass(agg, name).collect()), key=str)
        b = sorted((tuple(r) for r in getattr(gold, name)(e).collect()), key=str)
        assert a == b, name
    rng = gold.from_one_pass(agg, "date_range").first()
    t = retail.silver_tables(spark, SF).transactions.agg(F.min("transaction_date"), F.max("transaction_date")).first()
    assert (rng.first_date, rng.last_date) == (t[0], t[1])
