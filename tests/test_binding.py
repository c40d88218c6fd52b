"""The binding of the test tables: whole-table coverage of the extracts."""
from pyspark.sql import functions as F

from tillroll.sources import binding

SF = "/root/testdata/sf0.001"


def test_customer_extracts_cover_every_customer(spark):
    all_ids = {r.customer_id for r in binding.raw_customers(spark, SF).collect()}
    d1 = {r.customer_id for r in binding.customers_day1(spark, SF).collect()}
    d2 = {r.customer_id for r in binding.customers_day2(spark, SF).collect()}
    assert d1 | d2 == all_ids and d1 - d2 and d2 - d1     # new and vanished customers exist


def test_loyalty_legs_cover_every_event(spark):
    n = binding.read(spark, SF, "events").count()
    batch = {r.event_id for r in binding.raw_loyalty_events(spark, SF).collect()}
    rt = {r.event_id for r in binding.raw_loyalty_realtime(spark, SF).collect()}
    assert len(batch | rt) == n and batch & rt             # overlapping legs


def test_transactions_whole_table_with_dirt(spark):
    raw = binding.raw_transactions(spark, SF)
    assert raw.count() == binding.read(spark, SF, "lineitem").count()
    dirt = raw.agg(F.count_if(F.col("quantity") == "-1").alias("q"),
                   F.count_if(F.col("customer_id") == "").alias("c")).first()
    assert dirt.q > 0 and dirt.c > 0
