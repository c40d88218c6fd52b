"""Measures: ratio of sums, DIVIDE on zero, YoY with gaps, dim_date, rollup."""
import datetime as dt

from tillroll.plans import semantic


def fact(spark, rows):
    return spark.createDataFrame(rows, "month string, region string, revenue double, gross_margin double, transactions long")


def test_gross_margin_pct_ratio_of_sums_and_zero(spark):
    f = fact(spark, [("2024-01", "A", 100.0, 40.0, 2), ("2024-02", "A", 300.0, 60.0, 3),
                     ("2024-01", "B", 0.0, 0.0, 0)])
    got = {r.region: r.gross_margin_pct for r in semantic.gross_margin_pct(f, ["region"]).collect()}
    assert got == {"A": 0.25, "B": None}
    rpt = {r.region: r.revenue_per_transaction for r in semantic.revenue_per_transaction(f, ["region"]).collect()}
    assert rpt == {"A": 80.0, "B": None}


def test_yoy_with_gaps(spark):
    f = fact(spark, [("2023-01", "A", 100.0, 0.0, 1), ("2024-01", "A", 150.0, 0.0, 1),
                     ("2023-02", "A", 50.0, 0.0, 1), ("2024-03", "A", 70.0, 0.0, 1)])
    dates = spark.createDataFrame([(dt.date(2023, 1, 1),), (dt.date(2024, 3, 31),)], "transaction_date date")
    got = {r.month: r.yoy_revenue_growth for r in
           semantic.yoy_revenue_growth(f, semantic.dim_date(dates), ["region"]).collect()}
    assert got["2024-01"] == 0.5          # (150 - 100) / 100
    assert got["2024-02"] == -1.0         # prior but no current
    assert got["2024-03"] is None         # no prior
    assert got["2023-01"] is None
    assert "2025-01" not in got           # outside the date dimension


def test_dim_date_columns(spark):
    dates = spark.createDataFrame([(dt.date(2024, 2, 28),), (dt.date(2024, 3, 1),)], "transaction_date date")
    got = [tuple(r) for r in semantic.dim_date(dates).collect()]
    assert got == [(dt.date(2024, 2, 28), 2024, "Q1", "February", "2024-02"),
                   (dt.date(2024, 2, 29), 2024, "Q1", "February", "2024-02"),
                   (dt.date(2024, 3, 1), 2024, "Q1", "March", "2024-03")]


def test_calendar_rollup_levels(spark):
    f = fact(spark, [("2024-01", "A", 10.0, 0.0, 1), ("2024-04", "A", 5.0, 0.0, 1)])
    dates = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 4, 30),)], "transaction_date date")
    got = {(r.year, r.quarter, r.month, r.level): r.revenue for r in
           semantic.calendar_rollup(f, semantic.dim_date(dates)).collect()}
    assert got[(None, None, None, 7)] == 15.0
    assert got[(2024, None, None, 3)] == 15.0
    assert got[(2024, "Q2", None, 1)] == 5.0
    assert got[(2024, "Q1", "2024-01", 0)] == 10.0


def test_simple_measures_and_defaults(spark):
    f = fact(spark, [("2024-01", "A", 0.1, 0.05, 1), ("2024-01", "A", 0.2, 0.05, 2), ("2024-02", "B", 1.0, 0.5, 1)])
    tot = {r.region: r.total_revenue for r in semantic.total_revenue(f, ["region"]).collect()}
    assert tot == {"A": 0.3, "B": 1.0}                     # exact: not 0.30000000000000004
    d = {r.region: tuple(r)[1:] for r in semantic.default_summary(
        f.withColumn("units", f.transactions), "fact_sales", ["region"]).collect()}
    assert d["A"] == (0.3, 3, 0.1, 3)
    stores = spark.createDataFrame([("S1", "Mall", "R", 10.0, 1.0), ("S2", "Mall", "R", 20.0, 2.0),
                                    ("S3", "Express", "R", 5.0, 0.0)],
                                   "store_id string, store_format string, region string, revenue double, gross_margin double")
    avg = {r.store_format: r.avg_revenue_per_store for r in semantic.avg_revenue_per_store(stores, ["store_format"]).collect()}
    assert avg == {"Mall": 15.0, "Express": 5.0}
    ops = {r.store_format: (r.stores, r.gross_margin_pct) for r in semantic.store_operations(stores).collect()}
    assert ops == {"Mall": (2, 0.1), "Express": (1, 0.0)}
    tiers = spark.createDataFrame([("Gold", 2, 100.0), ("Bronze", 0, 0.0)], "loyalty_tier string, customers long, revenue double")
    rpc = {r.loyalty_tier: r.revenue_per_customer for r in semantic.revenue_per_customer(tiers, ["loyalty_tier"]).collect()}
    assert rpc == {"Gold": 50.0, "Bronze": None}
    es = {r.measure: r.value for r in semantic.executive_summary(f, tiers).collect()}
    assert es["Total Revenue"] == 1.3 and es["Revenue per Loyalty Customer"] == 50.0
    assert es["Revenue per Transaction"] == 1.3 / 4
