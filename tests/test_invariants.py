"""What must hold whatever code and SQL twin decided: totals reconcile, nothing is cut,
nothing after ``as_of`` counts."""
import datetime as dt

from pyspark.sql import functions as F

import __spark_entry__ as E
from tillroll.functions.exprs import coerce_number
from tillroll.operators import gold, oplog, silver
from tillroll.plans import retail, semantic
from tillroll.sources import binding

SF = "/root/testdata/sf0.001"
AT = dt.datetime(2024, 1, 31)


def logs(spark, rows, extra):
    return spark.createDataFrame([(t, *r) for t, *r in rows], f"TimeGenerated timestamp_ntz, {extra}")


def test_usage_is_not_rounded_or_overflowing(spark):
    rows = [(dt.datetime(2024, 1, 30, h), "MICROSOFT.DATABRICKS", "DBUUsage", 0.004) for h in range(3)]
    rows.append((dt.datetime(2024, 1, 29), "MICROSOFT.DATABRICKS", "DBUUsage", 1e17))
    got = [r.DailyDBUs for r in oplog.daily_usage(logs(spark, rows, "ResourceProvider string, MetricName string, Total double"), AT).collect()]
    assert got == [1e17, 0.012]
    jobs = logs(spark, [(dt.datetime(2024, 1, 30), oplog.JOB, 1.004)], "JobName string, DurationMinutes double")
    row = oplog.duration_trend(jobs, AT).first()
    assert row.AvgDurationMin == row.MaxDurationMin == 1.004


def test_nothing_after_as_of_counts(spark):
    rows = [(AT + dt.timedelta(days=d), oplog.JOB, 5.0) for d in (-31, -30, -1, 0, 1, 40)]
    jobs = logs(spark, rows, "JobName string, DurationMinutes double")
    assert [r.TimeGenerated for r in oplog.duration_trend(jobs, AT).collect()] == [AT - dt.timedelta(days=1), AT]


def test_calendar_total_is_total_revenue(spark):
    fact = spark.createDataFrame([("2024-01", 10.0), ("2024-03", 2.5), (None, 5.0)], "month string, revenue double")
    rows = semantic.calendar_rollup(fact, semantic.dim_date_of_months(fact)).collect()
    assert [r.revenue for r in rows if r.level == 7] == [17.5]
    assert {r.revenue for r in rows if r.level == 0 and r.month is None} == {5.0}
    total = sum(r.total_revenue for r in E.queries()["total_revenue"](spark, SF).collect())
    drill = [r.revenue for r in E.queries()["calendar_rollup"](spark, SF).collect() if r.level == 7]
    assert len(drill) == 1 and abs(drill[0] - total) < 0.005


def test_accounting_adds_up(spark):
    bronze = binding.raw_transactions(spark, SF)
    acc = silver.reject_accounting(bronze).first()
    assert acc.clean + acc.rejected == acc.total == bronze.count()
    assert acc.bad_quantity + acc.missing_customer + acc.duplicates == acc.rejected
    assert silver.cleanse_transactions(bronze).count() == acc.clean


def test_large_whole_numbers_keep_every_digit(spark):
    values = {"9007199254740993": 9007199254740993, "2.0": 2, "2.7": 2, " 12 ": 12, "abc": None, "1e3": 1000,
              "99999999999999999999": None, None: None}
    df = spark.createDataFrame([(k,) for k in values], "p string")
    got = [r.n for r in df.select(coerce_number("p", "bigint").alias("n")).collect()]
    assert got == list(values.values())
    loyalty = silver.type_table(spark.createDataFrame([("E", "C", "2024-01-01", "earn", "9007199254740993")],
                                                      "event_id string, customer_id string, event_date string, event_type string, points string"), "loyalty_events")
    assert gold.points_liability(loyalty).first().points == 9007199254740993


def test_leaderboard_places(spark):
    rows = sorted(E.queries()["store_leaderboard"](spark, SF).collect(), key=lambda r: r.place)
    assert [r.place for r in rows] == list(range(1, len(rows) + 1)) and len(rows) == retail.fact_store(spark, SF).count()
    assert [(-r.revenue, r.store_id) for r in rows] == sorted((-r.revenue, r.store_id) for r in rows)


def test_yoy_with_gaps_and_null_region(spark):
    fact = spark.createDataFrame([("2023-01", "N", 10.0), ("2024-01", "N", 15.0), ("2023-02", None, 4.0), ("2024-03", "N", 1.0)],
                                 "month string, region string, revenue double")
    got = {(r.month, r.region): (r.revenue, r.prior_year_revenue, r.yoy_revenue_growth)
           for r in semantic.yoy_revenue_growth(fact, semantic.dim_date_of_months(fact), ["region"]).collect()}
    assert got == {("2023-01", "N"): (10.0, None, None), ("2024-01", "N"): (15.0, 10.0, 0.5), ("2023-02", None): (4.0, None, None),
                   ("2024-02", None): (0.0, 4.0, -1.0), ("2024-03", "N"): (1.0, None, None)}


def scans(spark, key):
    return E.queries()[key](spark, SF)._jdf.queryExecution().optimizedPlan().toString()


def test_dimensions_that_yield_nothing_are_not_joined(spark):
    def has(plan, *keys):
        return [k in plan for k in keys]
    parts = ("p_partkey", "s_suppkey", "c_custkey")
    assert has(scans(spark, "month_key"), *parts) == [False, False, False]
    assert has(scans(spark, "gross_margin"), *parts) == [True, False, False]
    assert has(scans(spark, "store_performance"), *parts) == [True, True, False]
    assert has(scans(spark, "loyalty_tier_value"), *parts) == [False, False, True]
    assert has(scans(spark, "calendar_rollup"), *parts) == [False, False, False]
