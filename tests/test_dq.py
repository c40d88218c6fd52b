"""Data-quality checks over tables with NULLs, repeats, orphans and values at the threshold."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillroll.operators import dq


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def _orders(spark, n=400):
    """Rows with NULL or empty fields at fixed places: 1 in 40 lacks the buyer, 1 in 50 the price."""
    return spark.range(n).select(
        F.format_string("O%05d", "id").alias("order_no"),
        F.when(F.col("id") % 40 != 7, F.format_string("B%d", F.col("id") % 90)).alias("buyer"),
        F.when(F.col("id") % 50 != 11, F.col("id") * 0.5).alias("price"))


def test_complete_rows_need_every_listed_column(spark):
    df = _orders(spark)
    assert one(dq.check_completeness(df, "orders", ["order_no"], 1.0)).status == "PASS"
    both = one(dq.check_completeness(df, "orders", ["buyer", "price"], 0.955))
    # 10 rows lack the buyer, 8 the price; id 207 (= 40k + 7) and 211 differ, so 18 are incomplete
    assert (both.status, both.metric_value, both.detail) == ("PASS", 0.955, "382/400 rows complete across ['buyer', 'price']")
    assert one(dq.check_completeness(df, "orders", ["buyer", "price"], 0.9551)).status == "FAIL"


def test_repeated_keys_lower_uniqueness_to_the_threshold(spark):
    # 300 orders, the first 60 delivered three times: 300 distinct of 420
    df = _orders(spark, 300)
    again = df.filter(F.substring("order_no", 2, 5).cast("int") < 60)
    df = df.union(again).union(again)
    share = round(300 / 420, 4)
    r = one(dq.check_uniqueness(df, "orders", "order_no", threshold=300 / 420))
    assert (r.status, r.metric_value, r.detail) == ("PASS", share, "300/420 unique values for order_no")
    assert one(dq.check_uniqueness(df, "orders", "order_no", threshold=0.715)).status == "FAIL"


def test_uniqueness_null_key_not_counted(spark):
    df = spark.createDataFrame([("A",), (None,), ("B",)], "id string")
    r = one(dq.check_uniqueness(df, "test", "id", threshold=0.5))
    assert r.metric_value == pytest.approx(0.6667)


def test_orphan_rows_count_against_integrity(spark):
    df = _orders(spark)                       # buyers B0..B89 and 10 NULLs
    known = spark.range(81).select(F.format_string("B%d", "id").alias("buyer"))
    orphans = df.filter(F.col("buyer").isNull() | (F.substring("buyer", 2, 3).cast("int") > 80)).count()
    r = one(dq.check_referential_integrity(df, "orders", "buyer", known, threshold=0.5))
    assert orphans > 40 and r.metric_value == round((400 - orphans) / 400, 4) and r.status == "PASS"
    assert one(dq.check_referential_integrity(df, "orders", "buyer", known, threshold=0.99)).status == "FAIL"


def test_referential_integrity_repeated_parent_and_null_fk(spark):
    df = spark.createDataFrame([("C1",), (None,), ("C2",)], "customer_id string")
    valid = spark.createDataFrame([("C1",), ("C1",), ("C2",)], "customer_id string")
    r = one(dq.check_referential_integrity(df, "test", "customer_id", valid, threshold=0.5))
    assert r.metric_value == pytest.approx(0.6667)
    assert r.detail == "2/3 rows have a valid customer_id reference"


def test_newest_of_many_dates_counts(spark):
    days = spark.range(200).select(F.date_add(F.lit("2023-03-01").cast("date"), F.col("id").cast("int")).cast("string").alias("day"))
    days = days.union(spark.createDataFrame([("unknown",), (None,)], "day string")).select(
        F.col("day").try_cast("date").alias("day"))
    r = one(dq.check_freshness(days, "log", "day", max_age_days=30, as_of=dt.date(2023, 10, 1)))
    assert (r.status, r.metric_value) == ("PASS", 15.0)      # the newest is 2023-09-16
    assert r.detail == "Latest record is 15 days old (max allowed: 30)"


def test_freshness_limit_is_inclusive(spark):
    df = spark.createDataFrame([("2024-01-01",)], "d string")
    assert one(dq.check_freshness(df, "t", "d", 7, as_of="2024-01-08")).status == "PASS"
    assert one(dq.check_freshness(df, "t", "d", 7, as_of="2024-01-09")).status == "FAIL"


def test_empty_table_fails_every_check(spark):
    df = spark.createDataFrame([], "id string, d string")
    valid = spark.createDataFrame([("x",)], "id string")
    res = dq.evaluate(df, "empty", [dq.completeness(["id"]), dq.uniqueness("id"),
                                    dq.referential_integrity("id", valid), dq.freshness("d", 7)],
                      as_of="2024-01-01").collect()
    assert [r.status for r in res] == ["FAIL"] * 4
    fresh = res[3]
    assert fresh.metric_value is None and fresh.detail == "Table is empty"
    assert res[0].metric_value == 0.0


def test_suite_and_gate(spark):
    ok = spark.createDataFrame([("A",), ("B",)], "id string")
    bad = spark.createDataFrame([("A",), ("A",)], "id string")
    results, failed = dq.run_suite([dq.check_uniqueness(ok, "ok", "id"),
                                    dq.check_uniqueness(bad, "bad", "id")])
    assert results.count() == 2 and failed.count() == 1
    with pytest.raises(dq.DQGateError):
        dq.enforce(results)
    dq.enforce(dq.run_suite([dq.check_uniqueness(ok, "ok", "id")])[0])


def test_landing_gate(spark):
    t = {"a": spark.createDataFrame([("x",)], "v string"), "b": spark.createDataFrame([], "v string")}
    counts = dq.landing_row_counts(t, {"a": 1, "b": 1})
    assert {r.table: r.status for r in counts.collect()} == {"a": "PASS", "b": "FAIL"}
    with pytest.raises(dq.DQGateError):
        dq.enforce_landing(counts)


def test_pass_rate(spark):
    from tillroll.operators import silver
    bronze = spark.createDataFrame(
        [("T1", "-1", "C1"), ("T2", "2", "C2"), ("T2", "2", "C2"), ("T3", "abc", "C3")],
        "transaction_id string, quantity string, customer_id string")
    r = one(dq.check_pass_rate(silver.reject_accounting(bronze), "transactions", 0.95))
    assert r.status == "FAIL" and r.metric_value == 0.25
    assert r.detail == "1 clean / 4 total (3 rejected)"


def test_results_are_stored_before_the_gate_and_runs_stay_apart(spark, tmp_path):
    path = f"{tmp_path}/results"
    row = "check_name string, `table` string, status string, metric_value double, threshold double, detail string"
    good = spark.createDataFrame([("uniqueness", "a", "PASS", 1.0, 0.9, ""), ("freshness", "a", "PASS", 1.0, 2.0, "")], row)
    bad = spark.createDataFrame([("uniqueness", "b", "FAIL", 0.5, 0.9, "x"), ("freshness", "b", "PASS", 1.0, 2.0, "")], row)
    assert dq.enforce(dq.store_results(good, path, "2024-01-01", "r1")).count() == 2
    with pytest.raises(dq.DQGateError, match="b.uniqueness"):
        dq.enforce(dq.store_results(bad, path, "2024-01-02", "r2"))
    runs = {r.run_id: (r.run_as_of, r.checks, r.failed, r.blocked)
            for r in dq.gate_history(spark.read.parquet(path)).collect()}
    assert runs == {"r1": ("2024-01-01", 2, 0, False), "r2": ("2024-01-02", 2, 1, True)}
