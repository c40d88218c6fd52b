"""SCD2 merge on the fixture snapshots (C1 unchanged .. C6 null tier)."""
import pytest

from tillroll.operators import scd2

COLS = "customer_id string, region string, loyalty_tier string"


def day1(spark):
    rows = [("C1", "R1", "Bronze"), ("C2", "R1", "Bronze"), ("C4", "R1", "Gold"),
            ("C5", "R1", "Gold"), ("C6", "R1", None)]
    return scd2.scd2_initial(spark.createDataFrame(rows, COLS), "2024-01-01")


def day2(spark):
    rows = [("C1", "R1", "Bronze"), ("C2", "R1", "Silver"), ("C3", "R2", "Gold"),
            ("C5", "R9", "Gold"), ("C6", "R1", "Gold")]
    return spark.createDataFrame(rows, COLS)


def rows(df):
    return sorted(((r.customer_id, r.region, r.loyalty_tier, str(r.effective_from),
                    str(r.effective_to), r.is_current) for r in df.collect()), key=str)


def test_initial_load(spark):
    got = rows(day1(spark))
    assert all(r[3] == "2024-01-01" and r[4] == "None" and r[5] for r in got)
    assert len(got) == 5


def test_merge_reference_semantics(spark):
    merged = scd2.scd2_merge(day1(spark), day2(spark), ["customer_id"], ["loyalty_tier"], "2024-01-02")
    got = rows(merged)
    assert got == sorted([
        ("C1", "R1", "Bronze", "2024-01-01", "None", True),
        ("C2", "R1", "Bronze", "2024-01-01", "2024-01-02", False),
        ("C2", "R1", "Silver", "2024-01-02", "None", True),
        ("C3", "R2", "Gold", "2024-01-02", "None", True),
        ("C4", "R1", "Gold", "2024-01-01", "None", True),
        ("C5", "R1", "Gold", "2024-01-01", "None", True),   # region is not tracked
        ("C6", "R1", None, "2024-01-01", "None", True),     # NULL -> Gold is not a change
    ], key=str)


def test_merge_null_safe(spark):
    merged = scd2.scd2_merge(day1(spark), day2(spark), ["customer_id"], ["loyalty_tier"], "2024-01-02",
                             null_safe=True)
    c6 = [r for r in rows(merged) if r[0] == "C6"]
    assert c6 == sorted([("C6", "R1", None, "2024-01-01", "2024-01-02", False),
                         ("C6", "R1", "Gold", "2024-01-02", "None", True)], key=str)


def test_rerun_changes_nothing_and_one_current_per_key(spark):
    once = scd2.scd2_merge(day1(spark), day2(spark), ["customer_id"], ["loyalty_tier"], "2024-01-02")
    once = spark.createDataFrame(once.collect(), once.schema)
    twice = scd2.scd2_merge(once, day2(spark), ["customer_id"], ["loyalty_tier"], "2024-01-03")
    assert rows(once) == rows(twice)
    cur = scd2.current_rows(twice).groupBy("customer_id").count()
    assert cur.filter("count > 1").count() == 0


def test_new_or_changed(spark):
    got = sorted(r.customer_id for r in
                 scd2.new_or_changed(day2(spark), day1(spark), ["customer_id"], ["loyalty_tier"]).collect())
    assert got == ["C2", "C3"]
