"""Snapshots to type 2 rows in one pass, logs laid out by day, catalog views."""
import glob
import itertools
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tillroll.operators import oplog, scd2
from tillroll.plans import pipeline
from tillroll.sources import binding, files

SF = "/root/testdata/sf0.001"
COLS = "k string, tier string, area string, note string"


def merged_one_by_one(spark, days, tracked, null_safe):
    """The dimension after merging the snapshots in order, in plain Python rows."""
    dim = []
    for day, rows in days:
        for k, *values in rows:
            new = dict(zip(("tier", "area", "note"), values))
            cur = next((v for v in dim if v["k"] == k and v["to"] is None), None)
            differ = cur is not None and any(
                (cur[c] != new[c]) if null_safe else (cur[c] is not None and new[c] is not None and cur[c] != new[c])
                for c in tracked)
            if differ:
                cur["to"] = day
            if cur is None or differ:
                dim.append({"k": k, **new, "from": day, "to": None})
    return sorted((d["k"], d["tier"] or "", d["area"] or "", d["note"] or "", d["from"], d["to"] or "", d["to"] is None)
                  for d in dim)


@pytest.mark.parametrize("null_safe,tracked", list(itertools.product([False, True], [["tier"], ["tier", "area"]])))
def test_backfill_equals_merges_day_by_day(spark, null_safe, tracked):
    rng = random.Random(11)
    days = [(f"2024-0{m}-01", [(f"K{i}", rng.choice([None, "A", "B"]), rng.choice([None, "x", "y"]), str(rng.random()))
                               for i in range(25) if rng.random() < 0.8]) for m in range(1, 8)]
    rows = [(*r, day) for day, snapshot in days for r in snapshot]
    df = spark.createDataFrame(rows, COLS + ", as_of string").withColumn("as_of", F.col("as_of").cast("date"))
    out = scd2.scd2_backfill(df.repartition(3), ["k"], tracked, null_safe=null_safe)
    got = sorted((r.k, r.tier or "", r.area or "", r.note or "", str(r.effective_from), str(r.effective_to or ""),
                  r.is_current) for r in out.collect())
    assert got == merged_one_by_one(spark, days, tracked, null_safe)
    # and the same as the merge operator, applied in order
    dim = None
    for day, snapshot in days:
        staged = spark.createDataFrame(snapshot, COLS)
        dim = scd2.scd2_initial(staged, day) if dim is None else scd2.scd2_merge(dim, staged, ["k"], tracked, day, null_safe)
        dim = spark.createDataFrame(dim.collect(), dim.schema)
    assert sorted(map(str, dim.collect())) == sorted(map(str, out.select(*dim.columns).collect()))


def test_backfill_shuffles_once(spark):
    df = spark.createDataFrame([("K1", "A", None, None, "2024-01-01")], COLS + ", as_of string")
    plan = scd2.scd2_backfill(df, ["k"], ["tier"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Window" not in plan and "Join" not in plan


def test_window_queries_read_the_days_of_the_window_only(spark):
    root = tempfile.mkdtemp(prefix="tillroll-log-")
    runs = binding.pipeline_runs(spark, SF)
    want = sorted(map(str, oplog.run_history(runs, "2024-01-31 00:00:00", 7).collect()))
    files.write_day_log(runs, root)
    log = files.read_day_log(spark, root, runs.schema)
    recent = oplog.run_history(log, "2024-01-31 00:00:00", 7)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(log_day" in plan
    days = sorted(os.path.basename(d).split("=")[1] for d in glob.glob(f"{root}/log_day=*"))
    assert len(days) > 20
    for d in days:  # what lies outside the window cannot be read, and need not be
        if not "2024-01-24" <= d <= "2024-01-31":
            for f in glob.glob(f"{root}/log_day={d}/*.parquet"):
                with open(f, "wb") as out:
                    out.write(b"damaged")
                os.unlink(os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc"))
    assert sorted(map(str, recent.collect())) == want and want


def test_a_second_day_is_appended_and_rows_without_a_time_stay_out(spark):
    root = tempfile.mkdtemp(prefix="tillroll-log-")
    log = spark.createDataFrame([("2024-01-01 10:00:00", "J"), (None, "J")], "t string, JobName string") \
        .select(F.col("t").cast("timestamp_ntz").alias("TimeGenerated"), "JobName", F.lit(5.0).alias("DurationMinutes"))
    files.write_day_log(log, root)
    files.write_day_log(log.filter("TimeGenerated is not null").withColumn(
        "TimeGenerated", F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")), root)
    back = files.read_day_log(spark, root, log.schema)
    assert back.count() == 3
    got = oplog.duration_trend(back, "2024-01-02 00:00:00", 30, "J").collect()
    assert [str(r.TimeGenerated) for r in got] == ["2024-01-01 00:00:00", "2024-01-02 00:00:00"]
    # the window's open end: exactly seven days before is out
    assert oplog.duration_trend(back, "2024-01-08 10:00:00", 7, "J").count() == 1


def gold_lake(spark, lake, revenue):
    for table, schema in {"sales_by_region_category_month": "month string, revenue double",
                          "store_performance": "store_id string, revenue double",
                          "loyalty_tier_value": "loyalty_tier string, revenue double"}.items():
        files.write_version(spark, spark.createDataFrame([("2024-01", revenue)], schema), lake, "gold", table)


def test_another_session_reads_the_newest_version_by_name(spark, monkeypatch):
    lake = tempfile.mkdtemp(prefix="tillroll-cat-")
    monkeypatch.setattr(pipeline, "_dates", lambda spark, lake: spark.createDataFrame([("2024-01-01",)], "date string"))
    gold_lake(spark, lake, 1.0)
    views = pipeline.publish_catalog(spark, lake, "gold_probe")
    assert views == [f"`gold_probe`.`{n}`" for n in ("fact_sales", "fact_store_performance", "fact_loyalty_tier_value",
                                                      "dim_date")]
    other = spark.newSession()
    try:
        assert other.sql("SELECT revenue FROM gold_probe.fact_sales").collect()[0][0] == 1.0
        reader = other.table("gold_probe.fact_sales")
        gold_lake(spark, lake, 2.0)
        assert other.sql("SELECT revenue FROM gold_probe.fact_sales").collect()[0][0] == 1.0  # not published yet
        pipeline.publish_catalog(spark, lake, "gold_probe", perspective="ExecutiveSummary")
        assert other.sql("SELECT revenue FROM gold_probe.fact_sales").collect()[0][0] == 2.0
        assert other.sql("SELECT revenue FROM gold_probe.fact_store_performance").collect()[0][0] == 1.0
        assert reader.collect()[0].revenue == 1.0  # an open reader is not disturbed
    finally:
        spark.sql("DROP DATABASE gold_probe CASCADE")
