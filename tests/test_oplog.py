"""Log queries, alert windows and storage tiers on fixture rows."""
import datetime as dt

from pyspark.sql import functions as F

from tillroll.operators import oplog

T = dt.datetime


def ntz(df, *cols):
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


def test_run_history_time_bound_and_duration(spark):
    rows = [(T(2024, 1, 24, 0, 0, 1), "pl_medallion_refresh", "Succeeded", T(2024, 1, 24, 0, 0, 1), T(2024, 1, 24, 0, 1, 1)),
            (T(2024, 1, 24, 0, 0, 0), "pl_medallion_refresh", "Failed", T(2024, 1, 24), T(2024, 1, 24)),
            (T(2024, 1, 30), "other", "Succeeded", T(2024, 1, 30), T(2024, 1, 30))]
    runs = ntz(spark.createDataFrame(rows, "TimeGenerated timestamp, PipelineName string, Status string, Start timestamp, End timestamp"),
               "TimeGenerated", "Start", "End")
    got = oplog.run_history(runs, "2024-01-31 00:00:00", days=7).collect()
    assert len(got) == 1 and got[0].DurationMs == 60000   # the run at exactly the bound is out


def test_volume_short_uri_groups_under_empty(spark):
    rows = [(T(2024, 1, 20), "https://acct.blob/gold/x", 10), (T(2024, 1, 20), "short/uri", 5),
            (T(2024, 1, 20), "https://acct.blob/gold/y", 1)]
    blobs = ntz(spark.createDataFrame(rows, "TimeGenerated timestamp, Uri string, ResponseBodySize long"),
                "TimeGenerated")
    got = {r.Uri: (r.TransactionCount, r.TotalBytes) for r in
           oplog.volume_by_path_segment(blobs, "2024-01-31 00:00:00").collect()}
    assert got == {"gold": (2, 11), "": (1, 5)}


def test_runtime_alert_is_strict(spark):
    rows = [(T(2024, 1, 1, 0, 5), "medallion_daily_refresh", 90.0),
            (T(2024, 1, 1, 1, 5), "medallion_daily_refresh", 90.5),
            (T(2024, 1, 1, 1, 20), "medallion_daily_refresh", 120.0)]
    jobs = ntz(spark.createDataFrame(rows, "TimeGenerated timestamp, JobName string, DurationMinutes double"),
               "TimeGenerated")
    got = [(r.window_start, r.hits, r.severity) for r in oplog.alert_runtime(jobs).collect()]
    assert got == [(T(2024, 1, 1, 1, 0), 2, 3)]


def test_duration_trend_daily(spark):
    rows = [(T(2024, 1, 20, 1), "medallion_daily_refresh", 30.0), (T(2024, 1, 20, 5), "medallion_daily_refresh", 40.0),
            (T(2024, 1, 21, 1), "medallion_daily_refresh", 10.0)]
    jobs = ntz(spark.createDataFrame(rows, "TimeGenerated timestamp, JobName string, DurationMinutes double"),
               "TimeGenerated")
    got = [(r.TimeGenerated, r.AvgDurationMin, r.MaxDurationMin) for r in
           oplog.duration_trend(jobs, "2024-01-31 00:00:00").collect()]
    assert got == [(T(2024, 1, 20), 35.0, 40.0), (T(2024, 1, 21), 10.0, 10.0)]


def test_storage_tiers_and_cost(spark):
    rows = [("bronze/a", T(2024, 1, 1), 1.0, False),     # age 30 -> hot
            ("bronze/b", T(2023, 12, 31), 1.0, False),   # 31 -> cool
            ("bronze/c", T(2023, 10, 1), 1.0, False),    # > 90 -> archive
            ("bronze/d", T(2021, 1, 1), 1.0, False),     # > 730 -> delete
            ("gold/e", T(2021, 1, 1), 1.0, False),       # not under the lifecycle prefix
            ("silver/f", T(2023, 10, 1), 1.0, True)]     # old version -> delete
    inv = ntz(spark.createDataFrame(rows, "path string, modified timestamp, size_gb double, is_version boolean"),
              "modified")
    tiers = oplog.storage_tiers(inv, "2024-01-31")
    got = {r.path: r.tier for r in tiers.collect()}
    assert got == {"bronze/a": "hot", "bronze/b": "cool", "bronze/c": "archive", "bronze/d": "delete",
                   "gold/e": "hot", "silver/f": "delete"}
    cost = {r.tier: (r.cost_tiered, r.cost_all_hot) for r in oplog.storage_cost(tiers).collect()}
    assert cost["hot"] == (0.76, 0.76) and cost["cool"] == (0.21, 0.38) and cost["delete"] == (0.0, 0.76)


def test_storage_saving_matches_cost_model(spark):
    # 2,400 GB at 20/35/45 hot/cool/archive: the cost model's 55.9% saving.
    rows = [("hot", 480.0), ("cool", 840.0), ("archive", 1080.0)]
    tiers = spark.createDataFrame(rows, "tier string, size_gb double")
    s = oplog.storage_saving(oplog.storage_cost(tiers)).first()
    assert round(s.cost_all_hot, 2) == 912.00 and round(s.cost_tiered, 2) == 402.00
    assert round(s.saving_pct, 3) == 0.559


def test_failures_by_activity_window_and_filters(spark):
    rows = [(T(2024, 1, 20), "pl_medallion_refresh", "run_dq_suite_gate", "Failed"),
            (T(2024, 1, 21), "pl_medallion_refresh", "run_dq_suite_gate", "Failed"),
            (T(2024, 1, 21), "pl_medallion_refresh", "copy_source_extracts_to_landing", "Failed"),
            (T(2024, 1, 21), "pl_medallion_refresh", "copy_source_extracts_to_landing", "Succeeded"),
            (T(2024, 1, 21), "other", "copy_source_extracts_to_landing", "Failed"),
            (T(2023, 12, 1), "pl_medallion_refresh", "run_dq_suite_gate", "Failed")]   # older than 30 days
    acts = ntz(spark.createDataFrame(rows, "TimeGenerated timestamp, PipelineName string, ActivityName string, Status string"),
               "TimeGenerated")
    got = [(r.ActivityName, r.FailureCount) for r in oplog.failures_by_activity(acts, "2024-01-31 00:00:00").collect()]
    assert got == [("run_dq_suite_gate", 2), ("copy_source_extracts_to_landing", 1)]
    gate = [(r.window_start, r.hits, r.severity) for r in oplog.alert_gate_failed(acts).collect()]
    assert sorted(gate) == [(T(2023, 12, 1), 1, 2), (T(2024, 1, 20), 1, 2), (T(2024, 1, 21), 1, 2)]


def test_daily_usage_sums_one_metric(spark):
    rows = [(T(2024, 1, 20, 1), "MICROSOFT.DATABRICKS", "DBUUsage", 1.1),
            (T(2024, 1, 20, 9), "MICROSOFT.DATABRICKS", "DBUUsage", 2.2),
            (T(2024, 1, 20, 9), "MICROSOFT.DATABRICKS", "CPUUsage", 50.0),
            (T(2024, 1, 20, 9), "MICROSOFT.STORAGE", "DBUUsage", 7.0)]
    m = ntz(spark.createDataFrame(rows, "TimeGenerated timestamp, ResourceProvider string, MetricName string, Total double"),
            "TimeGenerated")
    got = [(r.TimeGenerated, r.DailyDBUs) for r in oplog.daily_usage(m, "2024-01-31 00:00:00").collect()]
    assert got == [(T(2024, 1, 20), 3.3)]                # exact decimal sum, not 3.3000000000000003
