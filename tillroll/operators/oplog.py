"""Operational queries over run and storage log tables, alerts and tiers.

Each query is a function of a caller-supplied log DataFrame and an explicit
``as_of`` (instead of the log service's ``now()``), so results repeat.
Log times are ``timestamp_ntz``. Sums of money-like or duration values go
through decimals so that they are exact and independent of partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.exprs import path_segment

# Fixed values of the reference's rules.
PIPELINE = "pl_medallion_refresh"
JOB = "medallion_daily_refresh"
GATE_ACTIVITY = "run_dq_suite_gate"
RUNTIME_LIMIT_MIN = 90
LIFECYCLE_PREFIX = "bronze/"
VERSION_PREFIXES = ["bronze/", "silver/", "gold/"]
COOL_AFTER_DAYS = 30
ARCHIVE_AFTER_DAYS = 90
DELETE_AFTER_DAYS = 730
VERSION_DELETE_AFTER_DAYS = 90
# Monthly price per GB and tier (ZAR), as the cost model states them.
TIER_PRICE = {"hot": 0.38, "cool": 0.21, "archive": 0.04, "delete": 0.0}


def _ts(v) -> Column:
    return v if isinstance(v, Column) else F.lit(str(v)).cast("timestamp_ntz")


# Partition column of a log that is laid out by day (files.write_day_log).
LOG_DAY = "log_day"


def _since(log: DataFrame, col: str, as_of, days: int) -> Column:
    """``as_of - days < col <= as_of``: the log service's ``ago(days)`` asked at ``as_of``.

    On a log laid out by day the same window is also asked of the partition
    column: a comparison with a time does not prune day folders by itself.
    """
    first = _ts(as_of) - F.make_dt_interval(days=F.lit(days))
    recent = (F.col(col) > first) & (F.col(col) <= _ts(as_of))
    if LOG_DAY in log.columns:
        recent = recent & F.col(LOG_DAY).between(F.to_date(first), F.to_date(_ts(as_of)))
    return recent


def _day(col: str) -> Column:
    return F.to_date(F.col(col)).cast("timestamp_ntz")


def _exact(col: str) -> Column:
    """Twelve decimals and 26 digits before the point: nothing measured is cut."""
    return F.col(col).cast("decimal(38,12)")


def _mean(col: str) -> Column:
    """Exact sum over count, divided once in double."""
    return F.sum(_exact(col)).cast("double") / F.count(F.col(col))


def run_history(runs: DataFrame, as_of, days: int = 7, pipeline: str = PIPELINE) -> DataFrame:
    """L1: recent runs with their duration in ms, newest first."""
    return (runs.filter(_since(runs, "TimeGenerated", as_of, days) & (F.col("PipelineName") == pipeline))
                .select("TimeGenerated", "Status", "Start", "End",
                        F.expr("timestampdiff(MILLISECOND, Start, End)").alias("DurationMs"))
                .orderBy(F.desc("TimeGenerated")))


def failures_by_activity(activities: DataFrame, as_of, days: int = 30,
                         pipeline: str = PIPELINE) -> DataFrame:
    """L2: failed activity runs per activity, most failures first."""
    return (activities.filter(_since(activities, "TimeGenerated", as_of, days)
                              & (F.col("PipelineName") == pipeline)
                              & (F.col("Status") == "Failed"))
                      .groupBy("ActivityName").agg(F.count(F.lit(1)).alias("FailureCount"))
                      .orderBy(F.desc("FailureCount"), "ActivityName"))


def duration_trend(jobs: DataFrame, as_of, days: int = 30, job: str = JOB) -> DataFrame:
    """L3: average and maximum job duration per day."""
    return (jobs.filter(_since(jobs, "TimeGenerated", as_of, days) & (F.col("JobName") == job))
                .groupBy(_day("TimeGenerated").alias("TimeGenerated"))
                .agg(_mean("DurationMinutes").alias("AvgDurationMin"),
                     F.max("DurationMinutes").alias("MaxDurationMin"))
                .orderBy("TimeGenerated"))


def volume_by_path_segment(blobs: DataFrame, as_of, days: int = 30, segment: int = 3) -> DataFrame:
    """L4: request count and bytes by the 4th '/'-segment of the URI.

    URIs with fewer segments group under ''.
    """
    return (blobs.filter(_since(blobs, "TimeGenerated", as_of, days))
                 .groupBy(path_segment("Uri", segment).alias("Uri"))
                 .agg(F.count(F.lit(1)).alias("TransactionCount"),
                      F.sum("ResponseBodySize").cast("bigint").alias("TotalBytes"))
                 .orderBy(F.desc("TotalBytes"), "Uri"))


def daily_usage(metrics: DataFrame, as_of, days: int = 30,
                provider: str = "MICROSOFT.DATABRICKS", metric: str = "DBUUsage") -> DataFrame:
    """Daily total of one metric of one resource provider."""
    return (metrics.filter(_since(metrics, "TimeGenerated", as_of, days)
                           & (F.col("ResourceProvider") == provider)
                           & (F.col("MetricName") == metric))
                   .groupBy(_day("TimeGenerated").alias("TimeGenerated"))
                   .agg(F.sum(_exact("Total")).cast("double").alias("DailyDBUs"))
                   .orderBy("TimeGenerated"))


def alert_windows(events: DataFrame, predicate: Column, window: str, alert: str,
                  severity: int, ts: str = "TimeGenerated") -> DataFrame:
    """Tumbling-window count of matching log rows; a row per firing window.

    The rule fires when the count in a window is greater than 0.
    """
    return (events.filter(predicate)
                  .groupBy(F.window(F.col(ts), window).alias("w"))
                  .agg(F.count(F.lit(1)).alias("hits"))
                  .filter(F.col("hits") > 0)
                  .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                          F.lit(alert).alias("alert"), F.lit(severity).alias("severity"), "hits"))


def alert_failed_runs(runs: DataFrame, pipeline: str = PIPELINE) -> DataFrame:
    """Any failed run of the pipeline in a 15-minute window (severity 1)."""
    return alert_windows(runs, (F.col("Status") == "Failed") & (F.col("PipelineName") == pipeline),
                         "15 minutes", "pipeline_failure", 1)


def alert_gate_failed(activities: DataFrame, activity: str = GATE_ACTIVITY) -> DataFrame:
    """The data-quality gate activity failed in a 15-minute window (severity 2)."""
    return alert_windows(activities,
                         (F.col("ActivityName") == activity) & (F.col("Status") == "Failed"),
                         "15 minutes", "dq_gate_failure", 2)


def alert_runtime(jobs: DataFrame, job: str = JOB, limit_min: float = RUNTIME_LIMIT_MIN) -> DataFrame:
    """A job ran longer than the limit (strictly) in a 30-minute window (severity 3)."""
    return alert_windows(jobs, (F.col("JobName") == job) & (F.col("DurationMinutes") > limit_min),
                         "30 minutes", "runtime_exceeded", 3)


def storage_tiers(inventory: DataFrame, as_of) -> DataFrame:
    """Lifecycle tier of each object by age since modification.

    Under ``bronze/``: > 730 days delete, > 90 archive, > 30 cool, else hot.
    Old versions under bronze/silver/gold are deleted after 90 days.
    """
    age = F.datediff(F.lit(str(as_of)).cast("date"), F.to_date("modified"))
    in_lifecycle = F.col("path").startswith(LIFECYCLE_PREFIX)
    versioned = F.lit(False)
    for p in VERSION_PREFIXES:
        versioned = versioned | F.col("path").startswith(p)
    is_version = F.coalesce(F.col("is_version"), F.lit(False)) if "is_version" in inventory.columns \
        else F.lit(False)
    tier = (F.when(is_version & versioned & (age > VERSION_DELETE_AFTER_DAYS), "delete")
             .when(is_version, "hot")
             .when(in_lifecycle & (age > DELETE_AFTER_DAYS), "delete")
             .when(in_lifecycle & (age > ARCHIVE_AFTER_DAYS), "archive")
             .when(in_lifecycle & (age > COOL_AFTER_DAYS), "cool")
             .otherwise("hot"))
    return inventory.select("path", "size_gb", age.alias("age_days"), tier.alias("tier"))


def _price(tier: Column) -> Column:
    expr = None
    for name, price in TIER_PRICE.items():
        lit = F.lit(price).cast("decimal(6,2)")
        expr = F.when(tier == name, lit) if expr is None else expr.when(tier == name, lit)
    return expr


def storage_cost(tiers: DataFrame) -> DataFrame:
    """Monthly cost per tier with the lifecycle, against all-hot.

    Deleted objects cost 0 (the cost model has no delete tier).
    """
    gb = F.col("size_gb").cast("decimal(20,6)")
    return (tiers.groupBy("tier")
                 .agg(F.count(F.lit(1)).alias("objects"),
                      F.sum(gb).cast("double").alias("size_gb"),
                      F.sum(gb * _price(F.col("tier"))).cast("double").alias("cost_tiered"),
                      F.sum(gb * F.lit(TIER_PRICE["hot"]).cast("decimal(6,2)")).cast("double")
                       .alias("cost_all_hot")))


def storage_saving(cost: DataFrame) -> DataFrame:
    """Tiered vs all-hot monthly cost and the saving share, one row."""
    return (cost.agg(F.sum(F.col("cost_tiered").cast("decimal(38,6)")).cast("double").alias("cost_tiered"),
                     F.sum(F.col("cost_all_hot").cast("decimal(38,6)")).cast("double").alias("cost_all_hot"))
                .withColumn("saving_pct",
                            F.try_divide(F.col("cost_all_hot") - F.col("cost_tiered"), F.col("cost_all_hot"))))
